"""Plain Python versions of what the operators compute, for tests."""

from __future__ import annotations

import collections
import hashlib
import re

LOW = {i: i + 32 for i in range(65, 91)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def alnum(t):
    return ALNUM.findall((t or "").translate(LOW))


def listed(found):
    """found: (start, rank of the kind, end, kind)."""
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(found))


def quality(t):
    t = t or ""
    w = SPACED.findall(t)
    tri = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    rep = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)


def windows(items):
    """Window of words -> ids of the items (as strings) that have it."""
    out = collections.defaultdict(set)
    for i, t in items:
        w = alnum(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else []:
            out[tuple(w[k : k + n])].add(str(i))
    return out


def contamination(t, wins):
    w, hit, items = alnum(t), set(), set()
    for n in {len(k) for k in wins}:
        for k in range(len(w) - n + 1):
            if found := wins.get(tuple(w[k : k + n])):
                items |= found
                hit |= set(range(k, k + n))
    return len(w), len(hit), len(items), sha(",".join(sorted(items))), len(hit) > 0 and 20 * len(hit) >= len(w)


def shingles(t, k):
    w = SPACED.findall((t or "").translate(LOW))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near(docs, k, num, den):
    """docs: (id, text) -> id -> (set size of its last text, least reachable id); rows of one id are one node."""
    up = {}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in docs if i is not None]
    for i, _ in sets:
        up[i] = i
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both) and find(i) != find(j):
                    x, y = find(i), find(j)
                    up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 9 <= len(digits(s)) <= 15),
)


def personal(t):
    return sorted((m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(PII) for m in p.finditer(t or "") if ok(m.group()))


_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(t) if len(m.group(2)) >= 6 and m.group(1).isascii()]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def hexdigest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def record(values):
    return hexdigest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def runs_of(nodes):
    return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]


def merkle_levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([hexdigest("".join(r)) for r in runs_of(out[-1])])
    return out


def merkle_path(levels, i):
    """(siblings left, right) from the leaf i to the top."""
    out = []
    for level in levels[:-1]:
        lo = i // 8 * 8
        out.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 8])))
        i //= 8
    return out


def merkle(docs):
    """docs: (doc_id, text, lang, source, n_chars) -> sorted rows of op11."""
    import zlib

    trees = collections.defaultdict(list)
    for d, t, lang, source, n in docs:
        tampered = t.translate(LOW) if t is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else t
        trees[lang].append((d is not None, d or 0, record((d, source, lang, n, t)), record((d, source, lang, n, tampered)), d))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: merkle_levels([leaf for _, _, leaf, _, _ in sorted(trees[x], key=lambda r: r[:3])]) for x in names}
    top = merkle_levels([built[x][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for i, (_, _, leaf, claim, d) in enumerate(sorted(trees[x], key=lambda r: r[:3])):
            path = merkle_path(built[x], i) + merkle_path(top, k)
            fold = claim
            for a, b in path:
                fold = hexdigest(a + fold + b)
            out.append((-1 if d is None else d, leaf, built[x][-1][0], top[-1][0], hexdigest("".join(a + b for a, b in path)), fold, fold == top[-1][0]))
    return sorted(out)


def chat(rows):
    """rows: (conv_id, turn, role, text) with distinct turns -> conv_id -> n_turns, turns digest, loss chars, loss digest."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = [(role, text or "") for _, _, role, text in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = len(turns), hexdigest("".join(f"{r or ''}\n{t}\n" for r, t in turns)), len(loss), hexdigest(loss)
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :])


def spelling(docs, typo=199, shortest=6, least=5):
    """docs: (doc_id, text) -> sorted rows word, form, root, n, n_near, form_n."""
    import zlib

    n = collections.Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if typo and h % typo == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    near = {w: [] for w in n}
    cut = collections.defaultdict(set)  # words by what is left of them without one code point
    for w in n:
        for i in range(len(w)):
            cut[w[:i] + w[i + 1 :]].add(w)
    for w in n:
        met = set().union(*(cut.get(w[:i] + w[i + 1 :], ()) for i in range(len(w))), cut.get(w, ()), (x for x in (w[:i] + w[i + 1 :] for i in range(len(w))) if x in n))
        near[w] = [x for x in met if one_edit(w, x)]
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w) or "", root, n[w], len(near[w]), n[form[w]] if w in form else -1))
    return sorted(out)
