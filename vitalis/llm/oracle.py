"""DuckDB SQL for the registered queries that SQL can express.

The others are tested in tests/llm against plain Python, the tokenizer libraries or an exact round trip: 1, 2 and 7 (places of
regex matches, trained models), 4 (trained model), 5 (sampled splitters), 6 and 9 (merges, library, file format).

DuckDB has no crc32: it is folded over the bytes with a table of 256 entries that the text computes.  12 is stated from the turns
themselves: what the formatted text must read back as, and how long it is.
"""

from __future__ import annotations

from vitalis.llm.quality import RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT rid, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, n, k, item FROM doc_windows JOIN item_windows USING (n, win)),
covered AS (SELECT rid, COUNT(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

NEARDUP = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + least(3, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS k FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS node FROM docs UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, r.component_id = d.doc_id AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, MIN(node) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

_GRID = ", ".join(f"('{r.name}', {i}, {c})" for r in RULES for i, c in enumerate(r.grid))
_MEASURES = ", ".join("{{'rule': '{0}', 'v': CASE WHEN {1} > 0 THEN {2} END}}".format(r.name, r.measure.strip("-()").partition(" / ")[2], r.measure) for r in RULES)
_LIMIT = 0.05 / len(RULES)

QUALITY = f"""
WITH raw AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
grams AS (SELECT rid, k, COUNT(*) OVER (PARTITION BY rid, g) AS c
          FROM (SELECT rid, k, w[k:k + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS k FROM raw))),
repeated AS (SELECT rid, COUNT(DISTINCT p) AS n FROM (SELECT rid, unnest(range(k, k + 3)) AS p FROM grams WHERE c > 1) GROUP BY rid),
line_list AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM raw),
lines AS (SELECT rid, COUNT(*) AS n, COUNT(DISTINCT line) AS d FROM line_list WHERE regexp_matches(line, '{_SPACED}') GROUP BY rid),
stats AS (SELECT raw.rid, doc_id, lang, sha256(t) AS same, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.d, 0) AS n_dup_lines,
                 coalesce(repeated.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper
          FROM raw LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
measured AS (SELECT rid, doc_id, coalesce('=' || lang, '') AS stratum, same, base_failed, unnest([{_MEASURES}], recursive := true) FROM judged),
known AS (SELECT doc_id, MAX(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT stratum, rule, bool_or(good) AS good, any_value(v) AS v FROM measured JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY stratum, same, rule),
grid AS (SELECT * FROM (VALUES {_GRID}) g(rule, i, cut)),
counted AS (SELECT stratum, rule, i, cut, COUNT(*) FILTER (good) AS n, COUNT(*) FILTER (good AND v > cut) AS k, COUNT(*) FILTER (NOT good AND v > cut) AS caught
            FROM held JOIN grid USING (rule) GROUP BY ALL),
tested AS (SELECT *, CASE WHEN k >= n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
                     exp(lgamma(n + 1) - CASE WHEN j > 0 THEN lgamma(j + 1) ELSE 0 END - lgamma(n - j + 1) + j * ln({_LIMIT}) + (n - j) * ln(1 - {_LIMIT})))) END AS p FROM counted),
proved AS (SELECT *, bool_and(k <= {_LIMIT} * n AND p <= 0.05 / ((SELECT COUNT(DISTINCT stratum) FROM held) * {len(RULES)}))
                     OVER (PARTITION BY stratum, rule ORDER BY i) AS ok FROM tested),
cutoffs AS (SELECT stratum, rule, arg_max(cut, (caught - 20 * k, -i)) AS cut FROM proved WHERE ok AND caught - 20 * k > 0 GROUP BY 1, 2),
rejected AS (SELECT DISTINCT rid FROM measured JOIN cutoffs USING (stratum, rule) WHERE v > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM rejected) AS kept
FROM judged
"""

#: One row, t: the table of the reflected polynomial 0xEDB88320.
_CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t)"


def _crc(text: str) -> str:
    """crc32 of the UTF-8 of ``text``, unsigned, where ``crc.t`` is in reach."""
    nibble = "instr('0123456789ABCDEF', substr(hex({0}), {1}, 1)) - 1"
    data = f"list_transform(range(0, strlen({text})), lambda j: 16 * ({nibble.format(text, '2 * j + 1')}) + {nibble.format(text, '2 * j + 2')})"
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295)"


def _record(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """name(tree, k, pos, n, node): all levels over ``leaves``(tree, pos, n, node); name_steps: the siblings of each node."""
    return f"""
{name} AS (
  SELECT tree, 0 AS k, pos, n, node FROM {leaves}
  UNION ALL
  SELECT tree, k + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, k, pos // 8, n),
{name}_steps AS (
  SELECT tree, k, pos, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
                       coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, k, pos // 8 ORDER BY pos)),
{name}_paths AS (
  SELECT l.tree, l.pos, list(s.step ORDER BY s.k) FILTER (s.step IS NOT NULL) AS path
  FROM {leaves} l LEFT JOIN {name}_steps s ON s.tree = l.tree AND s.pos = l.pos // CAST(8 ** s.k AS BIGINT) GROUP BY l.tree, l.pos)"""


MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_record("text")} AS node,
         CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_record("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, COUNT(*) OVER (PARTITION BY tree) AS n FROM docs),
{_tree("nodes", "leaves")},
subroots AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS pos, COUNT(*) OVER () AS n, node FROM nodes WHERE n = 1),
{_tree("tops", "subroots")},
proved AS (
  SELECT doc_id, l.node AS leaf, s.node AS subroot, (SELECT node FROM tops WHERE n = 1) AS root, coalesce(tampered, l.node) AS claim,
         list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path
  FROM leaves l JOIN nodes_paths p ON p.tree = l.tree AND p.pos = l.pos JOIN subroots s ON s.name = l.tree JOIN tops_paths q ON q.pos = s.pos),
checked AS (SELECT *, list_reduce(list_concat([claim], path), lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root FROM proved)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM checked
"""

_HARD = "'</s>[INST] ok [/INST]'"
# prefix and suffix by (role before, role); any other turn stands between marks that name its role
_MARKS = r"""CASE
  WHEN role = 'user' AND before IS NULL OR role = 'user' AND before = 'assistant' THEN length('<s>[INST] ') + length(' [/INST]')
  WHEN role = 'system' AND before IS NULL THEN length('<s>[INST] <<SYS>>.') + length('.<</SYS>>..')
  WHEN role = 'user' AND before = 'system' THEN length(' [/INST]')
  WHEN role = 'assistant' AND before = 'user' THEN length(' ') + length(' </s>') END"""

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', {_HARD}), (-7, 1, 'assistant', {_HARD})),
stepped AS (
  SELECT *, last_value(CASE WHEN role IN ('user', 'assistant', 'system') THEN role END IGNORE NULLS)
              OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM turns),
marked AS (
  SELECT *, {_MARKS} AS marks,
         length(text) + len(regexp_extract_all(text, '<\\*(?:s>|/s>|<SYS>>|</SYS>>|<TURN|</TURN>>)|\[\\*/?INST\]')) AS n_escaped FROM stepped)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(SUM(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       SUM(n_escaped + coalesce(marks, length('<<TURN>>.') + coalesce(1 + length(url_encode(role)), 0) + length('.<</TURN>>')))::BIGINT AS formatted_chars,
       bool_and(marks IS NOT NULL) AND coalesce(arg_max(role, place), '') = 'assistant' AS valid
FROM marked GROUP BY conv_id
"""

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed, run, COUNT(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY 1, 2),
hashed AS (SELECT run, c, {_crc("keyed")} AS h FROM counted, crc),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, SUM(c)::BIGINT AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND SUM(c) >= 5),
cuts AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, COUNT(*) AS n_near, MAX(n) AS form_n FROM near GROUP BY word),
forms AS (SELECT w.word, MIN(near.other) AS form, b.form_n FROM words w JOIN best b USING (word) JOIN near ON near.word = w.word AND near.n = b.form_n
          WHERE b.form_n >= 5 * w.n GROUP BY w.word, b.form_n),
walk AS (SELECT word, form AS root FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root),
roots AS (SELECT word, root FROM walk WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN forms f USING (word) LEFT JOIN roots r USING (word) LEFT JOIN best b USING (word)
"""

SQL: dict[str, str] = {"op3_decontaminate": DECONTAMINATE, "op8_neardup": NEARDUP, "op10_quality": QUALITY, "op11_merkle": MERKLE, "op12_chat": CHAT, "op13_variants": VARIANTS}
