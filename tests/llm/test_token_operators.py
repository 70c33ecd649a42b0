"""Operators 6 and 9 against the libraries, exact round trips, and the Huffman code against the optimum."""

import base64
import gc
import hashlib
import heapq
import pickle
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalis.llm import bpe, pieces, queries, scratch, tokenfile
from vitalis.llm.huffman import EVERY, Code, code_lengths
from vitalis.llm.scratch import folder as scratch_folder

ALPHABET = ["a", "b", "e", "th", "in", "'", "'s", "'ll", "s", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x85", "\x1c", "é", "ß", "中", "日本", "123", "٣", "Ⅷ", "aaaa", "=====", "\U0001f600", "Ж", "ار", "́", "the", "--", "...", "ࢗ", "<|endoftext|>"]


def texts(n, seed, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(vocabulary):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_as_the_pattern_splits():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for t in texts(20_000, 1):
        assert pieces.split(t) == pattern.findall(t), t


def test_classes_of_all_code_points():
    """Letters join an ``a`` before them, numbers a ``1`` behind them, as the tokenizers library has them."""
    from tokenizers.pre_tokenizers import ByteLevel

    split, kinds = ByteLevel(add_prefix_space=False, use_regex=True), pieces.classes()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c != 0x20]
    for lo in range(0, len(points), 50_000):
        part = points[lo : lo + 50_000]
        cuts = {a for _, (a, _) in split.pre_tokenize_str("".join(f"a{chr(c)}1" for c in part))}
        for i, c in enumerate(part):
            want = pieces.LETTER if 3 * i + 1 not in cuts else pieces.NUMBER if 3 * i + 2 not in cuts else None
            assert kinds[c] == want or want is None and kinds[c] in (pieces.OTHER, pieces.SPACE), hex(c)


def test_bpe_as_the_library(vocabulary, library):
    for t in texts(20_000, 2) + ["a" * 5000, "ab" * 3000, " " * 700, "ththth" * 500]:
        ids = vocabulary.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t
        assert vocabulary.decode(ids) == t.encode()


def merged(word, rank):
    """Lowest rank first, leftmost of equals."""
    parts = [bytes([c]) for c in word]
    while len(parts) > 1:
        best = min((rank.get(parts[i] + parts[i + 1], 10**9), i) for i in range(len(parts) - 1))
        if best[0] == 10**9:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


def test_bpe_merges_of_small_vocabularies():
    """Vocabularies that grow by a random pair of neighbours, as training does, against merging by hand."""
    rng = random.Random(3)
    for _ in range(80):
        entries = [b"a", b"b", b"c"]
        for _ in range(rng.randint(1, 30)):
            rank = {e: i for i, e in enumerate(entries)}
            parts = merged(bytes(rng.choices(b"abc", k=30)), rank)
            k = rng.randrange(len(parts) - 1)
            if len(parts[k] + parts[k + 1]) < 12:
                entries.append(parts[k] + parts[k + 1])
        rank = {e: i for i, e in enumerate(entries)}
        assert len(rank) == len(entries)
        voc = bpe.Vocabulary(entries)
        assert all(voc._reachable(i) for i in range(len(entries)))
        for _ in range(60):
            word = bytes(rng.choices(b"abc", k=rng.randint(1, 25)))
            want = [rank[word]] if word in rank else [rank[p] for p in merged(word, rank)]
            assert voc.encode_piece(word) == want, (entries, word)


def test_ranks_that_no_merges_make(tmp_path):
    (tmp_path / "odd").write_bytes(b"".join(base64.b64encode(e) + b" %d\n" % i for i, e in enumerate([b"a", b"b", b"aba"])))
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "odd"))


def test_memo_stays_bounded(vocabulary):
    calls = []
    memo = pieces.Memo(lambda found: (calls.append(p) or p.encode() for p in found), limit=3)
    assert memo.ids("a b c d e") == b"a b c d e" and memo.ids("x y") == b"x y" and memo.held <= 5
    assert b"".join(memo.ids(t) for t in ("a b c", "x y z")) == b"a b cx y z"


def test_pieces_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(pieces.Memo, "_hashes", staticmethod(lambda data, at: (at[1:] - at[:-1]).astype(np.uint64) % 3))
    memo = pieces.Memo(lambda found: (f"<{p}>".encode() for p in found), limit=200)
    for t in texts(3000, 9):
        assert memo.ids(t).decode() == "".join(f"<{p}>" for p in pieces.split(t)), t


def test_memo_is_as_large_as_its_pieces():
    """A generous limit costs nothing before the pieces are there, and widening loses none of them."""
    calls = []
    memo = pieces.Memo(lambda found: (calls.append(p) or p.encode() for p in found), limit=1_600_000)

    def held() -> int:
        return sum(x.nbytes for x in (memo.slot_hash, memo.slot_entry, memo.pieces.flat, memo.pieces.at, memo.values.flat, memo.values.at))

    assert memo.ids("a b") == b"a b" and held() < 100_000
    found = [" ".join(f"p{i:x}q" for i in range(k, k + 500)) for k in range(0, 40_000, 500)]
    for _ in range(2):
        assert [memo.ids(t).decode() for t in found] == found
    assert len(calls) == len(set(calls)) == memo.held and held() < 150 * memo.held


def test_memo_goes_with_its_vocabulary(vocabulary):
    """At once, by reference counts: the next task of a reused Python worker must not stand beside it."""
    own = pickle.loads(pickle.dumps(vocabulary))
    own.encode("some text")
    memo = weakref.ref(own.memo)
    gc.disable()
    try:
        del own
        assert memo() is None
    finally:
        gc.enable()


def test_free_memory_goes_back_around_a_task(spark, monkeypatch):
    """What earlier tasks left free in a reused worker is given back before the rows of a task and after them."""
    said = []

    class Frame:
        """Stands for a DataFrame: gives the function that a worker would run."""

        sparkSession = spark

        def mapInArrow(self, f, schema):
            return f

    def noted(batches):
        for b in batches:
            said.append(b)
            yield b

    monkeypatch.setattr(scratch, "release", lambda: said.append("release"), raising=False)
    assert list(scratch.map_arrow(Frame(), noted, None)(iter([1, 2]))) == [1, 2]
    assert said == ["release", 1, 2, "release"]


def test_many_texts_and_long_sections(monkeypatch):
    """Chunks and sections of any size give what each text gives alone."""
    found = texts(2000, 10, 40) + ["word " * 3000 + "'s 1 a  b", "", "x"]
    whole = [pieces.split(t) for t in found]
    for chunk, section in ((1, 1), (50, 7), (1000, 100)):
        monkeypatch.setattr(pieces.Memo, "CHUNK", chunk)
        monkeypatch.setattr(pieces.Memo, "SECTION", section)
        memo = pieces.Memo(lambda new: (f"<{p}>".encode() for p in new), limit=500)
        ids, counts = memo.ids_of(found)
        assert [x.tobytes().decode() for x in np.split(ids, np.cumsum(counts)[:-1])] == ["".join(f"<{p}>" for p in ps) for ps in whole]


def test_added_tokens_as_the_library(spark):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert model.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    known = tokenfile.memo(public_tokenizers.path("byte_bpe_50k.json"))
    for t in ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x", "<|endoftext|><|endoftext|>", "<|endoftext", *texts(3000, 11)]:
        assert known.ids_of([t])[0].tolist() == model.encode(t, add_special_tokens=False).ids, t


def data(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, start string, key long").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_op6(spark, tmp_path, library):
    rows = [(i, t, 1, "x", 2) for i, t in enumerate([None, "", "word " * 20_000, *texts(300, 4, 60)])] + [(5, "again", 1, "x", 2)] * 2 + [(None, "no id", 1, "x", 2)]
    got = sorted(tuple(r) for r in queries.op6_bpe(spark, data(spark, tmp_path, rows)).fillna(-1).collect())
    want = []
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_op9(spark, tmp_path):
    rows = [(i * 3, t, 1, "x", 2) for i, t in enumerate([None, "", "word " * 20_000, *texts(300, 5, 60)])]
    random.Random(1).shuffle(rows)
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op9_tokenfile(spark, data(spark, tmp_path, rows)).collect()}
    start = 0
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), (i, t)
        start += len(ids)


def test_token_file_of_repeated_and_null_keys(spark):
    rows = [(1, "one"), (1, "one"), (1, "other"), (None, "none"), (0, "zero zero")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = scratch_folder(spark, "test-ids")
    tokenfile.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    got = tokenfile.with_start(tokenfile.read(spark, path), spark, path).orderBy("start").collect()
    assert [r.key for r in got] == [None, 0, 1, 1, 1]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(5)]
    assert all(len(r.ids) == 4 * r.n_tokens and r.ids[-4:] == bytes(4) for r in got)


@pytest.mark.parametrize("query", ["op6_bpe", "op9_tokenfile"])
def test_empty(spark, tmp_path, query):
    assert queries.QUERIES[query](spark, data(spark, tmp_path, [])).collect() == []


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@pytest.mark.parametrize("n", [1, 2, 3, 17, 300, 5000])
def test_huffman(n):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(1, n) * 5).astype(np.int64) + 1
    counts[rng.random(n) < 0.1] = 0
    counts[0] = 3
    lengths = code_lengths(counts).astype(np.int64)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= 20
    if (counts > 0).sum() > 1:
        assert (2.0 ** -lengths[lengths > 0]).sum() == 1.0
        assert (lengths * counts).sum() == huffman_cost(counts.tolist())  # nothing here is longer than the limit
    code = Code(lengths)
    for m in (0, 1, EVERY - 1, EVERY, EVERY + 1, 5000):
        symbols = rng.choice(n, m, p=counts / counts.sum())
        packed, at = code.pack(symbols)
        assert (code.unpack(packed, at, m) == symbols).all()
        assert len(packed) == (lengths[symbols].sum() + 7) // 8


def test_length_limit_is_optimal():
    """Against all code lengths of small alphabets."""
    import itertools

    for counts in ([1, 1, 2, 4, 8, 16], [1, 1, 1, 1, 50], [5, 5, 5, 5, 5], [1, 2, 3, 100]):
        best = min(sum(a * b for a, b in zip(counts, ls)) for ls in itertools.product(range(1, 4), repeat=len(counts)) if sum(2.0**-x for x in ls) <= 1)
        assert int((code_lengths(np.array(counts), 3).astype(int) * counts).sum()) == best


def test_counts_of_plain_blocks(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(50, 6))], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = tokenfile._plain_blocks(docs, "doc_id", "text", path, 0)
    total = tokenfile._counts(plain).agg(F.sum("count")).first()[0]
    assert total == plain.select(F.explode("n_tokens").alias("n")).agg(F.sum("n")).first()[0]
