"""Operator 8 against all pairs."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalis.llm import neardup, queries, wordhash


def family(rng, words, n, copies, most):
    """A text and copies of it with up to ``most`` changed words."""
    base = rng.choices(words, k=n)
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(n)] = rng.choice(words)
        out.append(" ".join(own))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", " \n ", "one", "One", "one two", "one  two", "one two three", "A b c d e f g", "a b c d e f g"]
    for n, copies, most in ((40, 30, 6), (150, 60, 8), (150, 10, 0), (400, 15, 30), (12, 20, 2), (7, 15, 1)):
        texts += family(rng, words, n, copies, most)
    shared = " ".join(rng.choices(words, k=60))
    texts += [f"{shared} {' '.join(rng.choices(words, k=rng.randint(0, 30)))}" for _ in range(60)]
    return texts


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, key long, n long, component_id string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_op8_against_all_pairs(spark, tmp_path):
    texts = corpus(1)
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    rows = [(i, t, 1, 2, "x") for i, t in zip(ids, texts, strict=True)]
    want = brute.near([(r[0], r[1]) for r in rows], 3, 85, 100)
    got = queries.op8_neardup(spark, write(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id), r
    assert len({r.component_id for r in got}) < len(got) - 60


def test_repeated_and_null_ids(spark, tmp_path):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (3, a), (9, b + " x"), (None, a), (None, None), (7, None), (5, a)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in queries.op8_neardup(spark, write(spark, tmp_path, [(*r, 1, 2, "x") for r in rows])).collect())
    assert got == sorted([("5", 38, 3, False), ("5", 38, 3, False), ("5", 38, 3, False), ("3", 38, 3, True), ("9", 39, 3, False), ("None", 38, None, True), ("None", 0, None, True), ("7", 0, 7, True)])


def test_empty(spark, tmp_path):
    assert queries.op8_neardup(spark, write(spark, tmp_path, [])).collect() == []


def test_keep_one_with_five_words(spark):
    texts = corpus(3)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(4, texts[4], "x"), (None, "one", "y")], "doc_id long, text string, component string")
    want = brute.near(list(enumerate(texts)), 5, 80, 100)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == sorted([(False, i) for i, (_, c) in want.items() if c == i] + [(True, 0)])


def test_rows_of_one_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(7, a), (7, b), (7, None), (7, None), (7, ""), (8, b + " more"), (9, c), (9, c), (9, c), (3, c + " end"), (-5, "few words"), (4, "few words"), (None, a), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, __node int, node string")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(7, a), (7, b), (7, None), (7, ""), (3, c + " end"), (-5, "few words"), (None, a), (None, None)]
    plain = lambda rs: sorted((r[0] is None, r[0] or 0, r[1] is None, r[1] or "") for r in rs)
    assert plain(kept.collect()) == plain(want)
    named = docs.withColumn("doc_id", F.concat(F.lit("id"), F.col("doc_id").cast("string")))
    assert sorted((r[0] or "", r[1] or "") for r in neardup.keep_one(named).collect()) == sorted((f"id{i}" if i is not None else "", t or "") for i, t in want)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 450)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.u: r.v for r in neardup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}


def test_min_max_values_estimate_similarity():
    """Both halves of the signature agree with the Jaccard similarity."""
    signer = neardup.Signer(1, 100, 2)
    a, b = " ".join(f"x{i}" for i in range(900)), " ".join(f"x{i}" for i in range(100, 1000))
    sets = [s for _, found in signer.sets(pa.array([a, b])) for s in found]
    least = greatest = 0
    for t, p in zip(signer.times, signer.plus, strict=True):
        x, y = sets[0] * t + p, sets[1] * t + p
        least += x.min() == y.min()
        greatest += x.max() == y.max()
    assert abs((least + greatest) / 200 - 0.8) < 0.1


@pytest.mark.parametrize("table,pattern,fold", [(wordhash.ALNUM_FOLDED, brute.ALNUM, True), (wordhash.SPACED, brute.SPACED, False), (wordhash.SPACED_FOLDED, brute.SPACED, True)])
def test_words(table, pattern, fold):
    rng = random.Random(6)
    texts = [None, "", *("".join(rng.choices(["a", "B", "é", "中", " ", "\n", "\x00", "-", "1", "\x0b", "Z"], k=rng.randint(0, 30))) for _ in range(3000))]
    seen: dict[str, int] = {}
    n = 0
    for w in wordhash.words(pa.array(texts), table):
        for i in range(len(w.count)):
            own = texts[w.first + i] or ""
            found = pattern.findall(own.translate(brute.LOW) if fold else own)
            hashes = w.hashes[w.at[i] : w.at[i + 1]].tolist()
            assert len(hashes) == len(found)
            for x, h in zip(found, hashes, strict=True):
                assert seen.setdefault(x, h) == h
            n += 1
    assert n == len(texts) and len(set(seen.values())) == len(seen)


def test_words_of_sliced_columns():
    column = pa.array(["zero", "one two", None, "three"]).slice(1, 3)
    w = next(wordhash.words(column, wordhash.SPACED))
    assert w.count.tolist() == [2, 0, 1]
    assert np.array_equal(w.hashes, next(wordhash.words(pa.array(["one two", "", "three"]), wordhash.SPACED)).hashes)
