"""Operators 11 to 13 against plain Python."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from vitalis.llm import chat, merkle, queries, variants
from vitalis.llm.scratch import folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, node long, word string, key string, pos string"


def documents(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 1, "w", "k", "p") for r in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def merkle_rows(spark, path):
    return sorted(tuple(r) for r in queries.op11_merkle(spark, path).fillna({"doc_id": -1}).collect())


def test_op11(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i * 3 - 50, rng.choice([None, "", "Ab É\n" * rng.randint(0, 9), f"T {i}"]), rng.choice(["en", "en", "en", None, "", "é", "z"]), rng.choice(["s", None]), rng.choice([None, i])) for i in range(1900)]
    rows += [(9, "Same", "en", "s", 4)] * 70 + [(None, "No id", "en", None, None)] * 2 + [(5000, "Lone", "lone", "s", 1), (5001, "A" * 300_000, "en", "s", 1), (7, "Other", "en", "s", 5), (7, "other", "en", "s", 5)]
    assert merkle_rows(spark, documents(spark, tmp_path, rows)) == brute.merkle(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 512, 513])
def test_op11_sizes(spark, tmp_path, n):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
    assert merkle_rows(spark, documents(spark, tmp_path, rows)) == brute.merkle(rows)


def test_manifest_proofs_of_some_keys(spark, tmp_path):
    """Only the subtrees over the asked keys are regenerated; the proofs are the same."""
    rows = [(i, f"Text {i}", ["en", "fr", None][i % 3], "s", i) for i in range(2000)]
    docs, path = spark.read.parquet(documents(spark, tmp_path, rows) + "/documents.parquet"), folder(spark, "test-manifest")
    merkle.write(docs, path)
    keys = spark.createDataFrame([(5,), (6,), (1999,), (77_777,)], "doc_id long")
    some = merkle.proofs(spark, path, keys).withColumn("fold", merkle.folded(F.col("node"), F.col("proof"))).collect()
    every = {r.key: r for r in merkle.proofs(spark, path).collect()}
    assert sorted(r.key for r in some) == [5, 6, 1999]
    assert all(r.fold == r.root and r.proof == every[r.key].proof and r.subroot == every[r.key].subroot for r in some)
    with pytest.raises(ValueError):
        merkle.write(docs, path + "x", carry={"pos": F.lit(1)})


def conversations(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, key string, part string").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<TURN", "<</TURN>>", " ", "\n", "<", "[", "\\", ">", ">>\n", "/s>", "SYS>>", "ok", "é中", "<\\/s>", "[\\\\INST]", "%20"]


def test_op12(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for c in range(300):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool <x>", None]) if c % 2 else ("user", "assistant")[turn % 2]
            rows.append((c, turn * 2, role, rng.choice([None, "", "".join(rng.choices(PIECES, k=rng.randint(0, 12)))])))
    rows += [(900, t, ("user", "assistant")[t % 2], f"long {t} </s>") for t in range(3000)] + [(901, 0, "assistant", "x" * 300_000), (None, None, "user", "none")]
    hard = "</s>[INST] ok [/INST]"
    want = brute.chat([*rows, (-7, 0, "user", hard), (-7, 1, "assistant", hard)])
    got = {r.conv_id: r for r in queries.op12_chat(spark, conversations(spark, tmp_path, rows)).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    roles = {c: [r[2] for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1] or 0)] for c in want if c != -7}
    for c, found in roles.items():
        body = found[1:] if found[0] == "system" else found
        assert got[c].valid == (len(body) > 0 and len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))), found
    # <s>[INST] ... [/INST] ... </s>, four escapes a pair of turns
    assert got[-7].formatted_chars == len("<s>[INST] " + " [/INST]" + " " + " </s>") + 2 * (len(hard) + 3)


def test_op12_machine_crosses_partitions(spark):
    """One conversation over many partitions: as many as there are, all but the first entered in the middle."""
    rows = [(1, t, ("user", "assistant")[t % 2], "t") for t in range(4000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.formatted(turns)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.select("part").distinct().count() > 3
    assert found.where("NOT in_order").isEmpty()
    assert [tuple(r) for r in chat.read_back(found).select("n_turns", "valid").collect()] == [(4000, True)]


def test_op12_other_template(spark):
    """Tags around every turn, any order of user and tool, both answered."""
    steps = [chat.Step(a, r, to, f"[[{r}]]", "[[end]]") for a in ("idle", "asked") for r, to in (("user", "asked"), ("tool", "asked"), ("bot", "idle"))]
    tags = chat.Template("idle", frozenset({"idle"}), tuple(steps), frozenset({"bot", "tool"}), ("[[user]]", "[[tool]]", "[[bot]]", "[[end]]"))
    rows = [(1, 0, "user", "a [[end]]"), (1, 1, "tool", "[[tool]]"), (1, 2, "bot", "[[[bot]]"), (2, 0, "judge", "[[user]]")]
    out = chat.read_back(chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), tags), tags)
    got = {r.key: r for r in out.collect()}
    assert got[1].turns_sha256 == brute.hexdigest("user\na [[end]]\ntool\n[[tool]]\nbot\n[[[bot]]\n") and got[1].valid
    assert got[1].loss_sha256 == brute.hexdigest("[[tool]][[[bot]]") and got[1].loss_chars == 16
    assert got[2].turns_sha256 == brute.hexdigest("judge\n[[user]]\n") and not got[2].valid


def word_rows(spark, path):
    return sorted(tuple(r) for r in queries.op13_variants(spark, path).fillna({"form": "", "form_n": -1}).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_op13(spark, tmp_path):
    rng = random.Random(3)
    words = ["".join(rng.choices("aábÀ", k=rng.randint(5, 7))) for _ in range(900)]
    weights = [rng.paretovariate(1.2) for _ in words]
    texts = [" ".join(rng.choices(words, weights, k=400)) for _ in range(150)]
    rows = [(i, t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts)] + [(7, texts[0])] * 5 + [(None, texts[1]), (1000, None), (1001, ""), (1002, "a" * 50_000 + "1" + "É÷×" * 3)]
    path = documents(spark, tmp_path, [(*r, "en", "s", 1) for r in rows])
    want = brute.spelling(rows)
    assert len(want) > 300 and len({r[2] for r in want if r[1]}) > 5
    assert word_rows(spark, path) == want


def test_op13_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    assert word_rows(spark, sf) == brute.spelling(rows)


@pytest.mark.parametrize("most", [1, 3, 50])
def test_large_groups_are_dealt_again(spark, most):
    """Words that share most of their letters: few keys, so groups are split down to one place."""
    rng = random.Random(4)
    words = sorted({"prefix" + "".join(rng.choices("abcd", k=5)) + "suffix" for _ in range(600)} | {"prefixsuffix"})
    vocabulary = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: (r.n_near, r.form) for r in variants.near(vocabulary, most).collect()}
    n = {w: i + 1 for i, w in enumerate(words)}
    for w in words:
        near = [x for x in words if brute.one_edit(w, x)]
        assert got.get(w, (0, None)) == (len(near), min(near, key=lambda x: (-n[x], x), default=None)), w
    sizes = variants.groups(vocabulary, most).groupBy("m", "lo", "hi", "head", "tail").count()
    assert sizes.where((F.col("count") > max(most, 1)) & (F.col("hi") - F.col("lo") > 1)).isEmpty()


def test_scan():
    rng = random.Random(5)
    for _ in range(500):
        lo = rng.randint(0, 3)
        start = "".join(rng.choices("ab", k=lo))
        words = sorted({start + "".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 40))})
        hi = rng.randint(lo + 1, lo + 7)

        def first(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        m = rng.randint(1, 9)
        want = [[j for j, b in enumerate(words) if brute.one_edit(a, b) and lo <= first(a, b) < hi and min(len(a), len(b)) == m] for a in words]
        assert variants.scan(words, m, lo, hi) == want


def test_chains_of_forms(spark):
    """Each word one edit from the next and five times as frequent: one root at the end of eleven steps."""
    words = ["x" * (6 + i) for i in range(12)]
    vocabulary = spark.createDataFrame([(w, 5 ** (i + 1)) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: r for r in variants.group(vocabulary).collect()}
    assert {r.root for r in got.values()} == {words[-1]}
    assert [got[w].form for w in words] == [*words[1:], None]


@pytest.mark.parametrize("key", ["op11_merkle", "op12_chat", "op13_variants"])
def test_empty(spark, tmp_path, key):
    documents(spark, tmp_path, [])
    path = conversations(spark, tmp_path, [])
    got = queries.QUERIES[key](spark, path).collect()
    assert [r.conv_id for r in got] == [-7] if key == "op12_chat" else got == []
