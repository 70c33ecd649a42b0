"""Operators 4 and 5, and the pipeline as a whole."""

import collections
import random
import time
import re
import zlib

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vitalis.llm import bpe, html_extract, queries, sharding
from vitalis.llm.scratch import folder as scratch_folder

SF = "/root/testdata/sf0.001"


def test_pages_of_the_table(spark):
    """The article element holds the main text of these pages; the model must find it whole."""
    import html

    got = {r.page_id: r for r in queries.op4_html(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = r.html[r.html.index("<article>") + 9 : r.html.rindex("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, want, len(want))


@pytest.fixture(scope="module")
def model(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    return html_extract.train(pages[:25]), pages[25:]


def test_held_out_layouts(model):
    trees, pages = model
    rng = np.random.default_rng(99)
    right = total = 0
    for h in pages * 8:
        runs = [html_extract._escaped(t) for _, t in html_extract.Page(h).runs][1:9]
        page = html_extract._layout(rng, runs[0], runs[1:])
        parsed = html_extract.Page(page)
        want = "\n".join(t for n, t in parsed.runs if parsed.nodes[n].kept)
        right += html_extract.extract([page.replace(" " + html_extract.KEEP, "")], trees)[0] == want
        total += 1
    assert right / total > 0.95, (right, total)


def test_odd_pages(model):
    page = """<html><body><header><a href=/>Site</a><p>Welcome to the site.</p></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
    <div id="cookie-notice"><p>We use cookies to improve your experience.</p></div><main><article><h1>Real title</h1><p>First paragraph of
    text, with some words &amp; more.<p>Second para<br>graph &lt;here&gt;.</p><div class="ad">Buy now!</div><script>var x = "<p>no</p>";</script>
    <ul><li>item one<li>item two</ul><section class="comments"><h2>Comments</h2><p>Nice post!</p></section></article></main>
    <aside><p>Related stories and other things</p></aside><form><p>Subscribe</p></form><footer>(c) 2020</footer></body></html>"""
    got = html_extract.extract([page, None, "", "plain text only", "<p>one</p><p>two</p>", "<p>a &am", "</div></p><b>x", "<p>" * 300 + "deep"], model[0])
    assert got[0] == "Real title\nFirst paragraph of text, with some words & more.\nSecond para graph <here>.\nitem one\nitem two"
    assert got[1:] == ["", "", "plain text only", "one\ntwo", "a &am", "x", "deep"]


def test_decoding_is_the_best_consistent_labelling(model):
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(60):
        page = html_extract.Page("")
        for i in range(1, 8):
            up = int(rng.integers(i))
            page.nodes.append(html_extract.Node("div", up, 0, ()))
            page.nodes[up].children.append(i)
        logit = rng.normal(size=8)
        kept = html_extract.decode(page, logit)
        value = lambda k: sum(x if b else -x for x, b in zip(logit, k, strict=True))
        fits = [k for k in itertools.product([False, True], repeat=8) if k[0] and all(k[n.parent] or not k[i] for i, n in enumerate(page.nodes) if i)]
        assert tuple(kept) in fits and abs(value(kept) - max(map(value, fits))) < 1e-9


def test_head_without_end_tag_and_formulas():
    text = lambda h: [t for _, t in html_extract.Page(h).runs]
    assert text("<html><head><title>t</title><meta charset=x><body><p>one</p>two</body></html>") == ["one", "two"]
    assert text("<head><title>t</title><style>a</style><link href=x><p>one") == ["one"]
    assert text("<head><noscript><p>x<body><p>one") == ["one"]
    assert text("<head>\n<script>x</script>\none <b>two</b>") == ["one two"]
    assert text("<head><title>t</title></head><body><template>x</template>one") == ["one"]
    assert text("<p>where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == ["where x=1 holds"]


@pytest.mark.parametrize("n", [10, 300])
def test_share_of_siblings_with_one_tag(n):
    page = html_extract.Page("<div>" + "<p>a</p><ul></ul><ul></ul><ul></ul>" * n + "</div>")
    assert {(page.nodes[i].tag, r[10]) for i, r in enumerate(html_extract.features(page, {})) if i > 1} == {("p", 0.25), ("ul", 0.75)}



@pytest.mark.parametrize("rows", [[], [(1, None, None, "x")] * 3])
def test_empty_pages(spark, tmp_path, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(str(tmp_path / "pages.parquet"))
    assert [tuple(r) for r in queries.op4_html(spark, str(tmp_path)).collect()] == [(1, None, "", 0)] * len(rows)


def shards(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string, size long").write.parquet(str(tmp_path / "documents.parquet"))
    return queries.op5_sharding(spark, str(tmp_path)).collect()


def test_sharding(spark, tmp_path):
    rng = random.Random(1)
    hot = "the same text " * 20
    rows = [(i, hot if rng.random() < 0.35 else "é" * rng.choice([0, 1, 10, 200, 2000]) + str(i), 1, "x", 2) for i in range(3000)] + [(3000, None, 1, "x", 2), (None, "no id", 1, "x", 2), (7, "again", 1, "x", 2), (7, "again", 1, "x", 2)]
    got = shards(spark, tmp_path, rows)
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    load, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(load) == set(range(24)) and max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # equal texts lie together: the hot text fills whole shards, and every other text is cut by a shard's end at most
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for c, s in by_text.items() if c != zlib.crc32(hot.encode())) <= 1


def test_no_range_of_several_keys_is_overfull(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 30)).otherwise(F.col("id").cast("string")).alias("text"))
    records = sharding.sized(docs)
    total = records.agg(F.sum("size")).first()[0]
    cuts = sharding.splitters(records, total, 24)
    load = records.groupBy(sharding._range_of(F.col("__order"), cuts).alias("r")).agg(F.sum("size").alias("n"), F.countDistinct("__order").alias("k")).collect()
    assert all(r.k == 1 or r.n <= 2 * total / (24 * sharding.RANGES) for r in load)


def test_few_and_no_records(spark, tmp_path):
    assert shards(spark, tmp_path / "none", []) == []
    got = shards(spark, tmp_path / "few", [(i, "x", 1, "x", 2) for i in range(3)])
    assert len({r.shard for r in got}) == 3 and all(r.slot == 0 for r in got)


def test_written_shards(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)] + [(5, "text 5")], "doc_id long, text string")
    path = scratch_folder(spark, "test-shards")
    sharding.write(docs, path, 4)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in docs.collect())
    assert back.select("shard").distinct().count() == 4


def test_pipeline(spark):
    """Every stage on what the one before kept, against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    wins = brute.windows([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "personal_data", "encode"]
    vocabulary = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    from vitalis.llm.scratch import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(got)
        if name == "quality":  # so few labels prove no cutoff beyond the base rule
            assert set(got) == {i for i, t in kept.items() if not brute.quality(t)[-1]}
        elif name == "near_duplicates":
            assert set(got) == {i for i, (_, c) in brute.near(list(kept.items()), 5, 80, 100).items() if c == i}
        elif name == "decontaminate":
            assert set(got) == {i for i, t in kept.items() if not brute.contamination(t, wins)[-1]}
        if name == "personal_data":
            assert set(got) == set(kept) and not any(brute.personal(t) for t in got.values())
            assert all(got[i] == t for i, t in kept.items() if not brute.personal(t))
        else:
            assert all(got[i] == kept[i] for i in got)
        kept = got
    last = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(last) == set(kept)
    for i, r in last.items():
        assert bytes(r.ids) == vocabulary.encode(kept[i] or "") and r.n_tokens == len(r.ids) // 4
        assert r.decoded_sha256 == brute.sha(kept[i] or "")


def test_100_000_stray_tags():
    """An end tag of nothing that is open costs no search, however deep the stack."""
    begin = time.monotonic()
    page = html_extract.Page("<div>x</i></b></p>" * 100_000 + "<p>end")
    assert time.monotonic() - begin < 30 and page.runs[-1][1] == "end" and len(page.nodes) == 100_002
