"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import bpe, chat, decontaminate, html_extract, licenses, merkle, neardup, pii, quality, secrets, sharding, spans, tokenfile, variants
from vitalis.llm.scratch import folder, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    both = F.array_sort(F.array_union(licenses.labels(F.col("base")), licenses.labels(F.col("detections"))))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        F.array_join(licenses.labels(F.col("base")), ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        licenses.score(F.col("base"), F.col("detections")).alias("score"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in secrets.KINDS}
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(spans.listed(base), 256).alias("base_sha256"),
        spans.listed(base | {"random": F.col("random")}).alias("spans"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return found.select(
        "doc_id",
        "hits.n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hits.items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.with_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_bpe(spark: SparkSession, sf_dir: str, ranks: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    vocabulary = bpe.broadcast(spark, public_tokenizers.path(ranks))
    back = bpe.with_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, decoded="decoded").drop("text")
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in pii.KINDS}
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(spans.listed(base), 256).alias("base_sha256"),
        spans.listed(base | {"term": F.col("term")}).alias("spans"),
    )


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"), shingle=3, similarity=(85, 100))


def op9_tokenfile(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    path = folder(spark, "token-ids")
    tokenfile.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(vocabulary), end_id=0)
    found = tokenfile.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return tokenfile.with_start(found, spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), folder(spark, "manifest")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest(*fields, lowered))
    merkle.write(docs, path, carry={"tampered": tampered})
    proved = merkle.proofs(spark, path).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "node"), F.col("proof")))
    return proved.select(
        F.col("key").alias("doc_id"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    formatted = written(chat.formatted(turns.union(extra), chat.INST), "chat")
    return chat.read_back(formatted, chat.INST).select(F.col("key").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.words(table(spark, sf_dir, "documents"), typo=199))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_html": op4_html,
    "op5_sharding": op5_sharding,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_neardup": op8_neardup,
    "op9_tokenfile": op9_tokenfile,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_chat": op12_chat,
    "op13_variants": op13_variants,
}
