"""Token ids of a corpus in one Huffman-coded table, and back.

Texts are range-partitioned by id, sorted, encoded with the tokenizers library and laid into blocks of about
``BLOCK_TOKENS`` ids, in ascending id order; an end id closes each text.  A first pass writes the plain blocks and counts
all ids; the canonical code of limited length made from the global counts then packs each block on its own.

The file format is a folder of two Parquet tables, so that any file system Spark knows will do, writes are atomic by task
and a lost executor's blocks are written again:

* ``code``: id, bits.  The canonical code follows from the lengths.
* ``blocks``: part, block (their order is the order of the corpus), keys, n_tokens (ids of each text, end id included),
  packed (code words), checkpoints (bit offset of every 128th id).

A reader needs one block at a time and no other.  The corpus position of a text is the sum of what lies before it, found
from the counts alone.

Defined cases: null and empty texts are just the end id; rows with a null key come first; rows with one key are ordered by a
hash of their text and then as they come, which only matters for equal texts; an empty table gives an empty file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from vitalis.llm.huffman import Code, code_lengths
from vitalis.llm.pieces import Memo
from vitalis.llm.scratch import folder, map_arrow

BLOCK_TOKENS = 1 << 18
TEXTS_AT_ONCE = 256
PIECES_KEPT = 1_600_000
_MEMOS: dict[str, Memo] = {}


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 as itself, the others
    from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def memo(path: str) -> Memo:
    """The library's model behind a memo of pieces; one for each worker process.  The piece bounds are those of the file's
    byte-level pre-tokenizer; the file's added tokens are one id each, as the library has them by default."""
    if path not in _MEMOS:
        library, letters = Tokenizer.from_file(path), dict(enumerate(_byte_letters()))
        tokenize, added = library.model.tokenize, {t.content: i for i, t in library.get_added_tokens_decoder().items()}

        def encode(found: list[str]) -> Iterator[list[int]]:
            for p in found:
                # bytes as Latin-1 characters, these as the vocabulary's letters
                yield [added[p]] if p in added else [t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))]

        _MEMOS[path] = Memo(encode, PIECES_KEPT, "<u4", added)
    return _MEMOS[path]


def _ids(known: Memo, column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text, some hundred texts at a time."""
    for i in range(0, len(column), TEXTS_AT_ONCE):
        found, counts = known.ids_of([t or "" for t in column.slice(i, TEXTS_AT_ONCE).to_pylist()])
        yield from np.split(found, np.cumsum(counts)[:-1])


def _plain_blocks(docs: DataFrame, key: str, text: str, path: str, end_id: int) -> DataFrame:
    """Rows part, block, keys, n_tokens, ids (little-endian; two bytes an id where the vocabulary allows)."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("ids", T.BinaryType())])
    small = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        part, block = TaskContext.get().partitionId(), 0
        keys, sizes, held, total = [], [], [], 0

        def row(like: pa.Array) -> pa.RecordBatch:
            ids = np.concatenate(held)
            packed = ids.astype("<u2") if small else ids
            columns = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, like.type)), pa.array([sizes], pa.list_(pa.int64())), pa.array([packed.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        for batch in batches:
            like = batch.column(0)
            for k, ids in zip(like.to_pylist(), _ids(memo(path), batch.column(1)), strict=True):
                keys.append(k)
                sizes.append(len(ids) + 1)
                held += ids, end
                total += sizes[-1]
                if total >= BLOCK_TOKENS:
                    yield row(like)
                    keys, sizes, held, total = [], [], [], 0
                    block += 1
        if keys:
            yield row(like)

    ordered = docs.select(key, text).withColumn("__tie", F.xxhash64(text)).repartitionByRange(key, "__tie").sortWithinPartitions(key, "__tie")
    return map_arrow(ordered.drop("__tie"), run, schema)


def _width(ids_bytes: int, n: int) -> str:
    return "<u2" if ids_bytes == 2 * n else "<u4"


def _counts(plain: DataFrame) -> DataFrame:
    """How often each id occurs, added up before the shuffle."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("count", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for sizes, ids in zip(batch.column(0), batch.column(1), strict=True):
                raw = ids.as_buffer()
                found = np.bincount(np.frombuffer(raw, _width(raw.size, int(sizes.values.to_numpy().sum()))))
                if len(found) > len(total):
                    total = np.append(total, np.zeros(len(found) - len(total), np.int64))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "count"])

    return map_arrow(plain.select("n_tokens", "ids"), run, schema).groupBy("id").agg(F.sum("count").alias("count"))


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Writes the corpus to the folder ``path`` (see the module's text)."""
    spark = docs.sparkSession
    plain_path = folder(spark, "plain-blocks")
    _plain_blocks(docs, key, text, vocabulary, end_id).write.option("compression", "zstd").parquet(plain_path)
    plain = spark.read.parquet(plain_path)
    # one row for each entry of the vocabulary at most
    rows = _counts(plain).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["count"]
    code = Code(code_lengths(counts))
    spark.createDataFrame([(i, int(b)) for i, b in enumerate(code.lengths.tolist()) if b], "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("packed", T.BinaryType()), T.StructField("checkpoints", T.ArrayType(T.LongType()))])
    held = spark.sparkContext.broadcast(code.lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Code(held.value)
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                raw = one.column(4)[0].as_buffer()
                packed, at = own.pack(np.frombuffer(raw, _width(raw.size, int(one.column(3)[0].values.to_numpy().sum()))).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*one.columns[:4], pa.array([packed], pa.binary()), pa.array([at], pa.list_(pa.int64()))], names=schema.fieldNames())

    map_arrow(plain, run, schema).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows part, block, place (of the text in its block), key, n_tokens, ids (little-endian unsigned 32-bit, end id
    included), in no order; see ``with_start`` for the position in the corpus."""
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/code").collect()}  # bounded by the vocabulary
    table = np.zeros(max(lengths, default=0) + 1, np.uint8)
    table[list(lengths)] = list(lengths.values())
    held = spark.sparkContext.broadcast(table)
    blocks = spark.read.parquet(f"{path}/blocks")
    schema = T.StructType([*blocks.schema.fields[:2], T.StructField("place", T.IntegerType()), T.StructField("key", blocks.schema["keys"].dataType.elementType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(held.value)
        for batch in batches:
            for i in range(len(batch)):
                keys, sizes = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                ids = code.unpack(batch.column(4)[i].as_py(), batch.column(5)[i].values.to_numpy(), int(sizes.sum()))
                at = np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int32)
                found = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(ids.astype("<u4"))])
                same = np.full(len(sizes), 0)
                columns = [batch.column(0).slice(i, 1).take(pa.array(same)), batch.column(1).slice(i, 1).take(pa.array(same)), pa.array(np.arange(len(sizes), dtype=np.int32)), keys, pa.array(sizes), found]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return map_arrow(blocks.select("part", "block", "keys", "n_tokens", "packed", "checkpoints"), run, schema)


def with_start(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``rows`` (with part, block, place) with ``start``: the ids of all texts before.  Sums run over the counts of a block,
    the blocks of a part and the parts; no window holds more than one of these."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "n_tokens")
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)
    sums = blocks.select("part", "block", total.alias("n"))
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("part", "block", inside.alias("block_start")).join(parts, "part")
    own = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__own", own).join(starts, ["part", "block"]).withColumn("start", F.col("part_start") + F.col("block_start") + F.col("__own")).drop("__own", "part_start", "block_start")
