"""What the operators share: written tables that cut lineage, and Arrow passes whose code reaches every executor."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import vitalis
from vitalis.session import checkpoint_dir

_SHIPPED: set[str] = set()
_LIBC = ctypes.CDLL(None)  # malloc_trim: glibc only


def folder(spark: SparkSession, name: str) -> str:
    """A new path under the session's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vitalis-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` begins with, for columns that an operator adds on the way."""
    out = "__"
    while any(c.startswith(out) for c in df.columns):
        out += "_"
    return out


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(vitalis.__file__).parent
    with tempfile.NamedTemporaryFile(prefix="vitalis-", suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(f.name)
    _SHIPPED.add(app)


def release() -> None:
    """Hands memory that Arrow and the C library hold free back to the machine."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``f`` over the batches of each task.  Python workers outlive their tasks, so what is free goes back before (tables of an
    earlier task are gone by then) and after, not only when the worker ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from f(batches)
        release()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def hash_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """The rows of ``df`` whose ids have the ``most`` least hashes: the same in every run, however the rows lie.  Only hashes
    are sorted, and one number comes back."""
    h = F.xxhash64(key)
    edge = df.where(F.col(key).isNotNull()).select(h.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return df.where(F.col(key).isNotNull() & (h <= F.lit(edge)))
