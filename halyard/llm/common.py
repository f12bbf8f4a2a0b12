"""What the training-data operators share: shared-folder tables and word rules."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.config import shared_dir

#: A word is a run of anything but space and the five ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut,
    and a lost executor costs no recomputation. Returns the table and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/halyard-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``materialise`` wrote and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p).getParent()
        at.getFileSystem(conf).delete(at, True)
    jvm.System.gc()  # shuffle files go when the driver's references to them are collected


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, Callable[[], None]]:
    """``materialise``, in buckets of ``key``: later joins on it move the other side alone.
    Returns the table and a function that deletes it."""
    spark = df.sparkSession
    name = f"halyard_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}/rows"
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(many, key).sortBy(key).option("path", path).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        release(spark, path)

    return spark.table(name), drop


def boxed(docs: DataFrame, **helpers) -> DataFrame:
    """All columns of ``docs`` in one struct ``row`` beside the helper columns, so that no
    name of theirs, dots included, can clash with a helper's. ``row.*`` has them back."""
    whole = F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns]).alias("row")
    return docs.select(whole, *[v.alias(k) for k, v in helpers.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Rows that a Python worker gets at once: texts are long, and Spark's 10,000 are many megabytes.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers that read texts: batches of BATCH_ROWS rows for
    this session, unless it has set fewer."""
    if not 0 < int(spark.conf.get(_BATCH, "10000")) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(col: str, n: int):
    """crc32 of the column as text, modulo ``n``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


#: Words longer than this are not kept in any cache or broadcast table: a bound on entries
#: is a bound on memory.
LONG_WORD = 64


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8. ``bytes`` splits at exactly
    space and 9-13 and lowers exactly A-Z; ``str`` would do more."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers are kept and
    go on to serve other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
