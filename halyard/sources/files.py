"""Files and tables in any store that Spark reads (Hadoop FS paths only, no local file calls)."""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard import schemas


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _as_text(ddl: str, spark: SparkSession):
    from pyspark.sql import types as T

    # Every cell is read as text, in the declared order; Silver types it.
    return T.StructType([T.StructField(c.strip().split(" ")[0], T.StringType()) for c in _columns(ddl)])


def _columns(ddl: str) -> list[str]:
    out, depth, part = [], 0, ""
    for ch in ddl:
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


def read_csv(spark: SparkSession, path: str, entity: str | None = None) -> DataFrame | None:
    """A CSV with a header, every column text; None if there is no such path.

    With ``entity`` its columns come first, in declared order, null where the file lacks
    one; columns that the file has besides are kept (schema drift)."""
    if not exists(spark, path):
        return None
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", False).csv(path)
    if entity is None:
        return df
    declared = [c.strip().split(" ")[0] for c in _columns(schemas.SOURCES[entity])]
    has = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in has else F.lit(None)).cast("string").alias(c) for c in declared], *[F.col(f"`{c}`") for c in df.columns if c not in declared])


def read_bundle(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame | None:
    """Resources of FHIR bundles: one row each, with the union of all fields; None if there is
    no such path. ``multiline`` False reads newline-delimited bundles, which split."""
    if not exists(spark, path):
        return None
    raw = spark.read.schema(schemas.FHIR_BUNDLE).option("multiLine", multiline).json(path)
    return unnest(raw)


def unnest(raw: DataFrame, column: str = "entry", field: str = "resource") -> DataFrame:
    """``entry[].resource`` as rows and columns; nothing where the column is missing."""
    if column not in raw.columns:
        return raw.limit(0)
    return raw.select(F.explode(column).alias("_e")).select(f"_e.{field}.*")


def with_lineage(df: DataFrame, run_id: str, as_of) -> DataFrame:
    return df.withColumns({"ingestion_timestamp": F.lit(as_of).cast("timestamp"), "pipeline_run_id": F.lit(run_id)})


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A database table; with a numeric ``key`` and its bounds read in parallel. The driver's jar is the caller's."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


#: Appends of one process go one by one: two jobs that append to a folder at the same
#: time would delete each other's temporary files.
_APPENDING = threading.Lock()


class Table:
    """A table at a path, each overwrite in a version folder of its own.

    Pointer files, named by their number alone, name a version folder each; the last one
    counts. Readers see the old table or the new one, a table can be read while its next
    version is written, and a failed write changes nothing. Two writers that start from one
    version meet on the next number: the second gets an error and no update is lost, on
    stores that create a file atomically (HDFS, local files, ABFS). Plain S3 doesn't; there a
    path needs one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self._seen: int | None = None  # the version that this object has read or written

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _numbers(self) -> list[int]:
        fs, path = self._fs()
        at = path(f"{self.path}/_pointers")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []

    def _folder(self, number: int) -> str | None:
        """The version folder that a pointer names; None for one whose writer died before it named any."""
        fs, path = self._fs()
        stream = fs.open(path(f"{self.path}/_pointers/{number:012d}"))
        try:
            return stream.readUTF() if stream.available() else None
        finally:
            stream.close()

    def _latest(self) -> tuple[int, str] | None:
        for number in reversed(self._numbers()):
            if folder := self._folder(number):
                return number, folder
        return None

    def version(self) -> str | None:
        """The version in use: the folder that the last pointer names."""
        found = self._latest()
        return found and found[1]

    def exists(self) -> bool:
        return self.version() is not None

    def read(self) -> DataFrame:
        found = self._latest()
        if found is None:
            raise FileNotFoundError(f"no table at {self.path}")
        self._seen = found[0]
        # Appends with further columns are one table: the schemas of its files are merged.
        return self.spark.read.option("mergeSchema", True).format(self.fmt).load(f"{self.path}/{found[1]}")

    def overwrite(self, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """The next version. It follows the one that this object has read: if another
        writer was faster, that is an error."""
        fs, path = self._fs()
        numbers = self._numbers()
        # Numbers whose writer died are passed over.
        last = numbers[-1] if numbers else 0
        if self._seen is not None and (found := self._latest()) and found[0] != self._seen:
            raise RuntimeError(f"{self.path}: version {found[0]} was written by another run")
        version = f"v-{uuid.uuid4().hex}"
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.path}/{version}")
        fs.mkdirs(path(f"{self.path}/_pointers"))
        number = last + 1
        at = path(f"{self.path}/_pointers/{number:012d}")
        try:
            stream = fs.create(at, False)  # fails if another writer took this number
        except Py4JJavaError as e:
            fs.delete(path(f"{self.path}/{version}"), True)
            raise RuntimeError(f"{self.path}: version {number} was written by another run") from e
        stream.writeUTF(version)
        stream.close()
        self._seen = number

    def append(self, df: DataFrame) -> None:
        """Adds rows to the version in use (logs); a new table starts its first version."""
        with _APPENDING:
            if not self.exists():
                self.overwrite(df)
                return
            df.write.format(self.fmt).mode("append").save(f"{self.path}/{self.version()}")

    def _files(self) -> list[str]:
        fs, path = self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/{self.version()}")))

    def rewrite(self, change) -> None:
        """Replace the table by ``change`` of it, with all rows that are appended meanwhile:
        appends of this process wait, and where files of another were added it starts over."""
        with _APPENDING:
            while True:
                before = self._files()
                kept = self.read()
                new = change(kept)
                staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
                new.write.format(self.fmt).save(staged)
                fs, path = self._fs()
                if self._files() == before:
                    self.overwrite(self.spark.read.schema(new.schema).format(self.fmt).load(staged))
                    fs.delete(path(staged), True)
                    return
                fs.delete(path(staged), True)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the last ``keep`` versions."""
        fs, path = self._fs()
        for number in self._numbers()[: -keep or None]:
            if folder := self._folder(number):
                fs.delete(path(f"{self.path}/{folder}"), True)
            fs.delete(path(f"{self.path}/_pointers/{number:012d}"), False)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns of either, null where a side lacks one; a column of two types is an error."""
    types = dict(old.dtypes)
    clash = [c for c, t in new.dtypes if c in types and types[c] != t]
    if clash:
        raise AnalysisException(message=f"columns changed their type: {', '.join(clash)}")
    return old.unionByName(new, allowMissingColumns=True)
