"""Structured Streaming on top of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from halyard.operators.merge import net_changes, upsert
from halyard.sources.files import Table


def stream_files(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """Files of a folder as they arrive; a path of one file streams that file alone."""
    reader = spark.readStream.schema(schema).format(fmt)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at) and fs.getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).load(str(at.getParent().toString()))
    return reader.load(path)


def merge_stream(stream: DataFrame, target: Table, keys: list[str], seq: str, checkpoint: str, op: str | None = None, delete: str = "D", keep: int = 2) -> StreamingQuery:
    """Upsert each micro-batch into ``target``: its net changes by key. A batch that runs
    again after a failure gives the same table; older changes never replace newer ones, nor
    bring back a key that was deleted later: deleted keys are kept, with the number of
    their deletion, in a table beside ``target``. Versions but the last ``keep`` are deleted."""
    graves = Table(target.spark, f"{target.path}__deleted", target.fmt)

    def apply(batch: DataFrame, epoch: int) -> None:
        rows = batch if op else batch.withColumn("_op", F.lit("U"))
        name = op or "_op"
        net = net_changes(rows, keys, seq, name)
        gone = F.col(name) == delete
        marks = [t.read().select(*keys, F.col(seq).alias("_since")) for t in (target, graves) if t.exists()]
        if marks:
            known = marks[0] if len(marks) == 1 else marks[0].unionByName(marks[1])
            known = known.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_since").alias("_since"))
            met = net.join(known, [net[k].eqNullSafe(known[f"_k{i}"]) for i, k in enumerate(keys)], "left")
            net = met.filter(F.col("_since").isNull() | (F.col(seq) >= F.col("_since"))).select(*net.columns)
        ended = net.filter(gone).select(*keys, seq)
        # The deletions first: if the batch breaks off after them, it gives the same when it runs again.
        if not ended.isEmpty():
            graves.overwrite(upsert(graves.read(), ended, keys) if graves.exists() else ended)
            graves.vacuum(keep)
        if target.exists():
            target.overwrite(upsert(target.read(), net.withColumn("_gone", gone).drop(name), keys, "_gone"))
        else:
            target.overwrite(net.filter(~gone).drop(name))
        target.vacuum(keep)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and value sums by tumbling window; late rows within the watermark count."""
    stamped = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    return stamped.groupBy(F.window("_at", width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")
