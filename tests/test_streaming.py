from datetime import datetime

from halyard.sources.files import Table
from halyard.streaming.ingest import merge_stream, stream_files, windowed_counts

SCHEMA = "k int, v string, seq int, op string"


def test_merge_stream_and_its_rerun(spark, tmp_path):
    source, target = str(tmp_path / "in"), Table(spark, str(tmp_path / "out"))
    spark.createDataFrame([(1, "a", 1, "I"), (2, "b", 1, "I"), (1, "A", 2, "U")], SCHEMA).coalesce(1).write.parquet(source)

    def run():
        merge_stream(stream_files(spark, source, SCHEMA), target, ["k"], "seq", str(tmp_path / "ck"), "op").awaitTermination()
        return sorted((r.k, r.v) for r in target.read().collect())

    assert run() == [(1, "A"), (2, "b")]
    spark.createDataFrame([(2, "b", 3, "D"), (1, "old", 1, "U"), (3, "c", 1, "I")], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, "A"), (3, "c")]
    assert run() == [(1, "A"), (3, "c")]  # nothing new


def test_a_stale_change_does_not_bring_back_a_deleted_key(spark, tmp_path):
    source, target = str(tmp_path / "in"), Table(spark, str(tmp_path / "out"))

    def arrive(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        merge_stream(stream_files(spark, source, SCHEMA), target, ["k"], "seq", str(tmp_path / "ck"), "op").awaitTermination()
        return sorted((r.k, r.v) for r in target.read().collect())

    assert arrive((1, "a", 5, "U"), (2, "b", 1, "U")) == [(1, "a"), (2, "b")]
    assert arrive((1, None, 9, "D")) == [(2, "b")]
    assert arrive((1, "old", 3, "U")) == [(2, "b")]
    assert arrive((1, "new", 12, "U")) == [(1, "new"), (2, "b")]
    assert arrive((1, "older", 11, "U")) == [(1, "new"), (2, "b")]
    assert len(target._numbers()) == 2  # older versions are deleted


def test_windowed_counts_close_with_the_watermark(spark, tmp_path):
    rows = [(datetime(2024, 1, d, h), "x") for d in (1, 2, 3) for h in (1, 2)]
    source = str(tmp_path / "ev")
    spark.createDataFrame(rows, "ts timestamp_ntz, kind string").coalesce(1).write.parquet(source)
    stream = windowed_counts(stream_files(spark, source, "ts timestamp_ntz, kind string"), "ts", "kind")
    q = stream.writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.window_start.day, r.n) for r in spark.table("closed").collect()) == [(1, 2), (2, 2)]
