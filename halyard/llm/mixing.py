"""Operator 5, mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / size of the source`` copies. The
documents stand in order of size; their expected copies are summed up, one random
offset is added, and a document is emitted once for each integer that its own span
crosses. In order of size, the error of a source's taken words is at most its largest
document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, boxed, materialise

SEED = 20240229
SALTS = 256


def size_col(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, cap: float = 3.0, cycle: int = 3) -> DataFrame:
    """One row for each source in (source, source_size): adds ``target``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share all words; a
    target stops at ``cap`` times its source and the excess goes to the others by weight.
    That ends where ``target = min(cap * size, level * weight)`` for the one level at
    which the targets sum up to all sizes: sources fill up in order of
    ``cap * size / weight``, so prefix sums over that order give the level.
    The windows below run over one row for each source, not over documents.
    """
    ranked = sizes.select("source", "source_size", ((F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1).alias("weight"))
    fill = W.orderBy((F.col("source_size") * cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, rest = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    levels = ranked.select(
        "source",
        "source_size",
        "weight",
        ((F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0.0))) / F.sum("weight").over(rest)).alias("level"),
    )
    # A source is full where the level of those not yet full reaches its cap. The level of
    # the first that is not full holds for all; from there on the levels only fall.
    open_level = F.max(F.when(F.col("level") * F.col("weight") < F.col("source_size") * cap, F.col("level"))).over(W.partitionBy())
    return levels.select("source", "source_size", F.least(F.col("source_size") * cap, F.coalesce(open_level * F.col("weight"), F.col("source_size") * cap)).alias("target"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, source, key, size, salt, tie, same): ``row`` has all columns of ``docs``."""
    text_of_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tie = F.md5(F.concat(F.lit(f"{seed}:"), text_of_id).cast("binary"))
    source = F.col("source")
    return boxed(docs, source=source, key=_key(source), size=size_col(F.col("text")), salt=F.substring(tie, 1, 2), tie=tie, same=F.xxhash64("text"))


def _key(source):
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, copies) of every row of ``docs`` (any columns, among
    them doc_id, text, source): ``row`` holds them all, so their names can't clash.

    Null text or one without words: size 0, copies drawn as for any document. Null
    source: a source of its own. Repeated rows: each is drawn for itself. An empty table
    stays empty.
    """
    return draw(sized(docs, seed), seed)


def draw(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``mix`` of ``sized`` rows. Ranks come from counts of small keys (source, size, salt):
    no window holds more than the rows of one key, and a hot source is spread over all its
    sizes and 256 salts."""
    cells = rows.groupBy("key", "source", "size", "salt").agg(F.count("*").alias("n"))
    goal = targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    goal = goal.select(_key(F.col("source")).alias("_g"), "source_size", "target")
    # Rows before a cell: those of smaller sizes, a sum over a source's distinct sizes, and
    # those of the same size in smaller salts, a sum over 256 salts at most.
    sizes = cells.groupBy("key", "size").agg(F.sum("n").alias("n"))
    below = F.coalesce(F.sum("n").over(W.partitionBy("key").orderBy("size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("key", "size", below.alias("below"))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("key", "size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("key", "size", "salt", inside.alias("inside")).join(sizes, ["key", "size"])
    cells = cells.select("key", "size", "salt", (F.col("below") + F.col("inside")).alias("before"))
    cells = cells.join(goal, cells["key"] == goal["_g"]).drop("_g")
    # The same three keys for the rank and the join: the documents are shuffled once.
    rank = F.row_number().over(W.partitionBy("key", "size", "salt").orderBy("tie", "same"))
    placed = rows.drop("source").withColumn("rank", rank).join(cells, ["key", "size", "salt"], "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    i = F.col("before") + F.col("rank") - 1
    copies = F.floor((i + 1) * rate + offset(seed)) - F.floor(i * rate + offset(seed))
    return placed.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def offset(seed: int) -> float:
    """The one random offset, in [0, 1), a function of the seed."""
    import random

    return round(random.Random(seed).random(), 6)


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it has copies, with the columns that it came with."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def mixing_query(docs: DataFrame) -> DataFrame:
    # Words are counted once: what is drawn from has no texts.
    rows, _ = materialise(sized(docs.select("doc_id", "text", "source")).withColumn("row", F.struct("row.doc_id")), "sized")
    m = draw(rows)
    return m.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixing_sql(seed: int = SEED, cap: float = 3.0, relation: str = "documents") -> str:
    u = offset(seed)
    return f"""
    WITH sized AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
             md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS tie FROM {relation}),
    src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
    levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(source_size * CAST({cap} AS DOUBLE)) OVER (ORDER BY source_size * CAST({cap} AS DOUBLE) / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY source_size * CAST({cap} AS DOUBLE) / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    opened AS (SELECT *, max(CASE WHEN level * weight < source_size * CAST({cap} AS DOUBLE) THEN level END) OVER () AS open_level FROM levels),
    goal AS (SELECT source, source_size, least(source_size * CAST({cap} AS DOUBLE), coalesce(open_level * weight, source_size * CAST({cap} AS DOUBLE))) AS target FROM opened),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, tie) - 1 AS i FROM sized),
    rated AS (SELECT r.doc_id, r.size, g.source_size, g.target, r.i, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate
              FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
           size * CAST(floor((i + 1) * rate + CAST({u} AS DOUBLE)) - floor(i * rate + CAST({u} AS DOUBLE)) AS BIGINT) AS taken,
           CAST(floor((i + 1) * rate + CAST({u} AS DOUBLE)) - floor(i * rate + CAST({u} AS DOUBLE)) AS BIGINT) AS copies
    FROM rated
    """
