"""Operator 3, exact top-k by inner product with an M-tree, searched best first.

Inner product is no metric, so each integer vector x gets one more component
``sqrt(M - |x|^2)``, with M the largest squared norm, and a query a zero: then
``|q - x|^2 = |q|^2 + M - 2 <q, x>``, and the largest product is the nearest vector.

The top level is a set of pivots that grows with the rows up to MAX_PIVOTS. Vectors go to
their nearest pivot; where these are too many for a block, they are cut into rings by their
distance to it. A block, of a bounded size, is an M-tree of pages: a page's entries hold a
routing vector, its covering radius and its distance to the page's own routing vector. A
query first searches the block where it would itself be; the k-th product found there then
rules out blocks, by pivot and ring, and, within the others, pages and vectors: by the
stored distances an entry is passed over before its own distance is computed wherever
``|d(q, parent) - d(entry, parent)| - radius`` already exceeds the k-th distance.

All queries that meet a block walk it together: each takes its own nearest page in each
round, and those that took the same page share one matrix product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import materialise

SCALE, EVERY, TOP = 256, 50, 5
PIVOTS, BLOCK, LEAF, FANOUT = 32, 4096, 128, 16
#: Bounds on what reaches the driver and all tasks: pivots, and rings of one pivot. Beyond
#: them the rows of a ring are dealt to blocks by hash.
MAX_PIVOTS, RINGS = 1024, 64
#: Queries that meet one block in one task.
CHUNK = 4096
#: Pairs of a query and a block that are handed on at once.
PAIRS = 20_000
#: Distances are roots of differences of doubles: near zero they are off by some 1e-8 of
#: the vectors' norm. Bounds get this share of the norm as room.
SLACK = 1e-6


def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("v")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls: nan
            ends = np.cumsum(sizes)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False) & (odd[ends] == odd[ends - sizes])
            x = np.floor(values * scale)
            at = np.flatnonzero(good)
            rows = [x[e - n : e] for e, n in zip(ends[at].tolist(), sizes[at].tolist(), strict=True)]
            norms = np.array([r @ r for r in rows], np.float64)
            tops = np.array([np.abs(r).max(initial=0) for r in rows], np.float64)
            arrays = [pa.array(rid + np.arange(len(at))), ids.take(pa.array(at)), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(norms), pa.array(sizes[at].astype(np.int32)), pa.array(tops)]
            rid += len(at)
            yield pa.RecordBatch.from_arrays(arrays, ["rid", "vec_id", "x", "norm", "size", "top"])

    return run


def _matrix(raws, dim: int, norms=None, most: float = 0.0) -> np.ndarray:
    """Rows of doubles, filled up with zeros to ``dim``; with norms, one more column that lifts all to one norm."""
    out = np.zeros((len(raws), dim + 1))
    if all(len(raw) == 8 * dim for raw in raws):
        out[:, :dim] = np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), dim)
    else:
        for i, raw in enumerate(raws):
            x = np.frombuffer(raw, np.float64)
            out[i, : len(x)] = x
    if norms is not None:
        out[:, dim] = np.sqrt(np.maximum(most - np.asarray(norms, np.float64), 0))
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    near = _distances(x, x[:1])[:, 0]
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def build(x: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> list[dict]:
    """Pages of an M-tree over lifted vectors; page 0 is the root. A page: ``leaf``,
    ``rows`` (vectors, or routing vectors) of x, ``child`` pages, ``radius`` and
    ``parent`` (distance to the page's own routing vector), by entry."""
    pages: list[dict] = []

    def add(rows: np.ndarray, routing: int) -> int:
        own = len(pages)
        pages.append({})
        if len(rows) <= leaf:
            pages[own] = {"leaf": True, "rows": rows, "child": np.full(len(rows), -1), "radius": np.zeros(len(rows)), "parent": _distances(x[rows], x[[routing]])[:, 0]}
            return own
        n = min(fanout, -(-len(rows) // leaf))
        some = rows[:: max(1, len(rows) // (8 * n))]
        seeds = some[_spread(x[some], n)]
        home = np.argmin(_distances(x[rows], x[seeds]), 1)
        groups = [rows[home == i] for i in range(len(seeds))]
        if max(map(len, groups)) == len(rows):  # equal vectors: any split will do
            groups = np.array_split(rows, n)
            seeds = np.array([g[0] for g in groups])
        groups, seeds = zip(*[(g, s) for g, s in zip(groups, seeds, strict=True) if len(g)], strict=True)
        radius = [float(_distances(x[g], x[[s]]).max()) for g, s in zip(groups, seeds, strict=True)]
        child = [add(g, s) for g, s in zip(groups, seeds, strict=True)]
        rows = np.array(seeds)
        pages[own] = {"leaf": False, "rows": rows, "child": np.array(child), "radius": np.array(radius), "parent": _distances(x[rows], x[[routing]])[:, 0]}
        return own

    if len(x):
        add(np.arange(len(x)), 0)
    return pages


_PAGES = "block long, page int, leaf boolean, x binary, child binary, radius binary, parent binary, rid binary, vec_id binary"


def _build_block(dim: int, most: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid")
        x = _matrix(pdf["x"], dim, pdf["norm"], most)
        rid, vec_id = pdf["rid"].to_numpy(np.int64), pdf["vec_id"].to_numpy(np.int64)
        out = []
        for i, p in enumerate(build(x)):
            r = p["rows"]
            out.append((pdf["block"].iloc[0], i, p["leaf"], x[r].tobytes(), p["child"].astype(np.int64).tobytes(), p["radius"].tobytes(), p["parent"].tobytes(), rid[r].tobytes(), vec_id[r].tobytes()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _PAGES.split(", ")])

    return run


def _exact(top: float, dim: int) -> type:
    """In which numbers products of components up to ``top`` are exact."""
    most = top * top * max(1, dim)
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def _whole(x: np.ndarray, dim: int, kind: type) -> np.ndarray:
    """The components without the lift, as exact numbers of the kind."""
    x = x[:, :dim]
    return np.array([[int(c) for c in row] for row in x], object).reshape(x.shape) if kind is object else x.astype(kind)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, those that a long can't hold as its extremes."""
    p = a @ b.T
    return np.maximum(np.minimum(p, 2**63 - 1), -(2**63)).astype(np.int64) if p.dtype == object else p


class Tree:
    def __init__(self, pages: pd.DataFrame, dim: int, most: float, kind: type = np.float64):
        self.dim, self.most, self.kind, self.pages = dim, most, kind, {}
        for p in pages.itertuples(index=False):
            x = np.frombuffer(p.x, np.float64).reshape(-1, dim + 1)
            ints = [np.frombuffer(b, np.int64) for b in (p.child, p.rid, p.vec_id)]
            self.pages[p.page] = (p.leaf, _whole(x, dim, kind) if p.leaf else x, *ints, np.frombuffer(p.radius, np.float64), np.frombuffer(p.parent, np.float64))
        self.seen = 0  # distances computed

    def search(self, rid: int, q: np.ndarray, k: int, least: float = -np.inf) -> list[tuple[float, int]]:
        """``search_all`` of one query."""
        return self.search_all(np.array([rid]), q[None], k, np.array([least]))[0]

    def search_all(self, rid: np.ndarray, q: np.ndarray, k: int, least: np.ndarray) -> list[list[tuple[float, int]]]:
        """Of each query the k largest (product, vec_id) of at least ``least``, without its own row ``rid``; ties to smaller vec_id."""
        own = _whole(q, self.dim, self.kind)
        lifted = (q * q).sum(1) + self.most
        floor = least.astype(np.float64)
        best: list[list[tuple[float, int]]] = [[] for _ in rid]  # heaps: the worst first

        def reach(i):
            """Nothing farther can be among the results."""
            return np.sqrt(np.maximum(0.0, lifted[i] - 2 * floor[i])) + SLACK * (1 + np.sqrt(lifted[i]))

        far = reach(np.arange(len(rid)))
        queues = [[(0.0, 0, np.nan)] for _ in rid] if self.pages else []
        walking = range(len(queues))
        while walking:
            asked: dict[int, list[tuple[int, float]]] = {}
            for i in walking:
                bound, page, up = heapq.heappop(queues[i])
                if bound > far[i]:
                    queues[i].clear()
                else:
                    asked.setdefault(page, []).append((i, up))
            for page, asks in asked.items():
                leaf, x, child, rids, vec_ids, radius, parent = self.pages[page]
                i, up = (np.array(v) for v in zip(*asks, strict=True))
                # By the stored distances alone; the root has none, and nan is never too far.
                live = ~(np.abs(up[:, None] - parent) - radius > far[i][:, None])
                some, cols = live.any(1), np.flatnonzero(live.any(0))
                i = i[some]
                if not len(i):
                    continue
                self.seen += len(i) * len(cols)
                if leaf:
                    product = _products(own[i], x[cols])
                    hit = (product >= floor[i][:, None]) & (rids[cols] != rid[i][:, None])
                    for r in np.flatnonzero(hit.any(1)).tolist():
                        j, at = int(i[r]), np.flatnonzero(hit[r])
                        if self._take(best[j], product[r, at], vec_ids[cols[at]], k):
                            # rounded down: numbers of 64 bits aren't all doubles
                            floor[j] = max(floor[j], np.nextafter(float(best[j][0][0]), -np.inf))
                            far[j] = reach(j)
                else:
                    d = np.sqrt(np.maximum(lifted[i][:, None] - 2 * (q[i] @ x[cols].T), 0))
                    low = np.maximum(d - radius[cols], 0)
                    for r, c in zip(*(v.tolist() for v in np.nonzero(low <= far[i][:, None])), strict=True):
                        heapq.heappush(queues[i[r]], (float(low[r, c]), int(child[cols[c]]), float(d[r, c])))
            walking = [i for i in walking if queues[i]]
        return [[(s, -v) for s, v in sorted(b, reverse=True)] for b in best]

    @staticmethod
    def _take(best: list[tuple[float, int]], product: np.ndarray, vec_ids: np.ndarray, k: int) -> bool:
        """Put products into the heap of the k largest; whether it is full."""
        for at in np.lexsort((vec_ids, -product)).tolist():
            item = (product[at].item(), -int(vec_ids[at]))
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
            else:
                break
        return len(best) == k


_FOUND = "rid long, query_id long, vec_id long, score long"


def _search_block(dim: int, most: float, k: int, kind: type):
    def run(pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pages) and len(queries):
            least = queries["least"].astype("float64").fillna(-np.inf).to_numpy()
            rid = queries["rid"].to_numpy(np.int64)
            found = Tree(pages, dim, most, kind).search_all(rid, _matrix(queries["x"], dim), k, least)
            out = [(r, i, v, int(s)) for r, i, hits in zip(rid.tolist(), queries["query_id"].tolist(), found, strict=True) for s, v in hits]
        return pd.DataFrame(out, columns=["rid", "query_id", "vec_id", "score"], dtype="int64")

    return run


class Directory:
    """Which block a vector goes to, and how near those of a block can be. Cell
    ``pivot * RINGS + ring`` holds ``count`` rows at distances ``low`` to ``high`` of its
    pivot, in blocks ``cell << 32`` and following."""

    def __init__(self, pivots: np.ndarray, cuts: dict[int, list[float]]):
        self.pivots, self.cuts = pivots, cuts
        self.cell = self.low = self.high = self.blocks = np.empty(0)

    def cells(self, pivot: np.ndarray, away: np.ndarray) -> np.ndarray:
        cell = pivot.astype(np.int64) * RINGS
        for p in np.unique(pivot).tolist():
            mine = pivot == p
            cell[mine] += np.searchsorted(self.cuts.get(p, []), away[mine])
        return cell

    def fill(self, rows: list) -> None:
        """``rows``: (cell, n, low, high)."""
        rows = sorted(rows)
        self.cell, n, self.low, self.high = (np.array(v) for v in zip(*rows, strict=True))
        self.blocks = -(-n // BLOCK)

    def block(self, pivot: np.ndarray, away: np.ndarray, rid: np.ndarray) -> np.ndarray:
        cell = self.cells(pivot, away)
        return (cell << 32) + rid % self.blocks[np.searchsorted(self.cell, cell)]

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """By queries and cells, how near a row can be, from distances to the pivots."""
        d = d[:, self.cell // RINGS]
        return np.maximum(np.maximum(d - self.high, self.low - d), 0)


def top_products(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``
    its k largest inner products with all other rows; exact, ties to smaller vec_id.

    Components are floor(scale * x). Rows with a null vec_id, a null vector, or a null
    or non-finite component take no part. Shorter vectors count as filled up with zeros.
    Repeated rows: each is a query and a candidate. Products that a double does not hold
    exactly are computed in whole numbers; one that a long can't hold counts as its
    extreme. Components above 1e150 are an error. Other columns are left out; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows, _ = materialise(picked.mapInArrow(_quantised(scale), "rid long, vec_id long, x binary, norm double, size int, top double"), "vectors")
    n, most, dim, top = rows.agg(F.count("*"), F.max("norm"), F.max("size"), F.max("top")).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if top > 1e150:
        raise ValueError(f"components up to {top:g}: squares would overflow")
    kind = _exact(top, dim)
    # Pivots: the widest spread of a sample of bounded size. They decide speed, not results.
    many = min(max(PIVOTS, -(-n // BLOCK)), MAX_PIVOTS)
    some = rows.select("x", "norm", F.xxhash64("rid").alias("h")).orderBy("h").limit(8 * many).collect()
    pivots = _matrix([r["x"] for r in some], dim, [r["norm"] for r in some], most)
    pivots = pivots[_spread(pivots, many)]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), 1024):
                pdf = whole.iloc[i : i + 1024]
                d = _distances(_matrix(pdf["x"], dim, pdf["norm"], most), pivots)
                home = d.argmin(1)
                yield pdf.assign(pivot=home.astype("int32"), away=d[np.arange(len(d)), home])

    routed = rows.select("rid", "vec_id", "x", "norm").mapInPandas(route, "rid long, vec_id long, x binary, norm double, pivot int, away double")
    routed, _ = materialise(routed, "routed")
    # At most RINGS - 1 cuts of each pivot; one is cut into as many rings as it fills blocks.
    grid = [i / RINGS for i in range(1, RINGS)]
    cuts = {}
    for r in routed.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("away", grid, 1000).alias("at")).collect():
        rings = min(RINGS, -(-r["n"] // BLOCK))
        cuts[r["pivot"]] = [r["at"][RINGS * i // rings - 1] for i in range(1, rings)]
    where = Directory(pivots, cuts)
    cell = F.pandas_udf(lambda pivot, away: pd.Series(where.cells(pivot.to_numpy(), away.to_numpy())), T.LongType())
    counted = routed.groupBy(cell("pivot", "away").alias("cell")).agg(F.count("*"), F.min("away"), F.max("away"))
    where.fill([tuple(r) for r in counted.collect()])
    block_of = F.pandas_udf(lambda pivot, away, rid: pd.Series(where.block(pivot.to_numpy(), away.to_numpy(), rid.to_numpy())), T.LongType())
    block = block_of("pivot", "away", "rid")
    pages, _ = materialise(routed.withColumn("block", block).groupBy("block").applyInPandas(_build_block(dim, most), _PAGES), "pages")

    asked, _ = materialise(routed.filter(F.col("vec_id") % every == 0).select("rid", F.col("vec_id").alias("query_id"), "x", block.alias("block")), "asked")
    chunks = max(1, -(-asked.count() // CHUNK))
    chunk = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk")
    search = _search_block(dim, most, k, kind)

    def run(queries: DataFrame, name: str) -> DataFrame:
        """Pages go only where queries of their block are."""
        needed = queries.select(F.col("block").alias("_block"), F.col("chunk").alias("_chunk")).distinct()
        copies = pages.join(needed, F.col("block") == F.col("_block")).select(*pages.columns, F.col("_chunk").alias("chunk"))
        found = copies.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInPandas(search, _FOUND)
        return materialise(found, name)[0]

    first = run(asked.select("rid", "query_id", "x", F.lit(None).cast("double").alias("least"), "block", chunk), "first")
    # A little less than the k-th product, as a double may be off by a rounding.
    kth = F.col("s").cast("double") - F.abs(F.col("s").cast("double")) * 1e-12
    known = first.groupBy("rid").agg(F.min("score").alias("s"), F.count("*").alias("c")).select(F.col("rid").alias("_rid"), F.when(F.col("c") >= k, kth).alias("least"))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The blocks that may still hold a result of each query."""
        step = max(1, PAIRS // len(where.cell))
        for whole in batches:
            for at in range(0, len(whole), step):
                pdf = whole.iloc[at : at + step]
                q = _matrix(pdf["x"], dim)
                lifted = (q * q).sum(1) + most
                low = np.maximum(where.bounds(_distances(q, pivots)) - SLACK * (1 + np.sqrt(lifted))[:, None], 0)
                most_product = (lifted[:, None] - low**2) / 2 + SLACK * (lifted + 1)[:, None]
                open_ = most_product >= pdf["least"].astype("float64").fillna(-np.inf).to_numpy()[:, None]
                out = []
                for i, (rid, query_id, x, home, least) in enumerate(zip(pdf["rid"], pdf["query_id"], pdf["x"], pdf["block"], pdf["least"], strict=True)):
                    for j in np.flatnonzero(open_[i]).tolist():
                        base = int(where.cell[j]) << 32
                        for b in range(base, base + int(where.blocks[j])):
                            if b != home:
                                out.append((rid, query_id, x, least, b))
                            if len(out) >= PAIRS:
                                yield pd.DataFrame(out, columns=_ASKED)
                                out = []
                yield pd.DataFrame(out, columns=_ASKED)

    rest = asked.join(known, F.col("rid") == F.col("_rid"), "left").select("rid", "query_id", "x", "block", "least")
    rest = rest.mapInPandas(others, "rid long, query_id long, x binary, least double, block long")
    rest, _ = materialise(rest.select("rid", "query_id", "x", "least", "block", chunk), "rest")
    rank = F.row_number().over(W.partitionBy("rid").orderBy(F.desc("score"), F.asc("vec_id")))
    return first.unionByName(run(rest, "second")).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_ASKED = ["rid", "query_id", "x", "least", "block"]


def top_products_sql(k: int = TOP, every: int = EVERY, scale: int = SCALE) -> str:
    """Brute force over rows of one length."""
    return f"""
    WITH v AS (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % {every} = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {k}
    """
