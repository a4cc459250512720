"""Exact top-k by inner product: norm-sorted vectors, SVD-rotated partial sums,
Cauchy-Schwarz pruning.

1. The vectors' Gram matrix, summed in Spark, gives the rotation (the right
   singular vectors) that gathers most of every vector's length in its leading
   components.
2. The vectors are cut into blocks by descending length: bands between
   quantiles of length, split by a hash where a band is large.
3. The blocks of the longest vectors score all queries first.  The k-th best
   score so far is each query's bar.
4. Queries travel in parts of like length.  A part meets a band only if, for one
   of its queries, length times the band's greatest length reaches the bar; only
   then do the band's blocks move to it.  In a block, vectors come by descending length in
   steps; the leading components' partial product plus the product of the
   residual lengths bounds each score, and only pairs that reach the bar, which
   rises with each step, are scored, in whole numbers.

A block and a part are one group of bounded size, and its results are at most k
rows a query.  Products that may pass 64 bits are taken in whole numbers of any
size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import prepare, stored

K, EVERY, SCALE = 20, 20, 64
#: Below this length two vectors' product fits 64 bits.
NARROW = 2.0**30.5
#: Largest score that is ranked exactly, and what the result can hold.
WIDEST, LONGEST = 10**38 - 1, (1 << 63) - 1
#: Vectors of a candidate block and of a query block; steps within a block; bands of length at most.
BLOCK, QUERIES, STEP, BANDS = 4096, 1024, 512, 200
#: Share of the squared length that the leading components hold.
LEADING = 0.8


def whole(vector: Column) -> Column:
    """floor(64 * x) of each component, exact as a double; null if the vector is
    null or empty, or a component is null or not finite."""

    def floored(x: Column) -> Column:
        x = x.cast("double")
        large = F.greatest(F.least(x * SCALE, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))  # whole already
        return F.when(F.abs(x) < 2.0**46, F.floor(x * SCALE).cast("double")).when(~F.isnan(x) & (F.abs(x) < float("inf")), large)

    scaled = F.transform(vector, floored)
    return F.when((F.size(vector) > 0) & ~F.exists(scaled, lambda x: x.isNull()), scaled)


def gram(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the sum of the vectors' outer products, summed in
    tasks and then over tasks: dim**2 numbers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for f in frames:
            for dim, part in f.groupby("dim"):
                m = np.stack(part["v"].to_numpy())
                m = m[np.abs(m).max(1) < NARROW]  # the rotation only steers; huge vectors would drown all others
                sums[dim] = sums.get(dim, 0) + m.T @ m
        yield pd.DataFrame([(dim, i, row.tolist()) for dim, m in sums.items() for i, row in enumerate(m)], columns=["dim", "i", "row"])

    parts = vectors.select("dim", "v").mapInPandas(run, "dim int, i int, row array<double>")
    sums = parts.select("dim", "i", F.posexplode("row").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():  # dim**2 rows a dimension
        out.setdefault(r.dim, np.zeros((r.dim, r.dim)))[r.i, r.j] = r.x
    return out


def rotation(m: np.ndarray) -> tuple[np.ndarray, int]:
    """Columns by falling singular value, and how many of them lead."""
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(vectors), min(len(values), int(np.searchsorted(share, LEADING)) + 1)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths, finite whatever the components."""
    top = np.maximum(np.abs(vectors).max(1), 1.0)
    with np.errstate(over="ignore"):
        return np.minimum(top * np.linalg.norm(vectors / top[:, None], axis=1), sys.float_info.max)


def search_block(queries: np.ndarray, query_ids: np.ndarray, bars: np.ndarray, vectors: np.ndarray, ids: np.ndarray, turn: np.ndarray, lead: int, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's best k in the block that reach its bar."""
    length, q_length = (lengths(x) for x in (vectors, queries))
    order = np.lexsort((ids, -length))
    vectors, ids, length = vectors[order], ids[order], length[order]
    narrow, q_narrow = length < NARROW, q_length < NARROW
    small, q_small = (np.where(n[:, None], x, 0).astype(np.int64) for n, x in ((narrow, vectors), (q_narrow, queries)))
    q_turned, turned = q_small.astype(float) @ turn, small.astype(float) @ turn
    q_rest, rest = (np.sqrt((x[:, lead:] ** 2).sum(1)) for x in (q_turned, turned))
    bars = bars.astype(float)
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # (-score, id), ascending
    for at in range(0, len(ids), STEP):
        with np.errstate(over="ignore"):
            live = np.flatnonzero(q_length * length[at] * (1 + 1e-9) + 1e-6 >= bars)
        if not len(live):
            break
        part = slice(at, at + STEP)
        exact = q_narrow[live][:, None] & narrow[part]
        bound = q_turned[live, :lead] @ turned[part, :lead].T + np.outer(q_rest[live], rest[part])
        slack = 1e-6 + 1e-9 * np.outer(np.minimum(q_length[live], NARROW), np.minimum(length[part], NARROW))
        i, j = np.nonzero(~exact | (bound + slack >= bars[live][:, None]))
        own = query_ids[live[i]] == ids[at + j]
        i, j = live[i[~own]], at + j[~own]
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            scores = np.einsum("ij,ij->i", q_small[a], small[b])
            wide = np.flatnonzero(~(q_narrow[a] & narrow[b]))
            if len(wide):
                scores = scores.astype(object)
                for n in wide.tolist():
                    x = sum(int(p) * int(q) for p, q in zip(queries[a[n]].tolist(), vectors[b[n]].tolist(), strict=True))
                    scores[n] = max(-WIDEST, min(WIDEST, x))
            good = (scores >= bars[a]).astype(bool)
            a, b, scores = a[good], b[good], scores[good]
            rank = np.array(sorted(range(len(a)), key=lambda n: (a[n], -scores[n], ids[b[n]])), np.int64) if scores.dtype == object else np.lexsort((ids[b], -scores, a))
            a, b, scores = a[rank], b[rank], scores[rank]
            first = np.searchsorted(a, a)
            near = np.arange(len(a)) - first < k
            for x, s, v in zip(a[near].tolist(), scores[near].tolist(), ids[b[near]].tolist(), strict=True):
                best[x].append((-s, v))
            for x in np.unique(a).tolist():
                best[x] = sorted(best[x])[:k]
                if len(best[x]) == k:
                    bars[x] = max(bars[x], float(-best[x][-1][0]))
    return [(int(query_ids[x]), v, -s) for x, rows in enumerate(best) for s, v in rows]


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def live_pairs(queries: DataFrame, bands: DataFrame, blocks: DataFrame) -> DataFrame:
    """(part, block, greatest): the parts of queries and the blocks in which one of
    their vectors may reach a query's bar, from bands (dim, band, greatest), of
    which there are at most ``BANDS`` a dimension, and blocks (dim, band, block)."""
    need = F.when(F.col("length") > 0, (F.col("bar") - 1e-6) / (F.col("length") * (1 + 1e-9))).when(F.col("bar") <= 1e-6, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    parts = queries.groupBy("dim", "part").agg(F.min(need).alias("need"))
    live = parts.join(F.broadcast(bands), "dim").where(F.col("greatest") >= F.col("need"))
    return live.join(blocks, ["dim", "band"]).select("part", "block", "greatest")


def query_groups(bands: list) -> list[tuple[int, int, int, int]]:
    """(dim, band, group, parts): neighbouring bands share a group until it has
    QUERIES queries; a band of more is a group that is split in parts."""
    out, group, held, last = [], 0, 0, None
    for r in sorted(bands, key=lambda r: (r.dim, r.band)):
        if r.dim != last or held + r.queries > QUERIES:
            group, held, last = group + 1, 0, r.dim
        held += r.queries
        out.append((r.dim, r.band, group, max(1, -(-r.queries // QUERIES))))
    return out


def _meet(queries: DataFrame, vectors: DataFrame, turns: dict[int, tuple[np.ndarray, int]], bands: DataFrame, k: int, score: str) -> DataFrame:
    """(query_id, vec_id, score) of the vectors in the given bands and the queries that can reach them."""
    wide = score != "long"

    def pair(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(q) and len(v):
            turn, lead = turns[int(v["dim"].iloc[0])]
            rows = search_block(np.stack(q["query"].to_numpy()).astype(float), q["query_id"].to_numpy(), q["bar"].to_numpy(), np.stack(v["v"].to_numpy()).astype(float), v["vec_id"].to_numpy(), turn, lead, k)
        return pd.DataFrame([(a, b, Decimal(s)) for a, b, s in rows] if wide else rows, columns=["query_id", "vec_id", "score"])

    blocks = vectors.select("dim", "band", "block").distinct()
    pairs = stored(live_pairs(queries, bands, blocks), "live-pairs")
    near = queries.join(pairs, "part").where(F.col("length") * F.col("greatest") * (1 + 1e-9) + 1e-6 >= F.col("bar"))
    left = near.select("block", "part", F.col("vec_id").alias("query_id"), "bar", F.col("v").alias("query"))
    right = vectors.join(pairs.select("part", "block"), "block").select("block", "part", "vec_id", "dim", "v")
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(pair, f"query_id long, vec_id long, score {score}")


def top_inner_products(table: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by
    ``every`` its k highest inner products with other rows (all, if fewer), ties
    to the smaller vec_id, over components floor(64 * x).

    Rows take no part if vec_id or the vector is null, the vector is empty, or a
    component is null or not finite; all others do, however long.  Scores are
    ranked exactly up to 38 digits; a score beyond 64 bits is returned as the
    nearest that fits.  Vectors of different dimension don't meet.  Rows that
    share a vec_id are one query each but not each other's candidates; rows
    repeated exactly are one row.  An empty table gives no rows; other columns
    are not read.
    """
    prepare(table.sparkSession)
    vectors = table.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v")).where("vec_id is not null and v is not null")
    # beyond the range of doubles a length is the greatest of them, which prunes nothing
    length = F.least(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.lit(sys.float_info.max))
    vectors = stored(vectors.dropDuplicates(["vec_id", "v"]).select("vec_id", "v", F.size("v").alias("dim"), length.alias("length")), "vectors")
    turns = {dim: rotation(m) for dim, m in gram(vectors).items()}
    marks = vectors.groupBy("dim").agg(F.count("*").alias("n"), F.percentile_approx("length", [i / BANDS for i in range(1, BANDS)], 10_000).alias("marks"), F.max("length").alias("longest")).collect()
    score = "long" if all(r.longest < NARROW for r in marks) else "decimal(38,0)"
    band = F.lit(0)
    for r in marks:  # at most BANDS numbers a dimension; longest first
        wanted = max(1, min(BANDS, r.n // block))
        cuts = sorted({r.marks[int(i * BANDS / wanted) - 1] for i in range(1, wanted)})
        band = F.when(F.col("dim") == r.dim, sum((F.when(F.col("length") < c, 1).otherwise(0) for c in cuts), F.lit(0))).otherwise(band)
    banded = vectors.withColumn("band", band)
    counts = banded.groupBy("dim", "band").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / block))
    placed = banded.join(F.broadcast(counts.select("dim", "band", "parts")), ["dim", "band"])
    if score == "long":
        placed = placed.withColumn("v", F.col("v").cast("array<int>"))
    blocked = stored(placed.withColumn("block", F.xxhash64("dim", "band", F.pmod(F.xxhash64("vec_id"), "parts"))).drop("parts"), "blocks")
    bands = blocked.groupBy("dim", "band").agg(F.max("length").alias("greatest"), F.count_if(F.col("vec_id") % every == 0).alias("queries")).collect()  # at most BANDS a dimension
    if not bands:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first: dict[int, int] = {}
    for r in bands:
        first[r.dim] = min(r.band, first.get(r.dim, r.band))
    table_of = lambda rows: table.sparkSession.createDataFrame([(r.dim, r.band, r.greatest) for r in rows], "dim int, band int, greatest double")
    head, tail = ([r for r in bands if (r.band == first[r.dim]) == longest] for longest in (True, False))
    sizes = F.broadcast(table.sparkSession.createDataFrame(query_groups(bands), "dim int, band int, group int, parts long"))
    queries = blocked.where(F.col("vec_id") % every == 0).join(sizes, ["dim", "band"])
    queries = queries.select("vec_id", "v", "dim", "length", F.xxhash64("group", F.pmod(F.xxhash64("vec_id", F.lit(1)), "parts")).alias("part"))
    lowest = F.lit(-1e300)
    best = _top(_meet(queries.withColumn("bar", lowest), blocked, turns, table_of(head), k, score), k)
    if tail:
        best = stored(best, "best")
        bars = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bar"))
        barred = queries.join(bars, "vec_id", "left").withColumn("bar", F.coalesce("bar", lowest))
        best = _top(best.drop("rank").unionByName(_meet(barred, blocked, turns, table_of(tail), k, score)), k)
    fits = F.greatest(F.least(F.col("score"), F.lit(LONGEST)), F.lit(-LONGEST - 1)).cast("long")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", fits.alias("score"))
