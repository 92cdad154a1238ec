"""Exact top-k inner products over a pivot-distance index.

Every vector belongs to its nearest pivot at some distance, and the index is sorted by pivot and distance:
annuli around pivots. Inner products become distances by one more component that gives all vectors one
length M, and queries 0: the larger the product, the nearer. For a query at distance d from a pivot and an
annulus from a to b, the triangle inequality puts every vector of it at max(d - b, a - d, 0) or farther,
which bounds its products. A query first looks into the annulus that promises most, then into every other
annulus whose bound is not below its k-th best product so far; a task takes its annuli by falling bound and
stops at the first that no query of its block needs. Pivots come from a bounded sample, which decides how
much is pruned and never what is found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapledger.session import written

SCALE = 256
# The sample for pivots, pivots, annuli of a pivot, vectors of a stripe of the index, queries of a block.
SAMPLE, PIVOTS, ANNULI, STRIPE, BLOCK = 2000, 16, 16, 16_384, 4096


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while every partial sum is an exact double, else in longs."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def scaled(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): integer vectors floor(256 * x), without null ids and without vectors that are null or hold
    null or non-finite components."""
    x = F.col(f"`{vector}`")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & x.isNotNull()).where(sound)
    return rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for row, values in zip(out, column, strict=True):
        row[: len(values)] = values
    return out


class Pivots:
    """Pivots in the space with one more component, in which all vectors have length ``reach``."""

    def __init__(self, sample: np.ndarray, reach: float):
        self.reach = reach
        points = self.lifted(sample)
        chosen, gap = [], np.full(len(points), np.inf)
        for _ in range(min(PIVOTS, len(points))):
            at = int(gap.argmax()) if chosen else 0
            if chosen and gap[at] == 0:
                break
            chosen.append(at)
            gap = np.minimum(gap, ((points - points[at]) ** 2).sum(axis=1))
        self.points = points[chosen]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.reach**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0)
        return np.concatenate([vectors.astype(np.float64), np.sqrt(rest)[:, None]], axis=1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(axis=1)[:, None] - 2 * lifted @ self.points.T + (self.points**2).sum(axis=1)[None]
        return np.sqrt(np.maximum(square, 0))

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        return self.distances(np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1))


def bounds(to_pivot: np.ndarray, square: np.ndarray, near: np.ndarray, far: np.ndarray, reach: float) -> np.ndarray:
    """The largest product that queries (rows) may have with vectors of annuli (columns), a little raised
    against rounding."""
    least = np.maximum(np.maximum(to_pivot - far[None], near[None] - to_pivot), 0)
    top = (square[:, None] + reach**2 - least**2) / 2
    return top + 1 + 1e-9 * (np.abs(top) + reach**2)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k highest scores, ties by smaller id; fewer columns leave fewer."""
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(np.broadcast_to(ids, scores.shape), order, 1)


# Below every product; its negative is a long too.
LOWEST = -np.iinfo(np.int64).max


def search(queries: pd.DataFrame, vectors: pd.DataFrame, width: int, reach: float, k: int) -> pd.DataFrame:
    """The k best of a stripe's vectors for each query of a block, annulus by annulus.

    ``queries`` has id, v, floor (a product that k vectors are known to reach) and to_pivot (distances).
    Results below a query's floor are left out.
    """
    q, qid = _matrix(queries["v"], width), queries["id"].to_numpy(np.int64)
    known = queries["floor"].to_numpy(np.int64).copy()
    to_pivot, square = np.stack(queries["to_pivot"].to_list()), (q.astype(np.float64) ** 2).sum(axis=1)
    vectors = vectors.sort_values(["pivot", "annulus", "distance"])
    v, vid = _matrix(vectors["v"], width), vectors["id"].to_numpy(np.int64)
    pivot, distance = vectors["pivot"].to_numpy(), vectors["distance"].to_numpy()
    cell = pivot.astype(np.int64) * ANNULI + vectors["annulus"].to_numpy()
    cuts = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1, [len(cell)]])
    near = np.array([distance[a:b].min() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    far = np.array([distance[a:b].max() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    top = bounds(to_pivot[:, pivot[cuts[:-1]]], square, near, far, reach)
    scores = np.full((len(q), k), LOWEST)
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    for at in np.argsort(-top.max(axis=0), kind="stable"):
        rows = np.nonzero(top[:, at] >= known)[0]
        if not len(rows):
            if top[:, at].max() < known.min():
                break
            continue
        a, b = cuts[at], cuts[at + 1]
        found = _products(q[rows], v[a:b])
        own = qid[rows][:, None] == vid[None, a:b]
        found[own] = LOWEST
        s, i = _best(found, vid[None, a:b], k)
        s, i = np.concatenate([scores[rows], s], axis=1), np.concatenate([ids[rows], i], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        scores[rows], ids[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        known = np.maximum(known, scores[:, k - 1])
    row, column = np.nonzero((scores > LOWEST) & (scores >= queries["floor"].to_numpy(np.int64)[:, None]))
    return pd.DataFrame({"query_id": qid[row], "vec_id": ids[row, column], "score": scores[row, column]})


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Queries are the rows whose key is divisible by ``every``; candidates are all rows but those with the
    query's own key. Ties go to the smaller key. Null keys, null vectors and vectors with null or non-finite
    components take no part; shorter vectors count as ended by zeros, so an empty one scores 0. Of rows that
    repeat a key each counts as a candidate, and a repeated query is asked once for each distinct vector,
    its results taken together. Products and their sums have to fit a long. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    rows = written(scaled(vectors, key, vector), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    facts = rows.agg(F.max(F.size("v")).alias("width"), F.max(norm).alias("square"), F.count("*").alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], result)
    width, reach = max(1, facts["width"]), float(np.sqrt(facts["square"])) * (1 + 1e-12)
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("v").toPandas()
    pivots = Pivots(_matrix(sample["v"], width), reach)

    def place(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            if not len(pdf):
                continue
            away = pivots.distances(pivots.lifted(_matrix(pdf["v"], width)))
            nearest = away.argmin(axis=1)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(pdf["id"], pa.int64()), "v": batch.column(1), "pivot": pa.array(nearest, pa.int32()),
                "distance": pa.array(away[np.arange(len(pdf)), nearest], pa.float64()),
            })

    placed = written(rows.select("id", "v").mapInArrow(place, "id long, v array<bigint>, pivot int, distance double"), "placed")
    spans = placed.groupBy("pivot").agg(F.min("distance").alias("a"), F.max("distance").alias("b")).toPandas()
    wide = dict(zip(spans["pivot"], zip(spans["a"], (spans["b"] - spans["a"]).clip(lower=1e-9), strict=True), strict=True))
    low = F.create_map(*(F.lit(x) for p, (a, _) in wide.items() for x in (int(p), float(a))))
    span = F.create_map(*(F.lit(x) for p, (_, w) in wide.items() for x in (int(p), float(w))))
    ring = F.floor((F.col("distance") - low[F.col("pivot")]) / span[F.col("pivot")] * ANNULI).cast("int")
    index = placed.withColumn("annulus", F.least(ring, F.lit(ANNULI - 1)))
    cells = index.groupBy("pivot", "annulus").agg(
        F.count("*").alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far")
    ).orderBy("pivot", "annulus").toPandas()
    # Stripes of the index: annuli in order up to a stripe's size; one that is larger gets stripes of its own.
    first, parts, made, filled = [], [], -1, STRIPE
    for n in cells["n"]:
        if filled + n > STRIPE:
            made, filled = made + 1, 0
        first.append(made)
        parts.append(max(1, -(-int(n) // STRIPE)))
        filled += n
        if parts[-1] > 1:
            made, filled = made + parts[-1] - 1, STRIPE
    at = F.col("pivot") * ANNULI + F.col("annulus")
    numbers = cells["pivot"] * ANNULI + cells["annulus"]
    begin = F.create_map(*(F.lit(int(x)) for pair in zip(numbers, first, strict=True) for x in pair))
    many = F.create_map(*(F.lit(int(x)) for pair in zip(numbers, parts, strict=True) for x in pair))
    striped = index.withColumn("stripe", begin[at] + F.pmod(F.xxhash64("id", "v"), many[at]).cast("int"))

    asked = rows.where(F.col("id") % every == 0).distinct()
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")), "queries")
    stripes = [(np.array([i for i, (f, p) in enumerate(zip(first, parts, strict=True)) if f <= s < f + p])) for s in range(made + 1)]
    of, near, far = cells["pivot"].to_numpy(), cells["near"].to_numpy(), cells["far"].to_numpy()

    def route(only_best: bool):
        def routed(batches):
            for batch in batches:
                pdf = batch.to_pandas()
                if not len(pdf):
                    continue
                q = _matrix(pdf["v"], width)
                away = pivots.of_queries(q)
                top = bounds(away[:, of], (q.astype(np.float64) ** 2).sum(axis=1), near, far, reach)
                reach_of = np.stack([top[:, own].max(axis=1) for own in stripes], axis=1)
                home = reach_of.argmax(axis=1)
                if only_best:
                    row, stripe = np.arange(len(pdf)), home
                else:
                    wanted = reach_of >= pdf["floor"].to_numpy(np.int64)[:, None]
                    wanted[np.arange(len(pdf)), home] = False
                    row, stripe = np.nonzero(wanted)
                yield pa.RecordBatch.from_pydict({
                    "stripe": pa.array(stripe, pa.int32()), "block": pa.array(pdf["block"].to_numpy()[row], pa.int32()),
                    "id": pa.array(pdf["id"].to_numpy()[row], pa.int64()), "v": batch.column(1).take(pa.array(row, pa.int64())),
                    "floor": pa.array(pdf["floor"].to_numpy(np.int64)[row], pa.int64()),
                    "to_pivot": pa.array(list(away[row]), pa.list_(pa.float64())),
                })
        return routed

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return search(left, right, width, reach, k)

    def round_of(asking: DataFrame, only_best: bool) -> DataFrame:
        shape = "stripe int, block int, id long, v array<bigint>, floor long, to_pivot array<double>"
        sent = asking.select("id", "v", "block", "floor").mapInArrow(route(only_best), shape)
        sent = written(sent, "asked")
        met = sent.select("stripe", "block").distinct().toDF("stripe", "block")
        dealt = striped.join(met, "stripe").select(F.col("stripe").alias("at_stripe"), F.col("block").alias("at_block"), "id", "v", "pivot", "annulus", "distance")
        found = sent.groupBy("stripe", "block").cogroup(dealt.groupBy("at_stripe", "at_block"))
        return written(found.applyInPandas(look, "query_id long, vec_id long, score long"), "found")

    start = round_of(asked.withColumn("floor", F.lit(LOWEST)), True)
    kth = start.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    floor = kth.select(F.col("query_id").alias("id"), F.when(F.size("s") >= k, F.col("s")[k - 1]).alias("floor"))
    again = asked.join(floor, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
    found = start.unionByName(round_of(again, False))
    place_of = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place_of).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def topk_report(vectors: DataFrame) -> DataFrame:
    """The five best of all ``embeddings`` for every fiftieth."""
    return top_k(vectors.select("vec_id", "embedding"))
