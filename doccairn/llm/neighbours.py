"""Approximate nearest neighbours by largest inner product: inverted lists and adaptive dimension scan.

Vectors get one more component that makes all norms equal, so the largest inner product is the
smallest distance; then they are rotated at random. Norms are completed to twice their
``COMMON``-th quantile at most; the few vectors that are longer (under one in twenty) are a list of
their own, which every query scans whole, and a longer query is scaled down, which changes no
order. Lists are Voronoi cells of centroids fitted
on a bounded sample (``SAMPLE`` vectors); every vector is put into its list. A query scans its
own nearest list first, which bounds the distance of its k-th neighbour; then the other probed
lists, whose candidates are read in column blocks. After each block a test on the partial
distance (the rotation makes it an unbiased estimate of the whole) abandons candidates that are
beyond the bound with high confidence. Scores are exact, in double precision, on the original
vectors.

Lists larger than ``BLOCK`` vectors are split by a hash of the row, and queries of one list
beyond ``BLOCK`` as well, so a hot list is many tasks. The driver holds the sample, the centroids
(at most ``MAX_LISTS``) and one count per list.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without id. Ties go to the smaller id. Rows that
repeat an id, or are wholly equal, are queries and candidates each: a query leaves out its own
row only, and has ranks of its own. With fewer than k candidates all are returned. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from doccairn.storage import settle

SAMPLE = 20_000
MAX_LISTS = 1024
BLOCK = 4096
#: Columns read between two tests, and the width of the test in standard errors.
COLUMNS = 16
CONFIDENCE = 2.1
#: Share of the lists that a query probes; at least ``LEAST_LISTS``.
PROBE_SHARE = 0.6
LEAST_LISTS = 16
#: Vectors longer than twice this quantile of the norms are the list that every query scans.
COMMON = 0.95
SEED = 20
FOUND = ("query_row", "query_id", "id", "row", "score")


@dataclass(frozen=True)
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    norm: float
    #: Vectors per list; the last list holds the long vectors and has no centroid.
    counts: np.ndarray

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0.0))
        return np.concatenate([vectors, rest[:, None]], axis=1) @ self.rotation

    def rotated_queries(self, vectors: np.ndarray) -> np.ndarray:
        scale = np.minimum(1.0, self.norm / np.sqrt((vectors**2).sum(axis=1)))
        return np.concatenate([vectors * scale[:, None], np.zeros((len(vectors), 1))], axis=1) @ self.rotation


def usable(base: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    rows = base.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0.0))
    common = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.where(F.size("vector") == (common["length"] if common else 0))


def square() -> Column:
    """The square of a vector's norm."""
    return F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2.0 * a @ b.T


def centroids_of(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm on the sample."""
    draw = np.random.default_rng(SEED)
    centres = sample[draw.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([squared(part, centres).argmin(axis=1) for part in np.array_split(sample, len(sample) // BLOCK + 1)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def build(vectors: DataFrame) -> tuple[DataFrame, Index] | None:
    """Settled table of list, id, vector and rotated vector, and its index; None if empty."""
    length = F.sqrt(square())
    known = vectors.agg(
        F.count("*").alias("n"), F.max(length).alias("longest"), F.percentile_approx(length, COMMON).alias("common")).first()
    total = known["n"]
    if not total:
        return None
    share = min(1.0, SAMPLE / total)
    norm = min(known["longest"], 2.0 * known["common"])
    common = vectors.where(length <= norm)
    rows = common.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE * 2).collect()
    if not rows:
        rows = common.limit(SAMPLE).collect()
    rows.sort(key=lambda r: (r["id"], r["vector"]))
    sample = np.array([r["vector"] for r in rows])
    width = sample.shape[1] + 1
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))[0]
    blank = Index(rotation, np.zeros((0, width)), float(norm), np.zeros(0))
    lists = int(min(MAX_LISTS, max(1, round(np.sqrt(total)))))
    shared = SparkSession.active().sparkContext.broadcast(
        Index(rotation, centroids_of(blank.rotated(sample), lists), blank.norm, blank.counts))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            for part in (batch.iloc[i : i + BLOCK] for i in range(0, len(batch), BLOCK)):
                turned = index.rotated(np.stack(part["vector"].to_numpy()))
                nearest = np.where(part["long"], len(index.centroids), squared(turned, index.centroids).argmin(axis=1))
                yield part.drop(columns="long").assign(list=nearest, turned=list(turned))

    placed = settle(
        vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("long", length > norm).mapInPandas(
            assign, "id long, vector array<double>, row long, list int, turned array<double>"), "vector-lists")
    index = shared.value
    counts = np.zeros(len(index.centroids) + 1, dtype=np.int64)
    for row in placed.groupBy("list").count().collect():
        counts[row["list"]] = row["count"]
    return placed, Index(index.rotation, index.centroids, index.norm, counts)


def scan(query: np.ndarray, candidates: np.ndarray, bound: float) -> np.ndarray:
    """Places of the candidates that no test abandons; ``bound`` is a squared distance."""
    width, alive = candidates.shape[1], np.arange(len(candidates))
    partial = np.zeros(len(candidates))
    for begin in range(0, width, COLUMNS):
        end = min(begin + COLUMNS, width)
        gap = candidates[alive, begin:end] - query[begin:end]
        partial = partial + (gap * gap).sum(axis=1)
        slack = 1.0 if end == width else (1.0 + CONFIDENCE / np.sqrt(end)) ** 2
        keep = partial * (width / end) <= bound * slack + 1e-9
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return alive


def _search_block(k: int):
    def search(queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(base):
            turned, vectors = np.stack(base["turned"].to_numpy()), np.stack(base["vector"].to_numpy())
            ids, rows = base["id"].to_numpy(), base["row"].to_numpy()
            for query, row, vector, own, bound in zip(*(queries[n] for n in ("query_id", "query_row", "vector", "turned", "bound"))):
                alive = np.arange(len(ids)) if np.isinf(bound) else scan(own, turned, bound)
                alive = alive[rows[alive] != row]
                scores = vectors[alive] @ vector
                best = np.lexsort((rows[alive], ids[alive], -scores))[:k]
                found.append(pd.DataFrame({
                    "query_row": row, "query_id": query, "id": ids[alive][best], "row": rows[alive][best], "score": scores[best]}))
        if not found:
            return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in zip(FOUND, ("int64",) * 4 + ("float64",))})
        return pd.concat(found)

    return search


def search(base: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
           probe_share: float = PROBE_SHARE) -> DataFrame:
    """``query_id, rank, id, score``: the k nearest found for every row where ``is_query`` holds
    (a condition on a column ``id``)."""
    spark = base.sparkSession
    built = build(usable(base, id_column, vector))
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    placed, index = built
    shared = spark.sparkContext.broadcast(index)
    lists = len(index.centroids)
    probes = min(lists, max(LEAST_LISTS, int(np.ceil(lists * probe_share))))
    splits = np.maximum(1, -(-index.counts // BLOCK))
    base_splits = F.element_at(F.array(*[F.lit(int(s)) for s in splits]), F.col("list") + 1)

    def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        longer = [lists] if known.counts[lists] else []
        for batch in batches:
            for part in (batch.iloc[i : i + 512] for i in range(0, len(batch), 512)):
                turned = known.rotated_queries(np.stack(part["vector"].to_numpy()))
                gaps = squared(turned, known.centroids)
                order = np.argsort(gaps, axis=1, kind="stable")
                held = np.cumsum(known.counts[order], axis=1)
                for n in range(len(part)):
                    first = int(np.searchsorted(held[n], k + 1)) + 1
                    wanted = np.append(longer, order[n, : max(probes, first)]).astype(np.int64)
                    yield pd.DataFrame({
                        "query_row": part["row"].iloc[n], "query_id": part["id"].iloc[n], "vector": [part["vector"].iloc[n]] * len(wanted),
                        "turned": [turned[n]] * len(wanted), "list": wanted, "first": np.arange(len(wanted)) < first + len(longer)})

    routed = placed.where(is_query).select("row", "id", "vector").mapInPandas(
        routes, "query_row long, query_id long, vector array<double>, turned array<double>, list int, first boolean")
    routed = settle(routed.withColumn("split", F.explode(F.sequence(F.lit(0), base_splits - 1))), "vector-queries")
    visits = routed.count()
    crowds = max(1, -(-visits // (lists * BLOCK)))
    crowd = F.pmod(F.xxhash64("query_row"), F.lit(crowds)).cast("int")
    blocks = (
        placed.withColumn("split", F.pmod(F.xxhash64("row"), base_splits).cast("int"))
        .withColumn("crowd", F.explode(F.sequence(F.lit(0), F.lit(crowds - 1)))).groupBy("list", "split", "crowd"))
    found_schema = "query_row long, query_id long, id long, row long, score double"

    def visit(queries: DataFrame) -> DataFrame:
        return queries.withColumn("crowd", crowd).groupBy("list", "split", "crowd").cogroup(blocks).applyInPandas(_search_block(k), found_schema)

    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    near = settle(best(visit(routed.where("first").withColumn("bound", F.lit(float("inf"))))), "vector-near")
    # the k-th score of the nearest list bounds the squared distance to the scaled query: norm^2 + |q|^2 - 2 score
    scale = F.least(F.lit(1.0), F.lit(index.norm) / F.sqrt(square()))
    bounds = near.where(F.col("rank") == k).select("query_row", F.col("score").alias("reached"))
    rest = routed.where("not first").join(bounds, "query_row", "left").withColumn(
        "bound", F.coalesce(F.lit(index.norm**2) + square() * scale * scale - 2 * scale * F.col("reached"), F.lit(float("inf")))).drop("reached")
    both = near.select(*FOUND).unionByName(visit(rest))
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
