"""Near-duplicates by MinHash: banding, signature verification, exact confirmation, components.

A document's set is its distinct shingles of five words (A-Z lowered, words split at blanks; a
shorter document is one shingle). Universal hash functions give ``HASHES`` minima, cut into bands of
``ROWS``; documents that agree in a band meet in a bucket. Documents with equal sets are one node
before anything else happens, so exact copies cost nothing further.

A bucket never emits all its pairs. First one centre is compared with its members: pairs whose
signatures are too far apart to link are dropped, the rest confirmed on the full sets. Linked
nodes form components (alternating large-star and small-star), and a bucket whose members are in
one component is done. The members of the other buckets get ``LONG`` further minima, which part
what lies below the threshold far more sharply, and meet block by block: a task gets two blocks of
bounded size with their sets, compares signatures by array operations, confirms what is left on
the sets at once, and emits only links that join what was apart. A pair meets in its first common
bucket only. Nothing is judged by size or sampled; a large group whose members are all below the
threshold still costs the square of its size in comparisons, but no pair is ever a row.

Rows per band follow from the threshold: as many as keep the chance that a pair at the threshold
shares no band below ``MISSED`` (2e-8 at 85 %, 3e-6 at 80 %). Signature tests allow seven, and six,
standard deviations below it.

Defined results: null and empty texts, and texts of blanks, have the empty set and are linked with
nothing. Rows that repeat an id are one node, linked if any of their texts is. Rows without id are
not compared: their component is null and they are kept. :func:`keep_one` judges row by row, ids or
not. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from doccairn.llm.rows import keyed_rows
from doccairn.storage import discard, settle

WORDS = 5
HASHES = 96
#: Least similarity in percent.
PERCENT = 80
#: Most chance of missing a pair at the threshold in all bands.
MISSED = 1e-5
#: Further minima of the members of open buckets, one byte each.
LONG = 512
#: Shingles in a block of a bucket; a task holds two blocks.
BLOCK_SHINGLES = 400_000
#: Orders by which buckets choose their first centre; a node meets a few centres, not one.
CENTRES = 4
#: Most ids (of 8 bytes) sent to every task to pick out the texts of bucket members.
BROADCAST_IDS = 1_000_000
PIECE = 4096
_DRAW = np.random.default_rng(4)
#: Odd multipliers and offsets of the hash family, and one multiplier per place of a shingle.
FACTORS = _DRAW.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _DRAW.integers(0, 1 << 63, HASHES, dtype=np.uint64)
PLACES = _DRAW.integers(0, 1 << 63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LONG_FACTORS = _DRAW.integers(0, 1 << 63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LONG_OFFSETS = _DRAW.integers(0, 1 << 63, LONG, dtype=np.uint64)


def band_rows(percent: int) -> int:
    """The most minima per band that miss a pair at the threshold with a chance below ``MISSED``."""
    alike = percent / 100
    fitting = [rows for rows in range(1, HASHES + 1) if (1 - alike**rows) ** (HASHES // rows) <= MISSED]
    return max(fitting, default=1)


def least_agreement(percent: int, hashes: int, deviations: float, chance: float = 0.0) -> int:
    """Equal minima that a pair at the threshold has but for so many standard deviations.

    ``chance`` is the share of unequal minima that are equal in what is kept of them.
    """
    alike = percent / 100 + (1 - percent / 100) * chance
    return max(0, int(np.floor(hashes * alike - deviations * np.sqrt(hashes * alike * (1 - alike)))))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, dtype=np.uint64) * PLACES[WORDS]
    for place in range(size):
        total += hashes[place : place + count] * PLACES[place]
    return np.unique(mixed(total))


def signature(own: np.ndarray, factors: np.ndarray = FACTORS, offsets: np.ndarray = OFFSETS) -> np.ndarray:
    """Minima of a hash family over a set, 32 bits each."""
    minima = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    keys = own >> np.uint64(32)
    for start in range(0, len(keys), PIECE):
        part = keys[start : start + PIECE]
        values = factors[:, None] * part[None, :]
        values += offsets[:, None]
        values >>= np.uint64(32)
        np.minimum(minima, values.min(axis=1), out=minima)
    return minima.astype(np.uint32).view(np.int32)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            own = shingles(text)
            rows.append((
                len(own), own.sum(dtype=np.uint64).astype(np.int64),
                mixed(own ^ PLACES[0]).sum(dtype=np.uint64).astype(np.int64),
                signature(own) if len(own) else None))
        yield pd.concat([batch[["id"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n", "mark", "mark2", "minima"])], axis=1)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"id": batch["id"], "members": [shingles(t).view(np.int64) for t in batch["text"]]})


def _lengthened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        minima = [signature(m.view(np.uint64), LONG_FACTORS, LONG_OFFSETS).astype(np.uint8).tobytes() for m in batch["members"]]
        yield pd.DataFrame({"node": batch["node"], "members": batch["members"], "minima": minima})


def _bands(minima: Column, rows: int) -> Column:
    return F.array(*[
        F.xxhash64(F.lit(band), *[F.element_at(minima, band * rows + row + 1) for row in range(rows)]) for band in range(HASHES // rows)])


class _Rounds:
    """State of one run: nodes with their minima and sets, and how to confirm pairs."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int, temporary: list[str]):
        self.nodes, self.sets, self.percent, self.temporary = nodes, sets, percent, temporary
        self.rows = band_rows(percent)

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        return settle(df, name, self.temporary)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs (a, b) whose sets are similar enough."""
        nodes = self.nodes.select("node", "n", "minima")
        least = least_agreement(self.percent, HASHES, 7)
        near = (
            pairs.join(nodes.toDF("a", "na", "ma"), "a").join(nodes.toDF("b", "nb", "mb"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
            .where(F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
                   >= least)
            .select("a", "b").distinct())
        near = self.settle(near, "near-pairs")
        common = F.size(F.array_intersect("sa", "sb"))
        return (
            near.join(self.sets.toDF("a", "sa"), "a").join(self.sets.toDF("b", "sb"), "b")
            .where(common * 100 >= (F.size("sa") + F.size("sb") - common) * self.percent).select("a", "b").distinct())


def components(edges: DataFrame, temporary: list[str]) -> DataFrame:
    """``node, component`` for every node of the edges (a, b): the smallest node reachable.

    Alternates large-star and small-star until nothing changes; every step is a written table.
    """
    current = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "near-edges", temporary)
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        large = settle(large, "near-large", temporary)
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = settle(small.select("e.a", "e.b").where("a <> b").distinct(), "near-small", temporary)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _open(members: DataFrame, parts: DataFrame, work: _Rounds) -> DataFrame:
    """Members of the buckets that hold several components and pairs that no centre has met."""
    placed = members.join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    apart = placed.groupBy("bucket").agg(
        F.count("*").alias("held"), F.min("component").alias("low"), F.max("component").alias("high"))
    return work.settle(placed.join(apart.where("held > 2 and low <> high").select("bucket"), "bucket"), "near-open")


class _Block:
    """Two blocks of a bucket, or one with itself, compared row by row."""

    def __init__(self, rows: pa.Table, percent: int):
        self.nodes, self.percent = rows["node"].to_pylist(), percent
        self.bucket, self.across = rows["bucket"][0].as_py(), rows["x"][0].as_py() != rows["y"][0].as_py()
        self.side = rows["block"].to_numpy()
        sets = rows["members"].combine_chunks()
        ends = sets.offsets.to_numpy()
        flat = sets.values.to_numpy().view(np.uint64)
        self.sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        self.sizes = np.diff(ends).astype(np.int64)
        self.minima = np.frombuffer(b"".join(rows["minima"].to_pylist()), dtype=np.uint8).reshape(len(self.nodes), -1)
        self.bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(self.nodes), -1)
        self.roots = pc.dictionary_encode(rows["component"].combine_chunks()).indices.to_numpy().astype(np.int64)
        self.least = least_agreement(percent, LONG, 6, 1 / 256)

    def links(self) -> Iterator[tuple]:
        """Confirmed pairs that join what was apart, the likeliest of a row first."""
        for i in range(len(self.nodes)):
            later = np.arange(i + 1, len(self.nodes))
            later = later[self.roots[later] != self.roots[i]]
            if self.across:
                later = later[self.side[later] != self.side[i]]
            small, large = np.minimum(self.sizes[later], self.sizes[i]), np.maximum(self.sizes[later], self.sizes[i])
            later = later[small * 100 >= large * self.percent]
            first = (self.bands[later] == self.bands[i]).argmax(axis=1)
            later = later[self.bands[i][first] == self.bucket]
            agreement = (self.minima[later] == self.minima[i]).sum(axis=1)
            fits = agreement >= self.least
            for j in later[fits][np.argsort(-agreement[fits], kind="stable")]:
                if self.roots[j] != self.roots[i] and self.similar(i, j):
                    self.roots[self.roots == self.roots[j]] = self.roots[i]
                    yield self.nodes[i], self.nodes[j]

    def similar(self, i: int, j: int) -> bool:
        common = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return common * 100 >= (len(self.sets[i]) + len(self.sets[j]) - common) * self.percent


def _block_links(percent: int):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each run of rows with one bucket and pair of blocks; a run may span batches."""
        held: list[pa.RecordBatch] = []

        def closed() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            found = list(_Block(rows, percent).links())
            if found:
                kind = rows.schema.field("node").type
                yield pa.record_batch({"a": pa.array([min(p) for p in found], kind), "b": pa.array([max(p) for p in found], kind)})

        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in ("bucket", "x", "y")])
            changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *changes], [*changes, batch.num_rows]):
                part = batch.slice(begin, end - begin)
                if held and any(held[0].column(n)[0].as_py() != part.column(n)[0].as_py() for n in ("bucket", "x", "y")):
                    yield from closed()
                    held.clear()
                held.append(part)
        if held:
            yield from closed()

    return judged


def _links(members: DataFrame, work: _Rounds) -> DataFrame:
    """``node, component`` of all linked nodes that share buckets."""
    family = F.pmod("bucket", F.lit(CENTRES))
    centre = members.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", family)).alias("centre"))
    pairs = members.join(centre, "bucket").where("node <> centre").select(
        F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    found = work.settle(work.confirm(pairs), "near-links")
    parts = work.settle(components(found, work.temporary), "near-components")
    still = _open(members, parts, work)
    if still.isEmpty():
        return parts
    kind = members.schema["node"].dataType.simpleString()
    apart = still.select("node").distinct()
    bands = work.nodes.join(apart, "node").select("node", _bands(F.col("minima"), work.rows).alias("bands"))
    sets = work.sets.toDF("node", "members").join(apart, "node").mapInPandas(_lengthened, f"node {kind}, members array<long>, minima binary")
    held = work.settle(sets.join(bands, "node"), "near-long")
    # A bucket is cut into blocks of bounded size, and each pair of its blocks is a unit of work.
    weights = still.join(held.select("node", F.size("members").alias("n")), "node").groupBy("bucket").agg(F.sum("n").alias("n"))
    cut = weights.select("bucket", F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = still.join(cut, "bucket").withColumn("block", block).select(
        "bucket", "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = units.select("*", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")).drop("other")
    rows = units.join(held, "node").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    judged = rows.select("bucket", "x", "y", "block", "node", "component", "members", "minima", "bands").mapInArrow(
        _block_links(work.percent), f"a {kind}, b {kind}")
    more = work.settle(judged.distinct(), "near-links")
    return work.settle(components(found.unionByName(more), work.temporary), "near-components")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id, n_shingles, component_id, kept``: one row per document row."""
    kind = documents.schema[id_column].dataType.simpleString()
    source = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    temporary: list[str] = []
    sketches = settle(source.mapInPandas(_sketches, f"id {kind}, n long, mark long, mark2 long, minima array<int>"), "near-sketches")
    sized = sketches.where("n > 0 and id is not null")
    nodes = settle(
        sized.groupBy("mark", "mark2", "n").agg(F.min("id").alias("node"), F.first("minima").alias("minima")), "near-nodes")
    opened = nodes.select("node", F.explode(_bands(F.col("minima"), band_rows(percent))).alias("bucket")).distinct()
    shared = opened.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = settle(opened.join(shared, "bucket"), "near-members", temporary).select("bucket", "node")
    needed = members.select(F.col("node").alias("id")).distinct()
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    sets = settle(source.join(needed, "id").mapInPandas(_sets, f"id {kind}, members array<long>"), "near-sets", temporary)
    parts = _links(members, _Rounds(nodes, sets, percent, temporary))
    labels = nodes.join(parts, "node", "left").select("mark", "mark2", "n", F.coalesce("component", "node").alias("component_id"))
    labels = settle(labels, "near-labels")
    discard(documents.sparkSession, temporary)
    joined = sketches.join(labels, ["mark", "mark2", "n"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(
        "id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component: that with the smallest id, and of rows with that id any one.

    Every row is compared, with or without id; one without id stays only where no row has one.
    Rows with the empty set are linked with nothing, so all of them stay.
    """
    rows, key = keyed_rows(documents, "near-rows")
    found = near_duplicates(rows, key, text, percent).select(F.col("id").alias("_key"), F.col("component_id").alias("_part"))
    placed = rows.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{id_column}`").alias("_id")).join(found, "_key")
    first = placed.groupBy("_part").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("first")).select(F.col("first._key").alias("_kept"))
    return rows.join(first, F.col(f"`{key}`") == F.col("_kept"), "left_semi").drop(key)
