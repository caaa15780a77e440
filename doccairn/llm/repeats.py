"""Removal of long repeated byte strings, by merged Burrows-Wheeler transforms.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else goes. The work
narrows down to the places where a transform is worth its cost, without losing one:

1. The least hashed ``GRAM`` bytes inside a window of ``LENGTH`` bytes depend on the window's bytes
   alone. Runs of windows with the same least gram are the unit: equal windows lie in runs of
   equal grams. Spark counts the grams; a run whose gram is met once, and is not met twice
   inside the run, holds nothing repeated.
2. Runs of a repeated gram whose whole bytes are met again (by hash) are repeated throughout.
3. For the rest, each distinct run of a gram is a short string. These strings are dealt out by gram
   and packed into bundles. The shards of a bundle have their own suffix orders and transforms
   (over blocks of ``STEP`` bytes); iterative refinement of their interleave merges them, and the
   round in which two neighbours part gives their common prefix. Intervals of ``ROUNDS`` common
   blocks are the repeated windows. A gram with more than ``LARGEST`` distinct runs is handled
   window by window in a distributed count instead, so that no group is gathered in one task.

Two bit tables of fixed size (``TABLE_BITS``) tell the later scans which runs to emit; a full
table lets too many pass, which costs time and changes nothing. Texts meet their spans in one
join.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` lose nothing. Rows that
repeat an id with other texts are documents of their own, and rows that are wholly equal are copies
of each other. Null ids stay. Other columns are not looked at. Kept bytes may not be UTF-8, since
a repeat can begin or end inside a character; they are returned as binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from doccairn.storage import discard, settle

LENGTH, GRAM = 200, 48
#: Blocks of the transforms: STEP bytes each, ROUNDS of them make LENGTH.
STEP = 40
ROUNDS = LENGTH // STEP
#: Windows of a run, and window starts handled at once.
RUN, SPAN = 256, 1 << 16
TABLE_BITS = 26
#: Distinct runs of one gram that go through one task, and bytes of a bundle and of its shards.
LARGEST = 2000
BUNDLE, SHARD = 1 << 20, 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if not _POWERS:
        count = max(SPAN + LENGTH, BUNDLE * 2) + 1
        for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
            steps = np.full(count, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _prefix_sums(body: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(body) + 1, dtype=np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(body)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _mix((sums[ends] - sums[starts]) * _powers()[1][starts] + (ends - starts).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    count = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


#: Low bits of a gram's key that hold its place within a span; the rest are its hash.
PLACE = np.uint64((1 << 17) - 1)


def runs(body: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Start, windows, gram, content hash and doubling of the runs of a document, some at a time.

    A run is doubled if its first least gram moves on inside it; only then can two of its own
    windows be equal.
    """
    for begin in range(0, len(body) - LENGTH + 1, SPAN):
        part = body[begin : begin + SPAN + LENGTH - 1]
        sums = _prefix_sums(part)
        places = np.arange(len(part) - GRAM + 1)
        keys = (_hashes(sums, places, places + GRAM) & ~PLACE) | places.astype(np.uint64)
        least = _least(keys, LENGTH - GRAM + 1)
        moved = least[1:] != least[:-1]
        grams = least & ~PLACE
        parted = grams[1:] != grams[:-1]
        heads = np.flatnonzero(np.concatenate([[True], parted]))
        sizes = np.diff(np.append(heads, len(least)))
        doubled = np.logical_or.reduceat(np.concatenate([[False], moved & ~parted]), heads)
        # least hashes crowd near zero: mixed once more, their leading bits spread over the bit table
        grams = _mix(grams[heads])
        if (sizes > RUN).any():
            repeats = -(-sizes // RUN)
            order = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
            rest = np.repeat(sizes, repeats) - order * RUN
            heads, sizes = np.repeat(heads, repeats) + order * RUN, np.minimum(rest, RUN)
            grams, doubled = np.repeat(grams, repeats), np.repeat(doubled, repeats)
        yield heads + begin, sizes, grams, _hashes(sums, heads, heads + sizes + LENGTH - 1), doubled


def _body(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _tags(key: int, key2: int, starts: np.ndarray) -> np.ndarray:
    seed = np.array([key, key2], dtype=np.int64).view(np.uint64)
    return _mix(_mix(starts.astype(np.uint64) + seed[0]) ^ seed[1])


def _passes(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values >> np.uint64(64 - TABLE_BITS)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_table(values: DataFrame, column: str) -> np.ndarray:
    """Bits of the leading ``TABLE_BITS`` of a column of hashes, gathered by Spark."""
    place = F.shiftrightunsigned(column, 64 - TABLE_BITS)
    words = (
        values.select(F.shiftrightunsigned(place, 6).cast("int").alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        met = [(g, d) for text in batch["text"] for _, _, g, _, d in runs(_body(text))]
        if met:
            grams, doubled = map(np.concatenate, zip(*met))
            found, place = np.unique(grams, return_inverse=True)
            yield pd.DataFrame({
                "gram": found.view(np.int64), "n": np.bincount(place, weights=1 + doubled).astype(np.int64)})


RUN_COLUMNS = ("key", "key2", "start", "size", "gram", "whole", "tag", "doubled")
RUN_SCHEMA = ", ".join(f"{name} long" for name in RUN_COLUMNS[:-1]) + ", doubled boolean"


def _emit(table: np.ndarray, by_tag: bool):
    """Scan that emits the runs whose gram (or tag) is in the table, with or without their bytes."""
    shared = SparkSession.active().sparkContext.broadcast(table)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in RUN_COLUMNS]
            bytes_of: list[bytes] = []
            for text, key, key2 in zip(batch["text"], batch["key"], batch["key2"]):
                body = _body(text)
                raw = body.tobytes() if by_tag else b""
                for starts, sizes, grams, whole, doubled in runs(body):
                    tags = _tags(key, key2, starts)
                    held = np.flatnonzero(_passes(known, tags if by_tag else grams))
                    if not len(held):
                        continue
                    for column, values in zip(columns, (
                            np.full(len(held), key), np.full(len(held), key2), starts[held], sizes[held],
                            grams[held].view(np.int64), whole[held].view(np.int64), tags[held].view(np.int64), doubled[held])):
                        column.append(values)
                    if by_tag:
                        bytes_of += [raw[s : s + n + LENGTH - 1] for s, n in zip(starts[held].tolist(), sizes[held].tolist())]
            if columns[0]:
                frame = pd.DataFrame(dict(zip(RUN_COLUMNS, map(np.concatenate, columns))))
                yield frame.assign(bytes=bytes_of) if by_tag else frame

    return scan


class Shard:
    """Suffix order to LENGTH bytes and transform of some strings, over hashed blocks of STEP bytes."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings])
        self.text = np.frombuffer(b"".join(strings), dtype=np.uint8)
        size = len(self.text)
        ends = np.repeat(np.cumsum(lengths), lengths)
        places = np.arange(size)
        inside = places + STEP <= ends
        sums = _prefix_sums(self.text)
        #: Name of the block that begins at each place; blocks that leave their string share one.
        self.names = np.where(inside, _hashes(sums, places, np.minimum(places + STEP, size)) | np.uint64(1), np.uint64(0))
        self.whole = places + LENGTH <= ends
        first = rank = np.unique(self.names, return_inverse=True)[1].astype(np.int64)
        # ranks by 1, 2, 4 and then ROUNDS blocks
        for blocks, rest in ((1, None), (2, None), (4, first)):
            ahead = np.roll(rank if rest is None else rest, -blocks * STEP)
            rank = np.unique(rank * (size + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        self.order = np.argsort(rank, kind="stable")
        #: The block before each suffix, in suffix order: the transform.
        self.transform = self.names[(self.order - STEP) % size]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffix orders and, per place in it, the number of whole blocks
    in common with the suffix before (up to ROUNDS)."""
    interleave = np.repeat(np.arange(len(shards), dtype=np.int16), [len(s.order) for s in shards])
    common = np.full(len(interleave), ROUNDS, dtype=np.int8)
    group = np.zeros(len(interleave), dtype=np.int64)
    symbols = np.empty(len(interleave), dtype=np.uint64)
    for done in range(ROUNDS):
        for number, shard in enumerate(shards):
            symbols[interleave == number] = shard.transform
        moved = np.argsort(symbols, kind="stable")
        ordered, before = symbols[moved], group[moved]
        part = np.concatenate([[True], (ordered[1:] != ordered[:-1]) | (before[1:] != before[:-1])])
        # groups refine in place, so a boundary stays where it is and keeps its first round
        common = np.where(part & (common == ROUNDS), done, common)
        interleave = interleave[moved]
        group = np.cumsum(part)
    return interleave, common


def repeated(strings: list[bytes]) -> list[np.ndarray]:
    """For each string, the starts of its windows of LENGTH bytes met again in any of them."""
    shards, at, held = [], 0, []
    while at < len(strings):
        size, begin = 0, at
        while at < len(strings) and (size == 0 or size + len(strings[at]) <= SHARD):
            size += len(strings[at])
            at += 1
        shards.append(Shard(strings[begin:at]))
    interleave, common = merge(shards)
    same = common == ROUNDS
    hit = same | np.concatenate([same[1:], [False]])
    for number, shard in enumerate(shards):
        flags = np.zeros(len(shard.order), dtype=bool)
        flags[shard.order] = hit[interleave == number]
        held.append(flags & shard.whole)
    flags = np.concatenate(held)
    cuts = np.cumsum([len(s) for s in strings])
    return [np.flatnonzero(part) for part in np.split(flags, cuts[:-1])]


def _spans_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the bytes covered by windows at sorted starts."""
    heads = np.flatnonzero(np.concatenate([[True], np.diff(starts) > LENGTH]))
    return starts[heads], starts[np.append(heads[1:] - 1, len(starts) - 1)] + LENGTH


def _bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs, sorted by gram, into spans; a bundle ends between two grams."""
    held: list[pd.DataFrame] = []
    size = 0

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (key, key2, start), found in zip(frame[["key", "key2", "start"]].itertuples(index=False), repeated(frame["bytes"].tolist())):
            if len(found):
                begins, ends = _spans_of(found)
                out.append(pd.DataFrame({"key": key, "key2": key2, "start": begins + start, "end": ends + start}))
        return pd.concat(out) if out else pd.DataFrame(
            {n: pd.Series(dtype="int64") for n in ("key", "key2", "start", "end")})

    for batch in batches:
        while len(batch):
            lengths = batch["bytes"].map(len).to_numpy()
            fits = int(np.searchsorted(size + np.cumsum(lengths), BUNDLE))
            if fits >= len(batch):
                held.append(batch)
                size += int(lengths.sum())
                break
            # take whole grams: up to the last change at or before `fits`, else the first after
            joined = pd.concat([*held, batch]) if held else batch
            grams = joined["gram"].to_numpy()
            changes = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            ahead = len(joined) - len(batch) + fits
            lower = changes[changes <= ahead]
            upper = changes[changes > ahead]
            cut = int(lower[-1]) if len(lower) else int(upper[0]) if len(upper) else None
            if cut is None:
                held, size = [joined], int(joined["bytes"].map(len).sum())
                break
            yield solve(joined.iloc[:cut])
            held, size, batch = [], 0, joined.iloc[cut:]
    if held:
        yield solve(pd.concat(held))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per window of the runs of very common grams."""
    for batch in batches:
        for key, key2, start, gram, content in batch[["key", "key2", "start", "gram", "bytes"]].itertuples(index=False):
            body = np.frombuffer(content, dtype=np.uint8)
            places = np.arange(len(body) - LENGTH + 1)
            yield pd.DataFrame({
                "key": key, "key2": key2, "start": start + places, "gram": gram,
                "window": _hashes(_prefix_sums(body), places, places + LENGTH).view(np.int64)})


def repeat_spans(documents: DataFrame, temporary: list[str]) -> DataFrame:
    """``key, key2, start, end`` of repeated bytes, for rows of ``key, key2, text``."""
    texts = documents.where(F.octet_length("text") >= LENGTH)
    counts = texts.select("text").mapInPandas(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    common = bit_table(counts.where("n > 1"), "gram")
    found = settle(texts.mapInPandas(_emit(common, False), RUN_SCHEMA), "repeat-runs", temporary)
    # a distinct run, how often it is met, and one of its places
    kinds = settle(
        found.groupBy("gram", "whole", "size").agg(F.count("*").alias("n"), F.min("tag").alias("tag"), F.max("doubled").alias("doubled")), "repeat-kinds", temporary)
    whole = found.join(kinds.where("n > 1").select("gram", "whole", "size"), ["gram", "whole", "size"], "left_semi").select(
        "key", "key2", "start", (F.col("start") + F.col("size") + LENGTH - 1).alias("end"))
    grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least"), F.max("doubled").alias("doubled")).where("least = 1 and (kinds > 1 or doubled)")
    open_runs = settle(kinds.join(grams.select("gram", "kinds"), "gram"), "repeat-open", temporary)
    places = bit_table(open_runs, "tag")
    emitted = texts.mapInPandas(_emit(places, True), RUN_SCHEMA + ", bytes binary")
    narrow = settle(emitted.select("key", "key2", "start", "gram", "bytes"), "repeat-strings", temporary)
    hot = open_runs.where(F.col("kinds") > LARGEST).select("gram").distinct()
    edges = (
        narrow.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
        .mapInPandas(_bundles, "key long, key2 long, start long, end long"))
    windows = narrow.join(hot, "gram", "left_semi").mapInPandas(_windows, "key long, key2 long, start long, gram long, window long")
    again = windows.groupBy("gram", "window").agg(F.count("*").alias("n")).where("n > 1").select("gram", "window")
    met = windows.join(again, ["gram", "window"], "left_semi").select("key", "key2", "start", (F.col("start") + LENGTH).alias("end"))
    return whole.unionByName(edges).unionByName(met)


def _cut(text: str | None, spans: list | None) -> tuple[int, int, int, bytes]:
    body = (text or "").encode("utf-8", "surrogatepass")
    kept, at, removed, count, reach = [], 0, 0, 0, -1
    for begin, end in sorted(spans or ()):
        if begin > reach:
            kept.append(body[at:begin])
            count += 1
            removed += end - begin
            reach = at = end
        elif end > reach:
            removed += end - reach
            reach = at = end
    return len(body), removed, count, b"".join([*kept, body[at:]])


def remove_repeats(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (binary): one row per document row.

    Only texts that may have repeats, by a bit table of the keys of those that do, are shuffled to
    their spans; the others stay as they are.
    """
    source = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text")).withColumns({
        "key": F.xxhash64("text"), "key2": F.xxhash64("id", F.lit(7))})
    temporary: list[str] = []
    spans = repeat_spans(source.select("key", "key2", "text"), temporary)
    gathered = settle(
        spans.groupBy("key", "key2").agg(F.collect_set(F.array("start", "end")).alias("spans")), "repeat-spans")
    discard(documents.sparkSession, temporary)

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [_cut(t, None if s is None else [tuple(p) for p in s]) for t, s in zip(texts, spans)],
            columns=["n_bytes", "n_removed", "n_spans", "kept"])

    shared = documents.sparkSession.sparkContext.broadcast(bit_table(gathered, "key"))

    @F.pandas_udf("boolean")
    def listed(keys: pd.Series) -> pd.Series:
        return pd.Series(_passes(shared.value, keys.to_numpy().view(np.uint64)))

    pieces = cut.asNondeterministic()(F.col("text"), F.col("spans"))
    marked = source.withColumn("listed", listed("key"))
    cleaned = marked.where("listed").join(gathered, ["key", "key2"], "left").select("id", pieces.alias("c")).select("id", "c.*")
    body, none = F.coalesce(F.col("text").cast("binary"), F.lit(b"")), F.lit(0).cast("long")
    untouched = marked.where("not listed").select(
        "id", F.octet_length(body).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), body.alias("kept"))
    return cleaned.unionByName(untouched)
