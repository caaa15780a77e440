"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

A model file is compiled into four machines:

- the normaliser: the model's own rewriting rules (longest match first), blanks to the piece blank,
  a dummy prefix;
- the pieces: a deterministic machine over characters, an arc per character, a piece where a
  vocabulary entry ends, with the weight minus its score;
- byte fallback: an arc for a character without a piece, writing its UTF-8 bytes;
- for a merge (BPE) model an acceptor of the pairs that may stand side by side: two pieces may if
  merging their text from single characters ends in those two again.

The input is composed with them place by place. Distances in the tropical semiring (minimum, plus)
are relaxed in the order of places and the path of least weight is read back. For a unigram model
that path is the model's segmentation. A merge model ranks merges and not sums of scores; there
the acceptor leaves the one path that merging the whole text would give.

Between characters that no piece has side by side a text falls apart into chunks. Many chunks
advance together in numpy, and a bounded number of them is remembered.

Defined results: null gives null ids, an empty text no ids. Texts of any length are encoded
whole. Decoding turns ids back into text; bytes that are not UTF-8 become U+FFFD. The piece
blank U+2581 in a text reads as a blank afterwards, as the format has it; a model whose normaliser
rewrites characters gives the rewritten text back. Rows are handled one by one, so null or
repeated ids, repeated rows and other columns do not matter. If the merges of a model were not
closed under splitting and the acceptor left no path, the chunk is merged step by step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

BLANK = "▁"
#: Chunks a task remembers before it starts afresh, and slots for pairs (a power of two, as bits).
REMEMBERED = 60_000
PAIR_BITS = 20
#: Characters of texts encoded together.
TOGETHER = 1 << 18
#: Spreads numbers over the slots of a table (2^64 over the golden ratio).
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a character in the keys of the piece machine.
CODE_BITS = 21
#: Added to the worst score for a character without a piece, as the format has it.
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


class Lookup:
    """Exact lookup of many whole numbers at once, by open addressing in one array."""

    def __init__(self, entries: dict[int, int]):
        wanted, values = (np.fromiter(part, np.int64, len(entries)) for part in (entries.keys(), entries.values()))
        self.bits = max(4, (4 * len(entries)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1), np.full(1 << self.bits, -1)
        place = _slots(wanted, self.bits)
        while len(wanted):
            free = self.keys[place] < 0
            self.keys[place[free]] = wanted[free]
            won = self.keys[place] == wanted
            self.values[place[won]] = values[won]
            wanted, values, place = wanted[~won], values[~won], (place[~won] + 1) & ((1 << self.bits) - 1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The value of each number; -1 for those without one."""
        place = _slots(wanted, self.bits)
        seen = self.keys[place]
        out = np.where(seen == wanted, self.values[place], -1)
        left = np.flatnonzero((seen != wanted) & (seen >= 0))
        place = place[left]
        while len(left):
            place = (place + 1) & ((1 << self.bits) - 1)
            seen, sought = self.keys[place], wanted[left]
            hit = seen == sought
            out[left[hit]] = self.values[place[hit]]
            more = ~hit & (seen >= 0)
            left, place = left[more], place[more]
        return out


def rewriting_rules(charsmap: bytes) -> dict[str, str]:
    """The rules in a model's compiled character map: a double array over UTF-8 bytes, whose leaves
    hold the places of zero-ended replacements. The array is walked level by level."""
    size = int.from_bytes(charsmap[:4], "little")
    units = np.frombuffer(charsmap[4 : 4 + size], dtype="<u4").astype(np.int64)
    texts = charsmap[4 + size :]
    bytes_ = np.arange(1, 256)

    def beyond(nodes: np.ndarray) -> np.ndarray:
        unit = units[nodes]
        return nodes ^ ((unit >> 10) << ((unit & 512) >> 6))

    rules: dict[str, str] = {}
    keys, nodes = [b""], beyond(np.zeros(1, dtype=np.int64))
    while len(keys):
        nearby = nodes[:, None] ^ bytes_[None, :]
        there = units[np.minimum(nearby, len(units) - 1)]
        parent, which = np.nonzero((nearby < len(units)) & ((there & 0x800000FF) == bytes_[None, :]))
        reached = nearby[parent, which]
        keys = [keys[p] + bytes([b + 1]) for p, b in zip(parent.tolist(), which.tolist())]
        leaf = (units[reached] >> 8) & 1
        nodes = beyond(reached)
        for n in np.flatnonzero(leaf).tolist():
            at = int(units[nodes[n]] & 0x7FFFFFFF)
            rules[keys[n].decode()] = texts[at : texts.index(b"\0", at)].decode()
    return rules


class PieceModel:
    """The compiled machines. Built on the driver from the model file; sent to tasks whole
    (its size is that of the vocabulary)."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2 as form

        model = form.ModelProto()
        model.ParseFromString(content)
        spec = model.normalizer_spec
        self._rewriting(rewriting_rules(spec.precompiled_charsmap) if spec.precompiled_charsmap else {})
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.merges = model.trainer_spec.model_type == 2
        self.arcs: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.surface: list[bytes] = []
        self.unknown = 0
        for number, piece in enumerate(model.pieces):
            shown = b""
            if piece.type in (NORMAL, USER_DEFINED):
                self.arcs[piece.piece] = (number, -piece.score)
                shown = piece.piece.replace(BLANK, " ").encode()
            elif piece.type == BYTE:
                value = int(piece.piece[3:-1], 16)
                self.bytes[value] = number
                shown = bytes([value])
            elif piece.type == UNKNOWN:
                self.unknown = number
            self.surface.append(shown)
        self.longest = max(map(len, self.arcs), default=1)
        self.unknown_cost = max((cost for _, cost in self.arcs.values()), default=0.0) + UNKNOWN_PENALTY
        self._cuts()
        self._machines()
        self._forget()
        #: Pairs judged lately, one per slot; made in the task.
        self.pairs: np.ndarray | None = None

    def _rewriting(self, rules: dict[str, str]) -> None:
        """The normaliser: the rules, the longest of those that start with a character, and where one may start."""
        self.rules, self.reach = rules, {}
        for key in rules:
            self.reach[key[0]] = max(len(key), self.reach.get(key[0], 1))

        def any_of(characters: set[str]) -> str:
            return "[" + "".join(map(re.escape, sorted(characters))) + "]"

        single, longer = {k for k in rules if len(k) == 1}, {k for k in rules if len(k) > 1}
        forms = [any_of(single)] if single else []
        if longer:
            forms.append(f"{any_of({k[0] for k in longer})}(?={any_of({k[1] for k in longer})})")
        self.starts = re.compile("|".join(forms)) if forms else None

    def _rewrite(self, text: str) -> str:
        if self.starts is None:
            return text
        out, at = [], 0
        while found := self.starts.search(text, at):
            begin = found.start()
            out.append(text[at:begin])
            for size in range(self.reach[text[begin]], 0, -1):
                rule = self.rules.get(text[begin : begin + size])
                if rule is not None and begin + size <= len(text):
                    out.append(rule)
                    break
            else:
                size = 1
                out.append(text[begin])
            at = begin + size
        out.append(text[at:])
        return "".join(out)

    def _cuts(self) -> None:
        """Pattern of the chunks: characters that stand side by side in some piece form groups,
        and no piece reaches from one group into another or into a blank run that follows."""
        group: dict[str, str] = {}

        def root(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        bodies = [p.lstrip(BLANK) for p in self.arcs]
        if any(BLANK in body for body in bodies):
            self.chunks = re.compile(".+", re.S)
            return
        for body in bodies:
            for a, b in zip(body, body[1:]):
                group[root(a)] = root(b)
        members: dict[str, list[str]] = {}
        for c in group:
            members.setdefault(root(c), []).append(c)
        sets = ["[" + "".join(map(re.escape, sorted(m))) + "]+" for m in sorted(members.values(), key=len, reverse=True)]
        self.chunks = re.compile(f"{BLANK}*(?:{'|'.join([*sets, f'[^{BLANK}]'])})|{BLANK}+", re.S)

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        text = self._rewrite(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
            if not text:
                return ""
        return (BLANK if self.prefix else "") + text.replace(" ", BLANK)

    def _merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Merging a text's characters, best score first, then leftmost: the parts left, and for
        each merge its cost and the first and last part after it."""
        parts, steps = list(text), []
        while len(parts) > 1:
            best = min(
                ((self.arcs[a + b][1], n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.arcs),
                default=None,
            )
            if best is None:
                break
            cost, n = best
            parts[n : n + 2] = [parts[n] + parts[n + 1]]
            steps.append((cost, parts[0], parts[-1]))
        return parts, steps

    def _machines(self) -> None:
        """The piece machine, and for a merge model the acceptor's tables."""
        self.size = len(self.surface)
        self.weights = np.zeros(self.size)
        for number, cost in self.arcs.values():
            self.weights[number] = cost
        sound = self._acceptor() if self.merges else self.arcs.keys()
        steps: dict[int, int] = {}
        final, inner = [-1], [False]
        for piece in sound:
            state = 0
            for c in piece:
                inner[state] = True
                key = state << CODE_BITS | ord(c)
                if key not in steps:
                    steps[key] = len(final)
                    final.append(-1)
                    inner.append(False)
                state = steps[key]
            final[state] = self.arcs[piece][0]
        self.steps, self.final, self.inner = Lookup(steps), np.array(final), np.array(inner)

    def _acceptor(self) -> list[str]:
        """Tables of the merges inside every piece, and of the merges across two parts; returns the
        pieces that their own characters merge into."""
        parts = {piece: number for piece, (number, _) in self.arcs.items()}
        for piece in self.arcs:
            for c in piece:
                parts.setdefault(c, self.size + len(parts))
        self.parts = self.size + len(parts) + 1
        joins = {}
        for piece, (number, _) in self.arcs.items():
            for n in range(1, len(piece)):
                left, right = parts.get(piece[:n]), parts.get(piece[n:])
                if left is not None and right is not None:
                    joins[left * self.parts + right] = number
        self.joins, sound = Lookup(joins), []
        shape = (self.size, self.longest + 1)
        #: By piece and number of merges done: the cost of the next one, the first and the last part.
        self.costs, self.heads, self.edges = np.full(shape, np.inf), np.zeros(shape, dtype=np.int32), np.zeros(shape, dtype=np.int32)
        for piece, (number, _) in self.arcs.items():
            left, done = self._merged(piece)
            if len(left) > 1:
                continue
            sound.append(piece)
            self.heads[number, 0], self.edges[number, 0] = parts[piece[0]], parts[piece[-1]]
            for n, (cost, first, last) in enumerate(done):
                self.costs[number, n] = cost
                self.heads[number, n + 1], self.edges[number, n + 1] = parts[first], parts[last]
        return sound

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the two pieces of each pair stay apart while both are merged from characters.

        The merges inside either piece happen in its own order; the cheapest step at hand goes
        first, the leftmost of equals. A pair is refused if a merge across wins.
        """
        apart = np.ones(len(left), dtype=bool)
        a, b, open_pairs = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64), np.arange(len(left))
        while len(open_pairs):
            first, second = self.costs[left, a], self.costs[right, b]
            joined = self.joins.find(self.edges[left, a].astype(np.int64) * self.parts + self.heads[right, b])
            across = np.where(joined >= 0, self.weights[joined], np.inf)
            refused = (joined >= 0) & (across < first) & (across <= second)
            apart[open_pairs[refused]] = False
            on = ~refused & (np.isfinite(first) | np.isfinite(second))
            mine = first <= second
            a, b = (a + mine)[on], (b + ~mine)[on]
            left, right, open_pairs = left[on], right[on], open_pairs[on]
        return apart

    def _may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`_apart`, remembered in one slot per hash. Fallback characters may stand anywhere."""
        if self.pairs is None:
            self.pairs, self.pair_allowed = np.full(1 << PAIR_BITS, -1), np.zeros(1 << PAIR_BITS, dtype=bool)
        allowed = np.ones(len(left), dtype=bool)
        judged = np.flatnonzero((left < self.size) & (right < self.size))
        keys = left[judged] * self.size + right[judged]
        slots = _slots(keys, PAIR_BITS)
        known = self.pairs[slots] == keys
        allowed[judged[known]] = self.pair_allowed[slots[known]]
        if not known.all():
            fresh, place = np.unique(keys[~known], return_inverse=True)
            verdict = self._apart(fresh // self.size, fresh % self.size)
            allowed[judged[~known]] = verdict[place]
            slots = _slots(fresh, PAIR_BITS)
            self.pairs[slots] = fresh
            kept = self.pairs[slots] == fresh
            self.pair_allowed[slots[kept]] = verdict[kept]
        return allowed

    def _arcs(self, codes: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and number of every arc over the input, shorter ones first; a fallback
        character's number is ``size`` plus its code."""
        froms, tos, numbers = [], [], []
        alive, state = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        for length in range(1, self.longest + 1):
            state = self.steps.find(state << CODE_BITS | codes[alive + length - 1])
            number = np.where(state >= 0, self.final[state], -1)
            whole = number >= 0
            if length == 1:
                froms.append(alive)
                numbers.append(np.where(whole, number, self.size + codes))
            else:
                froms.append(alive[whole])
                numbers.append(number[whole])
            tos.append(froms[-1] + length)
            goes = (state >= 0) & self.inner[state] & (alive + length < limit[alive])
            alive, state = alive[goes], state[goes]
            if not len(alive):
                break
        return np.concatenate(froms), np.concatenate(tos), np.concatenate(numbers)

    def _solve(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many chunks, one after another, and their number per chunk.

        All chunks advance together, one place at a time: of the arcs that arrive at a place, the
        one of least distance is taken; of equals the longest, as the format has it.
        """
        lengths = np.array([len(c) for c in chunks])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        begin, end, number = self._arcs(codes, np.repeat(ends, lengths))
        first = np.repeat(starts, lengths)[begin]
        step = end - first
        order = np.argsort(step.astype(np.uint16) if lengths.max() < 1 << 16 else step, kind="stable")
        begin, end, number, first, step = begin[order], end[order], number[order], first[order], step[order]
        weight = np.where(number < self.size, self.weights[np.minimum(number, self.size - 1)], self.unknown_cost)
        head = begin == first
        # by the character before a place: its distance, the last piece of the path, and where that began
        distance = np.full(len(codes), np.inf)
        last, came = np.full(len(codes), -1), np.zeros(len(codes), dtype=np.int64)
        for low, high in zip(*_ranges(step)):
            b, e, n, h = begin[low:high], end[low:high] - 1, number[low:high], head[low:high]
            total = np.where(h, 0.0, distance[b - 1]) + weight[low:high]
            held = np.isfinite(total)
            if self.merges:
                inner = np.flatnonzero(held & ~h)
                held[inner] = self._may_follow(last[b[inner] - 1], n[inner])
            b, e, n, total = b[held], e[held], n[held], total[held]
            np.minimum.at(distance, e, total)
            best = total == distance[e]
            last[e[best]], came[e[best]] = n[best], b[best]
        return self._paths(chunks, starts, ends, last, came)

    def _paths(self, chunks: list[str], starts: np.ndarray, ends: np.ndarray, last: np.ndarray, came: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for n in np.flatnonzero(last[ends - 1] < 0).tolist():
            at = int(starts[n])
            for part in self._merged(chunks[n])[0]:
                came[at + len(part) - 1] = at
                last[at + len(part) - 1] = self.arcs[part][0] if part in self.arcs else self.size + ord(part)
                at += len(part)
        at, count, rows = ends.copy(), np.zeros(len(chunks), dtype=np.int64), []
        open_chunks = np.arange(len(chunks))
        while len(open_chunks):
            here = at[open_chunks] - 1
            rows.append((open_chunks, count[open_chunks], last[here]))
            count[open_chunks] += 1
            at[open_chunks] = came[here]
            open_chunks = open_chunks[came[here] > starts[open_chunks]]
        flat = np.zeros(int(count.sum()), dtype=np.int64)
        tail = np.cumsum(count)
        for which, depth, number in rows:
            flat[tail[which] - 1 - depth] = number
        return self._fallback(flat, count)

    def _fallback(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fallback characters become their bytes, or the unknown piece in a model without bytes."""
        places = np.flatnonzero(flat >= self.size)
        if not len(places):
            return flat, count
        codes, which = np.unique(flat[places] - self.size, return_inverse=True)
        forms = [
            [self.bytes.get(b, self.unknown) for b in chr(c).encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]
            for c in codes.tolist()
        ]
        sizes = np.array([len(f) for f in forms])
        wide = np.array([f + [0] * (4 - len(f)) for f in forms])
        written = np.ones(len(flat), dtype=np.int64)
        written[places] = sizes[which]
        out, begin = np.repeat(flat, written), np.cumsum(written) - written
        for n in range(4):
            own = sizes[which] > n
            out[begin[places[own]] + n] = wide[which[own], n]
        owner = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(owner, weights=written, minlength=len(count)).astype(np.int64)

    def _forget(self) -> None:
        #: Number of each chunk met; its ids are ``flat[begins[n] : begins[n] + counts[n]]``.
        self.known: dict[str, int] = {}
        self.flat = self.begins = self.counts = np.empty(0, dtype=np.int64)

    def _remember(self, chunks: list[str]) -> None:
        flat, count = self._solve(chunks)
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(count) - count])
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, count])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of some texts; chunks not met before are solved together."""
        split = [self.chunks.findall(self.normalise(t)) for t in texts]
        fresh = set().union(*split).difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self._forget()
            fresh = set().union(*split)
        todo = list(fresh)
        for at in range(0, len(todo), 1 << 15):
            self._remember(todo[at : at + (1 << 15)])
        number, out = self.known.__getitem__, []
        for own in split:
            which = np.fromiter(map(number, own), np.int64, len(own))
            count = self.counts[which]
            begin = np.repeat(self.begins[which] - (np.cumsum(count) - count), count)
            ids = self.flat[begin + np.arange(len(begin))]
            if not self.bytes:  # one unknown for a run of unknown characters, also across chunks
                ids = ids[(ids != self.unknown) | (np.append(-1, ids[:-1]) != self.unknown)] if len(ids) else ids
            out.append(ids.astype(np.int32))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        surface = self.surface
        text = b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _ranges(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of equal values in a sorted array."""
    heads = np.flatnonzero(np.concatenate([[True], steps[1:] != steps[:-1]])) if len(steps) else np.empty(0, dtype=np.int64)
    return heads, np.append(heads[1:], len(steps))[: len(heads)]


def _groups(texts: pd.Series) -> Iterator[list[str | None]]:
    """Texts in runs of about TOGETHER characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def load(path: str) -> PieceModel:
    """Compile a model file that the driver can read."""
    with open(path, "rb") as file:
        return PieceModel(file.read())


RESULT = "n_tokens long, n_byte_tokens long, round_trip boolean, ids array<int>"


def encoded(model: PieceModel, text: Column) -> Column:
    """Struct of the ids, their count, those from byte fallback, and whether decoding gives the text again."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = shared.value
        fallback = np.zeros(len(machine.surface), dtype=bool)
        fallback[list(machine.bytes.values())] = True
        for group in (g for texts in batches for g in _groups(texts)):
            rows, coded = [], iter(machine.encode_all([t for t in group if t is not None]))
            for text in group:
                if text is None:
                    rows.append((None, None, None, None))
                    continue
                ids = next(coded)
                rows.append((len(ids), int(np.count_nonzero(fallback[ids])), machine.decode(ids) == text, ids))
            yield pd.DataFrame(rows, columns=["n_tokens", "n_byte_tokens", "round_trip", "ids"]).astype(
                {"n_tokens": "Int64", "n_byte_tokens": "Int64", "round_trip": "boolean"})

    return encode.asNondeterministic()(text)


def decoded(model: PieceModel, ids: Column) -> Column:
    """Text of an array of ids; null for null."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield rows.map(lambda r: None if r is None else shared.value.decode(np.asarray(r, dtype=np.int64)))

    return decode(ids)
