"""Dedup of repeated byte strings by a distributed merge sort of suffixes that knows common prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import stored
from sunledger.llm.repeats import (
    MULTIPLIER,
    anchor_rows,
    covered,
    distinct_unions,
    lists_of,
    mix,
    repeated_anchors,
    window_rows,
    with_heads,
    with_spans,
)

WINDOW_BYTES = 200
GRAM_BYTES = 72
# Distinct suffixes that one merge task takes, about; unions of one gram beyond which single windows are counted instead.
SUFFIXES_PER_RANGE = 20_000
MOST_KINDS = 5_000
# Bytes of suffixes a task holds before it sorts them and sends the run off.
RUN_BYTES = 32 << 20

BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
DECISION_SCHEMA = "gram long, union long, late array<struct<a:int,b:int>>"
DECISIONS = pa.schema(
    [("gram", pa.int64()), ("union", pa.int64()), ("late", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))]
)


def byte_values(text: bytes) -> np.ndarray:
    return BYTE_VALUES[np.frombuffer(text, np.uint8)]


@dataclass(slots=True)
class Suffix:
    """`key`: the gram's hash, then the text from the gram on; `left`: the text of the union before the gram."""

    key: bytes
    left: bytes
    gram: int
    union: int
    count: int


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of which `known` bytes are known to agree."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def spread(gram: int) -> bytes:
    """The gram's hash as the first bytes of a key. Anchors have the smallest hashes around, so all of them are small; an
    odd factor deals them evenly over the ranges and keeps different hashes apart."""
    return (gram * MULTIPLIER & (2**64 - 1)).to_bytes(8, "big")


def pack_run(suffixes: list[Suffix]) -> bytes:
    """A sorted run, front-coded: each key without the prefix it shares with the key before."""
    shared, tails, before = [], [], b""
    for s in suffixes:
        shared.append(common_prefix(before, s.key))
        tails.append(s.key[shared[-1] :])
        before = s.key
    numbers = [shared, [len(t) for t in tails], [len(s.left) for s in suffixes]]
    ids = [[s.gram for s in suffixes], [s.union for s in suffixes], [s.count for s in suffixes]]
    parts = [np.array([len(suffixes)], np.int64).tobytes()]
    parts += [np.array(x, np.int32).tobytes() for x in numbers] + [np.array(x, np.int64).tobytes() for x in ids]
    return b"".join([*parts, *tails, *(s.left for s in suffixes)])


def read_run(packed: bytes) -> Iterator[tuple[Suffix, int]]:
    """The suffixes of a run, one by one, each with the length of the prefix it shares with the one before."""
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    at = 8
    shared, tails, lefts = (np.frombuffer(packed, np.int32, n, at + 4 * n * i).tolist() for i in range(3))
    at += 12 * n
    grams, unions, counts = (np.frombuffer(packed, np.int64, n, at + 8 * n * i).tolist() for i in range(3))
    at += 24 * n
    left_at, key = at + sum(tails), b""
    for i in range(n):
        key = key[: shared[i]] + packed[at : at + tails[i]]
        left = packed[left_at : left_at + lefts[i]]
        at += tails[i]
        left_at += lefts[i]
        yield Suffix(key, left, grams[i], unions[i], counts[i]), shared[i]


class LoserTree:
    """Merges sorted runs. Every run's head carries the length of the prefix it shares with the last winner it met: of
    two heads the one that shares more is smaller, and only a tie is settled by bytes, from that length on."""

    def __init__(self, runs: Iterable[Iterator[tuple[Suffix, int]]]):
        self.runs = list(runs)
        self.width = 1 << max(0, (len(self.runs) - 1).bit_length())
        self.heads: list[Suffix | None] = [None] * self.width
        self.shared = [0] * self.width
        for r in range(len(self.runs)):
            self._advance(r)
        self.losers = [-1] * self.width
        self.winner = self._play(1)

    def _advance(self, r: int) -> None:
        self.heads[r], self.shared[r] = next(self.runs[r], (None, 0))

    def _duel(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser keeps what it shares with the winner."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        common = common_prefix(x.key, y.key, self.shared[a])
        first, second = (a, b) if x.key[common : common + 1] <= y.key[common : common + 1] else (b, a)
        self.shared[second] = common
        return first, second

    def _play(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        winner, self.losers[node] = self._duel(self._play(2 * node), self._play(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[Suffix, int]]:
        """All suffixes in order, each with the prefix it shares with the one before."""
        while (head := self.heads[self.winner]) is not None:
            yield head, self.shared[self.winner]
            run = self.winner
            self._advance(run)
            node = (run + self.width) // 2
            while node >= 1:
                run, self.losers[node] = self._duel(run, self.losers[node])
                node //= 2
            self.winner = run


def repeated_windows(group: list[Suffix], shared: list[int], window: int) -> Iterator[tuple[Suffix, list[tuple[int, int]]]]:
    """For suffixes that share their gram, in suffix order: the windows (as ranges a..b of window numbers) that occur
    more than once. `shared` is what each key shares with the one before.

    A window with `l` bytes before the gram goes on for window - l bytes from there. What a suffix shares with any other it
    shares with a neighbour, so windows that go on for longer than that occur once. Of the rest, two agree from the gram
    on exactly if no neighbour between them shares less; those are compared on the `l` bytes left of it."""
    common = [n - 8 for n in shared] + [0]
    lead = [len(s.left) for s in group]
    last = [len(s.left) + len(s.key) - 8 - window for s in group]
    late: list[list[int]] = [[] for _ in group]
    members: dict[int, list[int]] = {}
    if any(s.count == 1 for s in group):
        for i in range(len(group)):
            for l in range(max(lead[i] - last[i], window - max(common[i], common[i + 1])), lead[i] + 1):  # noqa: E741
                members.setdefault(l, []).append(i)
    for l in sorted(members, reverse=True):  # noqa: E741
        block = before = members[l][0]
        alike: dict[tuple[int, bytes], list[int]] = {}
        for i in members[l]:
            if i != before and min(common[before + 1 : i + 1]) < window - l:
                block = i
            before = i
            alike.setdefault((block, group[i].left[lead[i] - l :]), []).append(i)
        for found in alike.values():
            if len(found) > 1:
                for i in found:
                    late[i].append(lead[i] - l)
    for s, found, end in zip(group, late, last):
        if s.count > 1:
            yield s, [(0, end)]
        elif found:
            gaps = [i for i in range(1, len(found)) if found[i - 1] != found[i] - 1]
            yield s, [(found[a], found[b - 1]) for a, b in zip([0, *gaps], [*gaps, len(found)])]


def sorted_runs(heads: DataFrame, ranges: int, window: int) -> DataFrame:
    """(range, run): each task sorts the suffixes it holds and cuts them by ranges of the gram's hash."""

    def run(batches):
        held: list[Suffix] = []
        size = 0

        def runs():
            held.sort(key=lambda s: s.key)
            start = 0
            for i in range(1, len(held) + 1):
                if i == len(held) or range_of(held[i].key) != range_of(held[start].key):
                    yield range_of(held[start].key), pack_run(held[start:i])
                    start = i

        def sent():
            rows = list(runs())
            return pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["range", "run"]
            )

        for batch in batches:
            for text, h in zip(batch.column(1).to_pylist(), lists_of(batch.column(2))):
                for first, n, lead, gram, union, count in zip(*(h[k].tolist() for k in ("first", "n", "lead", "gram", "union", "c"))):
                    at = first + lead
                    key = spread(gram) + text[at : first + n - 1 + window]
                    held.append(Suffix(key, text[first:at], gram, union, count))
                    size += n + window + 100
                if size > RUN_BYTES:
                    yield sent()
                    held, size = [], 0
        if held:
            yield sent()

    def range_of(key: bytes) -> int:
        return int.from_bytes(key[:8], "big") * ranges >> 64

    return heads.mapInArrow(run, "range int, run binary")


def merged_decisions(runs: DataFrame, ranges: int, gram: int, window: int) -> DataFrame:
    """Merge the runs of each range and decide the windows of every group of suffixes with a common gram."""

    def decide(packed: list[bytes]):
        group: list[Suffix] = []
        prefixes: list[int] = []
        for suffix, shared in LoserTree(read_run(p) for p in packed):
            if group and shared < 8 + gram:
                yield from repeated_windows(group, prefixes, window)
                group, prefixes = [], []
            prefixes.append(shared if group else 0)
            group.append(suffix)
        if group:
            yield from repeated_windows(group, prefixes, window)

    def batch_of(packed: list[bytes]) -> pa.RecordBatch:
        rows = [(s.gram, s.union, [{"a": a, "b": b} for a, b in late]) for s, late in decide(packed)]
        columns = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, DECISIONS)], schema=DECISIONS)

    def run(batches):
        current, packed = None, []
        for batch in batches:
            for r, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if r != current and packed:
                    yield batch_of(packed)
                    packed = []
                current = r
                packed.append(x)
        if packed:
            yield batch_of(packed)

    return runs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, DECISION_SCHEMA)


def counted_decisions(docs: DataFrame, unions: DataFrame, window: int) -> DataFrame:
    """The same decisions for grams with more unions than one task should hold: windows are counted by their hashes."""
    windows = stored(window_rows(with_heads(docs, unions), byte_values, window), "hot-windows")
    rows = windows.join(unions.select("gram", "union", "c"), ["gram", "union"])
    counts = rows.groupBy("w1", "w2").agg(F.sum("c").alias("times")).where("times > 1")
    late = windows.join(stored(counts, "hot-repeats").hint("merge"), ["w1", "w2"])
    piece = F.struct(F.col("j").alias("a"), F.col("j").alias("b"))
    return late.groupBy("gram", "union").agg(F.collect_list(piece).alias("late"))


def repeated_spans(docs: DataFrame, window: int = WINDOW_BYTES, gram: int = GRAM_BYTES) -> DataFrame:
    """(doc_id, _twin, start, end): byte spans covered by strings of `window` bytes that also start elsewhere.

    1. A suffix matters only if the gram of its anchor repeats (a count on 64-bit hashes); equal stretches collapse to
       their first place and a count, so every distinct suffix is exchanged once.
    2. Each task sorts its suffixes and sends front-coded runs to the tasks that own their ranges. Ranges are those of
       the gram's hash, which stands before the suffix in the sort key: ranges are even without sampling, and equal
       windows meet in one task.
    3. Runs are merged by loser trees. Neighbours that share a gram form a group; the prefix lengths that the trees carry
       tell which of its windows agree from the gram on, and only those are compared on the left of it.
    4. The decisions go back to all occurrences.
    """
    anchors = repeated_anchors(anchor_rows(docs, byte_values, gram, window))
    unions = distinct_unions(anchors)
    ranges = max(1, math.ceil(unions.count() / SUFFIXES_PER_RANGE))
    runs = stored(sorted_runs(with_heads(docs, unions.where(F.col("kinds") <= MOST_KINDS)), ranges, window), "suffix-runs")
    hot = unions.where(F.col("kinds") > MOST_KINDS)
    decisions = merged_decisions(runs, ranges, gram, window).unionByName(counted_decisions(docs, hot, window))
    judged = anchors.join(stored(decisions, "suffix-decisions").hint("merge"), ["gram", "union"])
    late = judged.select("doc_id", "_twin", "first", F.explode("late").alias("late"))
    return late.select(
        "doc_id", "_twin", (F.col("first") + F.col("late.a")).alias("start"), (F.col("first") + F.col("late.b") + window).alias("end")
    )


def dedup_suffixes(docs: DataFrame, window: int = WINDOW_BYTES, gram: int = GRAM_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, spans (removed runs as byte offsets), kept (the remaining bytes).

    A byte goes if a string of `window` bytes covers it that also starts anywhere else, in the same document or another,
    as the texts come in; strings never cross documents. Null texts are empty; shorter texts stay whole; of repeated
    rows each is a place of its own, so both lose what they share. No documents, no rows.
    """

    def run(batches):
        for batch in batches:
            sizes, runs, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), lists_of(batch.column(2))):
                text = text or b""
                sizes.append(len(text))
                if not len(spans["start"]):
                    runs.append([])
                    kept.append(text)
                    continue
                gone = covered(spans, len(text))
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                runs.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    rows = with_spans(docs, repeated_spans(docs, window, gram))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
