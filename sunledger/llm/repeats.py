"""Repeated windows of a sequence: rolling hashes, and one anchor per stretch of windows.

A window of `window` items is represented by its anchor: the leftmost smallest of the hashes of its grams (runs of `gram`
items). The choice depends on the window's content alone, so equal windows have equal anchors at equal offsets, and a
window can only repeat where its anchor's gram repeats. Neighbouring windows mostly share an anchor: one row stands for
a whole stretch of windows, and the string that the stretch covers (its union) decides them together. Two stretches of
equal unions hold equal windows; only where one gram has several unions must single windows be compared.

What names a union or a window also counts modulo a prime: modulo 2^64 alone, texts of Thue-Morse shape lose bits for every
multiplier.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import identified, same_rows, stored

# Windows of a document that are hashed at once; longer documents are cut so, with overlap, which bounds memory.
SEGMENT = 1 << 17
MULTIPLIER = 0x9E3779B97F4A7C15
# A prime of which every product fits in 64 bits and is reduced by a shift, and the bases of two polynomial hashes.
PRIME = (1 << 31) - 1
BASES = (1_327_217_885, 861_505_417)
KEYS = ["doc_id", "_twin"]
ANCHOR_SCHEMA = "gram long, union long, doc_id long, _twin long, first long, lead int, n int"
ANCHORS = [("gram", pa.int64()), ("union", pa.int64()), ("doc_id", pa.int64()), ("_twin", pa.int64()), ("first", pa.int64()),
           ("lead", pa.int32()), ("n", pa.int32())]
WINDOW_SCHEMA = "w1 long, w2 long, doc_id long, pos long, gram long, union long, j int"
WINDOWS = pa.schema(
    [("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("gram", pa.int64()),
     ("union", pa.int64()), ("j", pa.int32())]
)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of a base and of its inverse, modulo 2^64 (an odd base) or modulo a prime below 2^31."""

    tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, base: int, modulus: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        known = cls.tables.get((base, modulus))
        if known is None or len(known[0]) < n:
            size = max(n, SEGMENT + 1024)
            known = tuple(cls._powers(m, modulus, size) for m in (base, pow(base, -1, modulus)))
            cls.tables[base, modulus] = known
        return known

    @staticmethod
    def _powers(base: int, modulus: int, n: int) -> np.ndarray:
        powers = np.ones(n, np.uint64)
        done = 1
        while done < n:
            more = min(done, n - done)
            step = powers[:more] * np.uint64(pow(base, done, modulus))
            powers[done : done + more] = step if modulus == 1 << 64 else step % np.uint64(modulus)
            done += more
        return powers


class Rolling:
    """Hash of any stretch values[start:end] in constant time."""

    def __init__(self, values: np.ndarray):
        powers, self.inverse = Powers.of(MULTIPLIER, 1 << 64, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[: len(values)], dtype=np.uint64, out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[:n])


class PrimeRolling:
    """The same, by two polynomials modulo a prime, over either half of the values, side by side in one word. Sums stay exact
    up to 2^32 values."""

    def __init__(self, values: np.ndarray):
        prime, bits = np.uint64(PRIME), np.uint64(31)
        self.parts = []
        for base, half in zip(BASES, (values >> np.uint64(33), values & prime)):
            powers, inverse = Powers.of(base, PRIME, len(values) + 1)
            terms = half * powers[: len(values)]
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum((terms & prime) + (terms >> bits), dtype=np.uint64, out=sums[1:])
            self.parts.append((inverse, sums))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        prime = np.uint64(PRIME)
        high, low = ((sums[end] - sums[start]) % prime * inverse[start] % prime for inverse, sums in self.parts)
        return mix(high << np.uint64(32) | low)


def leftmost_smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of `width` hashes, the index of its smallest; the upper hash bits decide, then the place."""
    place = np.uint64((1 << 18) - 1)
    keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        keys = np.minimum(keys[:-step], keys[step:])
        covered += step
    return (keys & place).astype(np.int64)


def run_starts(lead: np.ndarray, gram: int, runs: Sequence[int], window: int) -> list[np.ndarray]:
    """Where the gram's extensions to the lengths `runs` start, counted from the gram: to the right where the window has
    room, else to the left. It depends on the gram's place in the window alone, so equal windows extend alike."""
    starts, at, size = [], np.zeros_like(lead), gram
    for longer in runs:
        at = np.where(lead + at + longer <= window, at, at - (longer - size))
        starts.append(at)
        size = longer
    return starts


def anchors_of(values: np.ndarray, gram: int, window: int, runs: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, ...]]:
    """(gram hash, union hash, first window, gram's offset in it, windows, hashes of the gram's extensions to the lengths
    `runs`) of every stretch of windows, by segments."""
    for begin in range(0, len(values) - window + 1, SEGMENT):
        part = values[begin : begin + SEGMENT + window - 1]
        rolling, prime = Rolling(part), PrimeRolling(part)
        hashes = rolling.windows(gram)
        chosen = leftmost_smallest(hashes, window - gram + 1)
        starts = run_starts(chosen - np.arange(len(chosen)), gram, runs, window)
        cut = np.diff(chosen, prepend=-1) != 0
        for at in starts:
            cut |= np.diff(at, prepend=0) != 0
        first = np.flatnonzero(cut)
        n = np.diff(first, append=len(chosen))
        anchor = chosen[first]
        end = first + n - 1 + window
        unions = mix(rolling.hashes(first, end) + mix(prime.hashes(first, end) + n.astype(np.uint64)))
        extended = []
        for at, size in zip(starts, runs):
            start = anchor + at[first]
            extended.append(mix(rolling.hashes(start, start + size) + at[first].astype(np.uint64)))
        yield hashes[anchor], unions, first + begin, anchor - first, n, *extended


def _rows_of(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.to_pylist()]


def run_names(runs: Sequence[int]) -> list[str]:
    return [f"run{size}" for size in runs]


def anchor_rows(
    docs: DataFrame, values_of: Callable[[bytes], np.ndarray], gram: int, window: int, runs: Sequence[int] = ()
) -> DataFrame:
    """One row per stretch of windows of every document; texts of fewer items than a window have none."""
    schema = pa.schema([*ANCHORS, *((name, pa.int64()) for name in run_names(runs))])

    def run(batches):
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(_rows_of(batch.column(2))):
                for part in anchors_of(values_of(text), gram, window, runs):
                    found.append(part)
                    owner.append(np.full(len(part[0]), i))
            if not found:
                continue
            grams, unions, first, lead, n, *extended = (np.concatenate(c) for c in zip(*found))
            owners = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(unions.view(np.int64)), batch.column(0).take(owners),
                 batch.column(1).take(owners), pa.array(first), pa.array(lead.astype(np.int32)), pa.array(n.astype(np.int32)),
                 *(pa.array(h.view(np.int64)) for h in extended)],
                schema=schema,
            )

    return as_bytes(docs).mapInArrow(run, ", ".join([ANCHOR_SCHEMA, *(f"{name} long" for name in run_names(runs))]))


def as_bytes(docs: DataFrame) -> DataFrame:
    rows = identified(docs, F.col("text").cast("binary").alias("text"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "_twin", "text")


def repeated_anchors(anchors: DataFrame) -> DataFrame:
    """The rows whose gram occurs more than once: a pre-aggregated count, then a semi-join, both on the gram."""
    counts = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
    return stored(anchors.join(stored(counts, "repeated-grams").hint("merge"), "gram", "left_semi"), "repeated-anchors")


def distinct_unions(anchors: DataFrame, runs: Sequence[int] = ()) -> DataFrame:
    """One row per (gram, union): lead, n, c (how often), head (its first place), kinds (unions of this gram, or of its
    longest extension). Level by level, only stretches live on whose gram repeats in its extension to the next length;
    once no stretch is left, no further level runs."""
    head = F.min(F.struct("doc_id", "first", "_twin")).alias("head")
    names = run_names(runs)
    unions = stored(anchors.groupBy("gram", "union", "lead", "n", *names).agg(F.count(F.lit(1)).alias("c"), head), "unions")
    for name in names:
        if unions.isEmpty():
            break
        repeated = unions.groupBy(name).agg(F.sum("c").alias("times")).where("times > 1").select(name)
        unions = stored(unions.join(stored(repeated, f"repeated-{name}").hint("merge"), name, "left_semi"), f"unions-{name}")
    longest = names[-1] if names else "gram"
    kinds = unions.groupBy(longest).agg(F.count(F.lit(1)).alias("kinds"))
    return stored(unions.join(kinds, longest), "unions-by-kind")


def with_heads(docs: DataFrame, unions: DataFrame) -> DataFrame:
    """doc_id, text and `heads`, the given unions whose first place is in the document, in place order."""
    entry = F.struct(F.col("head.first").alias("first"), "n", "lead", "gram", "union", "c")
    lists = unions.groupBy(F.col("head.doc_id").alias("doc_id"), F.col("head._twin").alias("_twin")).agg(
        F.array_sort(F.collect_list(entry)).alias("heads")
    )
    # Rows that repeat both id and text hold the same heads; one of them speaks for all.
    return same_rows(lists, as_bytes(docs).dropDuplicates(KEYS), KEYS, "inner").select("doc_id", "text", "heads")


def lists_of(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """Per row the fields of a list of structs as arrays; a null list is empty."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    fields = {flat.type.field(i).name: flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)}
    at = 0
    for n in lengths.tolist():
        yield {k: v[at : at + n] for k, v in fields.items()}
        at += n


def window_rows(heads: DataFrame, values_of: Callable[[bytes], np.ndarray], window: int) -> DataFrame:
    """Every window of the listed unions, named by a hash modulo 2^64 and one modulo a prime."""

    def run(batches):
        for batch in batches:
            columns, owner = [], []
            for i, (text, h) in enumerate(zip(_rows_of(batch.column(1)), lists_of(batch.column(2)))):
                n = h["n"].astype(np.int64)
                which = np.repeat(np.arange(len(n)), n)
                j = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                pos = h["first"][which] + j
                low, high = pos.min(), pos.max() + window
                values = values_of(text)[low:high]
                hashes = [r(values).hashes(pos - low, pos - low + window).view(np.int64) for r in (Rolling, PrimeRolling)]
                columns.append((*hashes, pos, h["gram"][which], h["union"][which], j.astype(np.int32)))
                owner.append(np.full(len(which), i))
            if not columns:
                continue
            w1, w2, pos, grams, unions, j = (pa.array(np.concatenate(c)) for c in zip(*columns))
            ids = batch.column(0).take(pa.array(np.concatenate(owner)))
            yield pa.RecordBatch.from_arrays([w1, w2, ids, pos, grams, unions, j], schema=WINDOWS)

    return heads.mapInArrow(run, WINDOW_SCHEMA)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text (bytes) and `spans`, the list of (start, end) of each document; null where there is none."""
    lists = spans.groupBy(*KEYS).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return same_rows(as_bytes(docs), lists, KEYS, "left").select("doc_id", "text", "spans")


def covered(spans: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Which of n items some span covers."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, spans["start"], 1)
    np.add.at(steps, spans["end"], -1)
    return np.cumsum(steps[:-1]) > 0
