"""SimHash near-dedup: a generalised pigeonhole over correlated bit groups, probe and verify, then components."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import fresh_name, identified, stored

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
BITS = 64
# Shingles whose bits are unpacked at once.
SHINGLES_PER_STEP = 1 << 16
# A bucket with more fingerprints than this is not compared pair by pair; see `clique_links`.
BUCKET_ROWS = 64
# Cost of sending a probe, in compared candidates.
PROBE_COST = 4.0


def fingerprint(text: bytes | None) -> int:
    """64 bits: bit b is set if it is set in over half the shingles' XXH64. No words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(SHINGLE_WORDS, len(words))
    n = len(words) - size + 1
    first, last = starts[:n].tolist(), ends[size - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES_PER_STEP):
        step = slice(at, at + SHINGLES_PER_STEP)
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(first[step], last[step])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, _twin (a hash of the text), fingerprint (as a long) of every row."""

    def run(batches):
        for batch in batches:
            prints = pa.array([fingerprint(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "_twin", "fingerprint"])

    rows = identified(docs, F.col("text").cast("binary").alias("text")).select(F.col("doc_id").cast("long").alias("doc_id"), "_twin", "text")
    return rows.mapInArrow(run, "doc_id long, _twin long, fingerprint long")


@dataclass(frozen=True)
class Part:
    """A group of bit positions (0 is the lowest) and how many of them may differ; -1: the group is not probed."""

    bits: tuple[int, ...]
    most: int

    @property
    def mask(self) -> int:
        value = sum(1 << b for b in self.bits)
        return value - (1 << 64) if value >> 63 else value

    def flips(self) -> list[int]:
        """What a probe changes: every choice of at most `most` of the bits."""
        choices = itertools.chain.from_iterable(itertools.combinations(self.bits, k) for k in range(self.most + 1))
        return [v - (1 << 64) if (v := sum(1 << b for b in c)) >> 63 else v for c in choices]


def bit_statistics(prints: DataFrame) -> np.ndarray:
    """How often each pair of bits is set together, over all fingerprints; 64 x 64 numbers come back."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            bits = ((values[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
            total += bits.T @ bits
            n += len(values)
        if n:
            cells = pa.array(np.arange(BITS * BITS + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([cells, pa.array(np.append(total.ravel(), n))], ["cell", "n"])

    sums = np.zeros(BITS * BITS + 1)
    for row in prints.select("fingerprint").mapInArrow(run, "cell int, n double").groupBy("cell").agg(F.sum("n")).collect():
        sums[row[0]] = row[1]
    return sums


def correlated_groups(sums: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """The 64 bits in groups of about equal size, each grown from the freest bit by the most correlated ones."""
    n = max(1.0, sums[-1])
    together = sums[:-1].reshape(BITS, BITS) / n
    p = np.diag(together)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    strength = np.abs(together - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for i in range(parts):
        size = len(free) // (parts - i)
        group = [max(sorted(free), key=lambda b: sum(strength[b][o] for o in free))]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: sum(strength[b][o] for o in group))
            group.append(best)
            free.discard(best)
        groups.append(tuple(sorted(group)))
    return groups


def candidate_costs(sums: np.ndarray, bits: Sequence[int], pairs: float, most: int) -> list[float]:
    """Estimated cost of probing a group with 0, 1, ... differing bits: probes sent, and candidates to verify.
    `pairs` counts those that agree on the group; allowing bit b to differ adds pairs in the ratio of its
    chances to differ and to agree."""
    n = max(1.0, sums[-1])
    p = np.diag(sums[:-1].reshape(BITS, BITS))[list(bits)] / n
    agree = np.maximum(p * p + (1 - p) * (1 - p), 1e-9)
    odds = (1 - agree) / agree
    grown = [1.0, odds.sum(), (odds.sum() ** 2 - (odds**2).sum()) / 2]
    return [
        sum(math.comb(len(bits), k) for k in range(t + 1)) * n * PROBE_COST + pairs * sum(grown[: t + 1])
        for t in range(most + 1)
    ]


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """The cheapest thresholds, -1 and up for each group, that sum to `total`, by dynamic programming over groups."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(row)):
                option = (cost + (row[t] if t >= 0 else 0.0), [*chosen, t])
                if spent + t not in grown or option < grown[spent + t]:
                    grown[spent + t] = option
        best = grown
    return best[total]


def plan_parts(prints: DataFrame, most: int = MOST_BITS, counts: Sequence[int] = (1, 2, 3)) -> list[Part]:
    """Groups and thresholds. By the generalised pigeonhole principle, fingerprints at most `most` bits apart agree up to
    t_i bits on some group i if the thresholds sum to most - groups + 1. Of several numbers of groups the cheapest wins;
    the counts behind the costs cover all fingerprints."""
    sums = bit_statistics(prints)
    best: tuple[float, list[Part]] | None = None
    for m in counts:
        groups = correlated_groups(sums, m)
        masked = [F.col("fingerprint").bitwiseAND(F.lit(Part(g, 0).mask)) for g in groups]
        sides = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), v.alias("key")) for i, v in enumerate(masked)]))
        sizes = prints.select(sides.alias("s")).groupBy("s.part", "s.key").agg(F.count(F.lit(1)).alias("n"))
        pairs = dict(sizes.groupBy("part").agg(F.sum(F.col("n").cast("double") * F.col("n"))).collect())
        cost, chosen = allocate([candidate_costs(sums, g, pairs.get(i, 0.0), most) for i, g in enumerate(groups)], most - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [Part(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def keyed(prints: DataFrame, parts: Sequence[Part], probe: bool) -> DataFrame:
    """(part, key, fingerprint): the group's bits, or all their variants that a probe looks up."""
    keys = [
        F.struct(F.lit(i).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(p.mask)).bitwiseXOR(F.lit(flip)).alias("key"))
        for i, p in enumerate(parts)
        for flip in (p.flips() if probe else [0])
    ]
    return prints.select(F.explode(F.array(*keys)).alias("k"), "fingerprint").select("k.part", "k.key", "fingerprint")


def clique_links(prints: DataFrame) -> DataFrame:
    """Links among the given fingerprints without comparing pairs: all that lie within one bit of a common value are at
    most two bits apart, and any two at most two bits apart share such a value. The members of a value (at most 65)
    are linked to their smallest. For thresholds of two bits."""
    flips = [0, *[v - (1 << 64) if (v := 1 << b) >> 63 else v for b in range(BITS)]]
    values = F.explode(F.array(*[F.col("fingerprint").bitwiseXOR(F.lit(f)) for f in flips]))
    near = prints.select(values.alias("value"), "fingerprint")
    smallest = near.groupBy("value").agg(F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = near.join(stored(smallest.select("value", "a"), "cliques").hint("merge"), "value")
    return joined.where(F.col("a") != F.col("fingerprint")).select("a", F.col("fingerprint").alias("b"))


def links(prints: DataFrame, most: int = MOST_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b), a < b: distinct fingerprints at most `most` bits apart, enough of them to connect all that are.

    Each fingerprint probes the buckets of its variants and verifies what it finds; a bucket holds at most `bucket_rows`
    for that. Whatever meets a larger bucket is linked by `clique_links`, which loses nothing and never pairs a group.
    """
    if most > 2:
        raise ValueError("at most two bits")
    parts = plan_parts(prints, most)
    index = stored(keyed(prints, parts, probe=False), "simhash-index")
    sizes = index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(sizes.where(F.col("n") > bucket_rows).select("part", "key"), "hot-buckets")
    probes = keyed(prints, parts, probe=True)
    cold = index.join(hot, ["part", "key"], "left_anti")
    found = (
        probes.withColumnRenamed("fingerprint", "a")
        .join(cold.withColumnRenamed("fingerprint", "b").hint("merge"), ["part", "key"])
        .where((F.col("a") != F.col("b")) & (apart(F.col("a"), F.col("b")) <= most))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    crowded = probes.unionByName(index).join(hot, ["part", "key"], "left_semi").select("fingerprint").distinct()
    exact = clique_links(stored(crowded, "crowded")).where(apart(F.col("a"), F.col("b")) <= most)
    return found.unionByName(exact).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node of its component.

    Large-star and small-star rounds, each stored; a round hangs every node under a smaller neighbour of a neighbour, and
    the rounds end when no edge changes. A hub is a long run of one join key, which adaptive execution splits.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(both.where("b > a").join(stored(least, "large-star").hint("merge"), "a").select(F.col("m").alias("a"), "b").distinct(), "edges")
        low = stored(large.groupBy("b").agg(F.min("a").alias("m")), "small-star")
        small = large.join(low.hint("merge"), "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = stored(small.unionByName(low.select(F.col("m").alias("a"), "b")).distinct(), "edges")


def component_firsts(rows: DataFrame, first: Column, most: int = MOST_BITS) -> DataFrame:
    """(fingerprint, first): per distinct fingerprint of the rows the smallest `first` in its component. Copies share a
    fingerprint, so links are sought between distinct fingerprints only."""
    classes = stored(rows.groupBy("fingerprint").agg(F.min(first).alias("least")), "fingerprint-classes")
    roots = components(links(classes.select("fingerprint"), most))
    rooted = stored(
        classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
        ),
        "roots",
    )
    firsts = stored(rooted.groupBy("root").agg(F.min("least").alias("first")), "component-firsts")
    return stored(rooted.join(firsts.hint("merge"), "root").select("fingerprint", "first"), "named-fingerprints")


def near_duplicates(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Per row of docs: doc_id, fingerprint (long), component_id.

    Rows are linked if their fingerprints differ in at most `most` bits; component_id is the smallest doc_id that links
    reach. Null and blank texts have fingerprint zero and are linked like any other; a null doc_id is never the smallest
    unless all are null. Repeated rows come back as often as they are there. No documents, no rows.
    """
    rows = stored(fingerprints(docs).select("doc_id", "fingerprint"), "fingerprints")
    named = component_firsts(rows, F.col("doc_id"), most)
    return rows.join(named.hint("merge"), "fingerprint").select("doc_id", "fingerprint", F.col("first").alias("component_id"))


def dedup_near(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """The documents that stay, with all their columns: of each component the one with the smallest doc_id, or one
    without a doc_id if none has any. A doc_id that repeats with texts of several components may stay once in each; rows
    that repeat both doc_id and text stay one. The smaller hash of the text settles what is left."""
    name, number, twin = (fresh_name(docs, c) for c in ("_nameless", "_number", "_twin"))
    row = [F.col("doc_id").isNull().alias(name), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(number)]
    firsts = component_firsts(stored(fingerprints(docs), "fingerprints"), F.struct(*row, F.col("_twin").alias(twin)), most)
    # Keys that are never null: the join's partitioning serves the removal of repeated rows as well.
    keyed_docs = docs.select("*", *row, F.xxhash64(F.coalesce("text", F.lit(""))).alias(twin))
    kept = keyed_docs.join(firsts.select("first.*").distinct(), [name, number, twin], "left_semi")
    return kept.dropDuplicates([name, number, twin]).select(*docs.columns)


def as_hex(prints: Column) -> Column:
    return F.lower(F.lpad(F.hex(prints), 16, "0"))
