"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks. Column functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import BROADCAST_ROWS, SPACE_WORD, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
# Words of a block, at most; the schedule has the next power of two of slots.
BLOCK_WORDS = 1024
# Documents or slots that one ranking task sorts, about.
ROWS_PER_RANGE = 50_000
SLOTS_PER_RANGE = 65_536


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the hash that shuffles the documents of a source: of id and text, so rows that share an
    id, or have none, are spread as well."""
    order = F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    return stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), order.alias("order")), "sizes")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS
) -> DataFrame:
    """One row per source: source, no, source_size, target.

    Sources by code point, null last, weigh `weights` in turn and divide `share` times all words; a target stops at
    `most` times its source, and the excess goes to the others by weight. In the order of cap / weight the capped
    sources come first, so one running sum finds them: a source is capped if the level of those not capped before it
    reaches its own cap. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("no", F.row_number().over(by_name)).withColumns(
        {
            "weight": F.element_at(cycle, ((F.col("no") - 1) % len(weights) + 1).cast("int")),
            "cap": F.col("source_size") * F.lit(float(most)),
        }
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "no").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(filling), F.lit(0.0))
    levels = ranked.withColumns(
        {
            "pool": F.sum("source_size").over(everything) * F.lit(float(share)),
            "weights": F.sum("weight").over(everything),
            "cap_before": before("cap"),
            "weight_before": before("weight"),
        }
    ).withColumn(
        "capped",
        (F.col("pool") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")) >= F.col("cap") / F.col("weight"),
    )
    free = lambda c, flag: F.coalesce(F.sum(F.when(flag, F.col(c))).over(everything), F.lit(0.0))
    level = F.try_divide(
        F.col("pool") - free("cap", F.col("capped")), free("weight", ~F.col("capped"))
    )
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return levels.select("source", "no", "source_size", target.alias("target"))


def reversed_bits(n: Column, bits: int) -> Column:
    """The van der Corput order: the bits of n read backwards."""
    if bits == 0:
        return F.lit(0).cast("long")
    return F.conv(F.reverse(F.lpad(F.bin(n), bits, "0")), 2, 10).cast("long")


def slot_schedule(targets: DataFrame, pool: float, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """(no, rank, slot) for every block that is taken, and the words of a block.

    2^m slots carry the van der Corput points bits(slot) / 2^m. A source owns the points within its share of the
    cumulative targets, so its slots are found from its interval without a join, and any stretch of the schedule holds
    each source near its weight. Its slots are ranked: first per range of slots, then by the number of slots in the
    ranges before. A source passes over points beyond its quota; a block that rounding left without a point comes last.
    """
    slots_needed = max(1, math.ceil(pool / block_words))
    bits = (slots_needed - 1).bit_length()
    slots = 1 << bits
    block = max(1, math.ceil(pool / slots))
    along = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    spans = (
        targets.withColumn("quota", F.floor("target"))
        .withColumns({"until": F.sum("quota").over(along), "all": F.sum("quota").over(everything)})
        .withColumns(
            {
                "low": F.ceil((F.col("until") - F.col("quota")) / F.col("all") * F.lit(float(slots))),
                "high": F.ceil(F.col("until") / F.col("all") * F.lit(float(slots))),
                "blocks": F.ceil(F.col("quota") / F.lit(float(block))),
            }
        )
        .where("quota > 0")
        .select("no", "low", "high", "blocks")
    )
    step = SLOTS_PER_RANGE
    starts = spans.where("high > low").select("no", "blocks", "high", F.explode(F.expr(f"sequence(low, high - 1, {step}L)")).alias("from"))
    points = starts.repartition("no", "from").select(
        "no", "blocks", F.explode(F.expr(f"sequence(from, least(from + {step - 1}, high - 1))")).alias("point")
    )
    owned = points.withColumn("slot", reversed_bits(F.col("point"), bits)).withColumn("range", F.expr(f"slot div {step}"))
    counts = owned.groupBy("no", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("no", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("no", "range").orderBy("slot")
    ranked = (
        owned.withColumn("within", F.row_number().over(inside))
        .join(counts.hint("merge"), ["no", "range"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .where("rank < blocks")
        .select("no", "rank", "slot")
    )
    closing = spans.where("high - low < blocks").select(
        "no", F.explode(F.expr("sequence(high - low, blocks - 1)")).alias("rank")
    )
    return ranked.unionByName(closing.withColumn("slot", F.lit(slots).cast("long"))), block


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix as pieces of documents: doc_id, source, size, source_size, target, row, slot, words.

    The documents of a source lie shuffled on a line of words that repeats `most` times; block k of that line is the
    source's k-th slot. A document has a piece for each block it reaches into before the target ends, and one piece
    without slot and words if it reaches into none. `row` names the document (doc_ids may repeat or be null).
    The order on the line is that of a hash of the doc_id, so reruns agree; equal doc_ids lie by size. Null texts and
    texts without words have size 0 and are never taken; a null source is a source, the last one. No documents, no rows.

    A hot source is cut by hash ranges: positions are summed per (source, range), then over the ranges.
    """
    sizes = sized_documents(docs)
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    facts = targets.agg(F.sum("target").alias("pool"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, math.ceil(sizes.count() / ROWS_PER_RANGE))
    schedule, block = slot_schedule(targets, facts["pool"] or 0.0, block_words)

    known = F.broadcast(targets) if facts["n"] <= BROADCAST_ROWS else targets
    rows = sizes.join(known.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    hashed = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = rows.withColumn("range", F.floor(hashed * F.lit(float(ranges))).cast("int"))
    sums = rows.groupBy("no", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("no", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("no", "range").orderBy("order", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumns({"within": F.sum("size").over(upto), "nth": F.row_number().over(inside)})
        .join(sums, ["no", "range"])
        .withColumns(
            {
                "start": F.col("before") + F.col("within") - F.col("size"),
                "quota": F.floor("target"),
                "row": F.struct("no", "range", "nth"),
            }
        )
    )
    copy = F.explode(F.expr(f"sequence(0L, {int(most) - 1}L)"))
    copies = placed.withColumn("copy", copy).withColumns(
        {
            "from": F.col("start") + F.col("copy") * F.col("source_size"),
            "to": F.least(F.col("start") + F.col("copy") * F.col("source_size") + F.col("size"), F.col("quota")),
        }
    )
    reach = F.when(
        F.col("from") < F.col("to"), F.sequence(F.expr(f"from div {block}L"), F.expr(f"(to - 1) div {block}L"))
    ).when(F.col("copy") == 0, F.array(F.lit(-1).cast("long")))
    pieces = copies.withColumn("rank", F.explode(reach)).withColumn(
        "words",
        F.when(F.col("rank") < 0, F.lit(0).cast("long")).otherwise(
            F.least(F.col("to"), (F.col("rank") + 1) * block) - F.greatest(F.col("from"), F.col("rank") * block)
        ),
    )
    # The schedule grows with the corpus though the targets it unfolds from are few: never broadcast it.
    return pieces.join(schedule.hint("merge"), ["no", "rank"], "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "row",
        "slot",
        F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(F.lit(0).cast("long")).alias("words"),
    )


def words_taken(pieces: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    first = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    return pieces.groupBy("row").agg(*first, F.sum("words").alias("taken")).drop("row")
