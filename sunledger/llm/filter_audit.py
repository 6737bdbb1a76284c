"""How corpus filters act on each other: what each removes in every order, and what others would have removed anyway.

One pass of a table-driven transducer over the bytes of a text gives all counts the filters need; the audit itself works
on the few distinct sets of failed filters, not on documents.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Mapping
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import stored

# States of the transducer, named by the byte that leads there. TAIL: a UTF-8 byte that continues a code point.
SPACE, WORD, CAPITAL, SYMBOL, TAIL = range(5)
SPACES, SYMBOLS = b" \t\n\v\f\r", b"#$%&*|"
# Bytes that are worked off at once.
SEGMENT = 1 << 20
MEASURES = "doc_id {id}, part string, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long, digest binary"
# A filter's letter and when a text fails it. The letters name the filters in orders; `first_id` is the smallest doc_id
# with the same text.
FILTERS: Mapping[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_points",
    "D": "n_symbols > 0",
    "E": "doc_id > first_id",
}


def next_states() -> np.ndarray:
    """The transition table, 256 entries: a byte leads to the same state from every state."""
    table = np.full(256, WORD, np.uint8)
    for state, members in ((SPACE, SPACES), (SYMBOL, SYMBOLS), (CAPITAL, range(ord("A"), ord("Z") + 1)), (TAIL, range(0x80, 0xC0))):
        table[list(members)] = state
    return table


NEXT = next_states()


@dataclass
class Counts:
    words: int = 0
    distinct: int = 0
    capitals: int = 0
    points: int = 0
    symbols: int = 0


def measure(data: bytes) -> Counts:
    """One pass over the bytes, in segments that hand on the state and the start of a word cut in two.

    The step from SPACE to another state opens a word and the step back closes it; its span goes into a hash table that
    compares the bytes of spans whose hashes agree, so words are counted exactly.
    """
    seen = np.zeros(5, np.int64)
    spans: set[bytes] = set()
    state, opened, words = SPACE, 0, 0
    for at in range(0, len(data), SEGMENT):
        states = NEXT[np.frombuffer(data, np.uint8, min(SEGMENT, len(data) - at), at)]
        seen += np.bincount(states, minlength=5)
        spaced = states == SPACE
        turns = np.flatnonzero(np.diff(spaced, prepend=state == SPACE)) + at
        edges = turns.tolist() if state == SPACE else [opened, *turns.tolist()]
        state = int(states[-1])
        if len(edges) % 2:
            opened = edges.pop()
        words += len(edges) // 2
        spans.update([data[a:b] for a, b in zip(edges[::2], edges[1::2])])
    if state != SPACE:
        words += 1
        spans.add(data[opened:])
    return Counts(words, len(spans), int(seen[CAPITAL]), len(data) - int(seen[TAIL]), int(seen[SYMBOL]))


def measured(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, part (lang, null as the empty string), the counts, and the text's SHA-256."""
    rows = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    )

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = zip(*(astuple(measure(t)) for t in texts)) if texts else [[]] * 5
            columns = [pa.array(c, pa.int64()) for c in counts]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            names = ["doc_id", "part", "n_words", "n_distinct", "n_capitals", "n_points", "n_symbols", "digest"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, digests], names)

    return rows.mapInArrow(run, MEASURES.format(id=docs.schema["doc_id"].dataType.simpleString()))


def failed_filters(docs: DataFrame, filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """Per row of docs: doc_id, part, failed (the letters of the filters it fails, in their order).

    A null text is empty. A filter whose condition is null is passed: a row without a doc_id repeats no smaller one.
    """
    rows = stored(measured(docs), "measures")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # Stored, so that the join has a shuffle of its own on both sides, which adaptive execution may split at a hot text.
    told = rows.join(stored(copies.drop("_n"), "first-copies").hint("merge"), "digest", "left")
    letters = [F.when(F.coalesce(F.expr(condition), F.lit(False)), F.lit(letter)).otherwise(F.lit("")) for letter, condition in filters.items()]
    return told.select("doc_id", "part", F.concat(*letters).alias("failed"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` with good and toxic: whether any label row of the doc_id says quality = 1, toxic = 1."""
    said = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    return rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])


def audit(rows: DataFrame, letters: str) -> DataFrame:
    """From rows (part, failed, good, toxic) the audit of every order of the filters; see `audit_filters`."""
    profiles = rows.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(letters)])
    steps = profiles.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    steps = steps.withColumns({"own": own, "before": F.expr("substring(filter_order, 1, step - 1)")})
    earlier = F.expr("translate(failed, before, '') != failed")
    fails = F.expr("instr(failed, own) > 0")
    here = fails & ~earlier

    def total(n: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0)).cast("long")

    counted = steps.groupBy("part", "filter_order", "step", "own").agg(
        total("n", ~earlier & ~fails).alias("kept"),
        total("n", here).alias("removed"),
        total("n", fails & earlier).alias("redundant"),
        total("n", F.col("failed") == F.col("own")).alias("unique_fails"),
        total("n_good", here).alias("good_lost"),
        total("n_toxic", here).alias("toxic_lost"),
    )
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")


def audit_filters(docs: DataFrame, labels: DataFrame, filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `filters` maps single letters to SQL conditions on the columns of `measured` and `first_id`; their number is small,
    as every order is reported. kept: rows left after the step; removed: rows it takes; redundant: rows that fail its
    filter and are gone already; unique_fails: rows that fail no other filter; good_lost, toxic_lost: of the removed those
    labelled quality = 1, toxic = 1; shapley: what the step's filter removes, summed over all orders.

    Repeated rows count each, and repeated label rows of a doc_id count once. Null lang is the part ''. Documents without
    labels are neither good nor toxic. No documents, no rows.
    """
    return audit(labelled(failed_filters(docs, filters), labels), "".join(filters))
