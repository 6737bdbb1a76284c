"""Substring dedup over words by level-wise doubling: what repeats at one length alone is extended to twice that length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import stored
from sunledger.llm.repeats import (
    anchor_rows,
    covered,
    distinct_unions,
    lists_of,
    repeated_anchors,
    window_rows,
    with_heads,
    with_spans,
)

WINDOW_WORDS = 20
# Runs of at most this many words are not halved: shorter ones repeat by chance almost everywhere, so that a level of them
# rules nothing out and costs a shuffle of every row.
SHORTEST_RUN = 10


def word_values(text: bytes) -> np.ndarray:
    """A 64-bit hash per word; bytes.split() cuts at \\x20 and \\x09-\\x0D, as no byte of a longer character is one."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def levels(window: int) -> list[int]:
    """Lengths of the levels: the window and its halves, rounded up, shortest first (20 words: 10, 20; 80 words: 10, 20, 40, 80)."""
    lengths = [window]
    while lengths[0] > SHORTEST_RUN:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def late_spans(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, _twin, start, end): word spans covered by windows whose words also start earlier.

    Level 1, the shortest length: a window can only repeat where one run in it (its anchor) does; runs are counted, and
    only rows of repeated ones live on. Each level doubles the run of every stretch that lives, to the right where the
    window has room, else to the left, and keeps what repeats at that length; it stops where no stretch is left. Last
    level, the full length: stretches of windows with equal unions are compared at once; every one but the first is late
    as a whole. A first one of several unions of the same run is extended window by window: a window is late if its two
    hashes name an earlier place. Levels are shuffles on hashes, so no group gathers in one task beyond what adaptive
    execution can split; from the second on they work on distinct stretches, not on their copies.
    """
    gram, *runs = levels(window)
    runs = runs[:-1]
    anchors = repeated_anchors(anchor_rows(docs, word_values, gram, window, runs))
    unions = distinct_unions(anchors, runs)
    windows = stored(window_rows(with_heads(docs, unions.where("kinds > 1")), word_values, window), "windows")
    place = F.struct("doc_id", "pos")
    earliest = windows.groupBy("w1", "w2").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("c")).where("c > 1")
    late = windows.join(stored(earliest, "earliest").hint("merge"), ["w1", "w2"]).where(F.col("earliest") < place)
    by_head = late.groupBy("gram", "union").agg(F.collect_list("j").alias("late"))
    heads = stored(unions.select("gram", "union", "head").join(by_head, ["gram", "union"], "left"), "heads")

    judged = anchors.join(heads.hint("merge"), ["gram", "union"])
    first = F.struct("doc_id", "first") <= F.struct("head.doc_id", "head.first")
    whole = F.array(F.struct(F.col("first").alias("start"), (F.col("first") + F.col("n") - 1 + window).alias("end")))
    single = F.transform(
        "late", lambda j: F.struct((F.col("first") + j).alias("start"), (F.col("first") + j + window).alias("end"))
    )
    spans = judged.select("doc_id", "_twin", F.explode(F.when(first, single).otherwise(whole)).alias("span"))
    return spans.select("doc_id", "_twin", "span.start", "span.end")


def dedup_substrings(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of `window` words covers it whose words also start earlier: in a smaller doc_id (null is the
    smallest), or in the same document before it. Rows that repeat both doc_id and text are one place: neither is
    earlier. Texts are judged as they come in, null counts as empty, and texts shorter than a window stay whole. Any
    length is read whole, in overlapping segments. No documents, no rows.
    """

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), lists_of(batch.column(2))):
                words = (text or b"").split()
                n_words.append(len(words))
                if len(spans["start"]):
                    gone = covered(spans, len(words))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    rows = with_spans(docs, late_spans(docs, window))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
