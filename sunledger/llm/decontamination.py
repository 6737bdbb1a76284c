"""Benchmark decontamination by a prefix-filtered join of word windows. Column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import BROADCAST_ROWS, ascii_lower, fresh_name, identified, same_rows, stored

# What lies between words: all of ASCII but digits and small letters, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Letters that `lower` changes and ASCII lower-casing does not.
OTHER_CAPITALS = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"
WINDOW_WORDS = 13
# A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
KEYS = ["doc_id", "_twin"]


def words_of(text: Column) -> Column:
    """Cutting between words costs a quarter of extracting them; so does `lower` where it agrees with `ascii_lower`."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(text.rlike(OTHER_CAPITALS), ascii_lower(text)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast where a count shows the table to be small; otherwise the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(item_id as a string, words) of every window; an item of fewer words, but not none, is one."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))


def rarest_tokens(windows: DataFrame, docs: DataFrame, most_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Per distinct window (text): token, offset, len. The token is the window's rarest word in the documents.

    Windows must be contained whole, so the necessary prefix of a window, in the order of rarity, is one word; a window
    with a word that no document has is left out. Counts cover every word of every document.
    """
    tokens = windows.select("window", F.posexplode("words").alias("offset", "token"), F.size("words").alias("len"))
    wanted = bounded(stored(tokens.select("token").distinct(), "benchmark-words"), most_broadcast)
    # Outer: an inner explode makes the optimizer add a filter that cuts every text into words once more.
    spoken = docs.select(F.explode_outer(words_of(F.col("text"))).alias("token"))
    counts = stored(spoken.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    ranked = tokens.join(counts, "token", "left")
    choice = F.min(F.struct("n", "token", "offset")).alias("c")
    chosen = ranked.groupBy("window", "len").agg(choice, F.count("n").alias("known")).where("known = len")
    return chosen.select("window", "len", F.col("c.token").alias("token"), F.col("c.offset").alias("offset"))


def found_windows(docs: DataFrame, prefixes: DataFrame, window: int, most_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of docs one marker row (`start` null), and one row for every window that starts at a word of it: doc_id,
    _twin, n (words), window, start, len.

    Every word looks up the windows whose rarest word it is; of those that lie within the document (positional and
    length bounds) the words around it are compared. The words of a text stay beside its exploded rows inside one
    generated function, so nothing but markers and verified windows leaves the task. Prefixes that are too many for a
    broadcast meet only the words that are somebody's prefix, each with the few words around it.
    """
    rows = identified(docs, words_of(F.col("text")).alias("words"))
    # The null at the end is the marker: it joins nothing.
    spoken = rows.select(
        *KEYS, F.size("words").alias("n"), "words", F.posexplode_outer(F.concat("words", F.array(F.lit(None).cast("string")))).alias("at", "token")
    )
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n"))
    result = [*KEYS, "n", "window", F.when(F.col("window").isNotNull(), start).alias("start"), "len"]
    if prefixes.count() <= most_broadcast:
        met = spoken.join(F.broadcast(prefixes), "token", "left")
        same = F.array_join(F.slice("words", start + 1, F.col("len")), " ") == F.col("window")
        return met.where(F.col("token").isNull() | (F.when(inside, same).otherwise(F.lit(False)))).select(*result)
    tokens = stored(prefixes.select("token", F.lit(True).alias("_is_prefix")).distinct(), "prefix-words")
    first = F.greatest(F.col("at") - (window - 1), F.lit(0))
    around = F.slice("words", first + 1, 2 * window - 1)
    near = spoken.join(bounded(tokens, most_broadcast), "token", "left").where(F.col("token").isNull() | F.col("_is_prefix"))
    near = stored(near.select(*KEYS, "n", "at", "token", F.when(F.col("token").isNotNull(), around).alias("around")), "prefix-places")
    met = near.join(prefixes.hint("merge"), "token").where(inside)
    same = F.array_join(F.slice("around", start - first + 1, F.col("len")), " ") == F.col("window")
    markers = near.where("token IS NULL").select(*KEYS, "n", F.lit(None).cast("string").alias("window"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("len"))
    return markers.unionByName(met.where(same).select(*result))


def judged_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, most_broadcast: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Per (doc_id, _twin): copies (rows of docs), n_words, n_hit, spans (verified windows: window, start, len); and
    (window, item_id)."""
    windows = stored(
        item_windows(benchmark, window).select("item_id", "words", F.array_join("words", " ").alias("window")).distinct(), "item-windows"
    )
    prefixes = stored(rarest_tokens(windows.select("window", "words").distinct(), docs, most_broadcast), "window-prefixes")
    found = found_windows(docs, prefixes, window, most_broadcast)
    hit = F.when(F.col("start").isNotNull(), F.struct("window", "start", "len"))
    rows = found.groupBy(*KEYS).agg(
        F.count_if(F.col("start").isNull()).alias("copies"), F.max("n").cast("long").alias("n_words"), F.collect_set(hit).alias("spans")
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    judged = rows.select(*KEYS, "copies", "n_words", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), "spans")
    return stored(judged, "hit-windows"), windows.select("window", "item_id").distinct()


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (ONE_IN * n_hit >= n_words)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, most_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Per row of docs: doc_id, _twin, n_words, n_hit, items (ids as strings, sorted), contaminated, spans.

    A document's word is hit if it lies in an occurrence of an item's window. Null and wordless texts have no words and
    no hits; items without words have no windows; a null item_id counts as the empty string and repeated items as one.
    An empty benchmark finds nothing, and no documents give no rows. Repeated rows come back as often as they are there.
    A table of more than `most_broadcast` rows is never broadcast; the rows are the same.
    """
    judged, items = judged_documents(docs, benchmark, window, most_broadcast)
    hits = judged.where("n_hit > 0").select(*KEYS, F.explode(F.array_distinct(F.transform("spans", lambda s: s["window"]))).alias("window"))
    found = hits.distinct().join(bounded(items, most_broadcast), "window").groupBy(*KEYS).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    rows = same_rows(judged, found, KEYS, "left")
    rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return rows.select(
        *KEYS,
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The clean documents, with all their columns."""
    twin = fresh_name(docs, "_twin")
    judged, _ = judged_documents(docs, benchmark, window)
    bad = judged.where(contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id", F.col("_twin").alias(twin)).distinct()
    named = docs.withColumn(twin, F.xxhash64(F.coalesce("text", F.lit(""))))
    return same_rows(named, bounded(stored(bad, "contaminated")), ["doc_id", twin], "left_anti").select(*docs.columns)
