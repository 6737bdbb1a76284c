"""A toxicity classifier that is indifferent to which group a sentence names.

Logistic regression on the presence of words and word beginnings. Labelled sentences that name a group are repeated with
every other group of the same sort in its place, and the squared change of the score's logit is a penalty of the fit, so
weight moves off the names themselves and neutral mentions are not flagged.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import identified, stored

# Groups whose names may stand for one another in a sentence; English, German, French, Spanish.
IDENTITY_TERMS = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("frauen", "männer"),
    ("schwule", "lesben", "heterosexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("femmes", "hommes"),
    ("immigrés", "réfugiés", "étrangers", "habitants"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
    ("mujeres", "hombres"),
    ("inmigrantes", "refugiados", "extranjeros", "vecinos"),
)
# Labelled rows the fit uses at most, the smallest by the hashes of doc_id and text, and features it keeps at most.
SAMPLE_ROWS = 20_000
MOST_FEATURES = 4_000
LEAST_ROWS = 3
# Standard errors by which a feature's log odds must differ from none: of ten thousands of candidates, chance alone would bring
# hundreds beyond two.
LEAST_Z = 3.0
PREFIXES = (4, 5)
THRESHOLD = 0.3
RIDGE = 1e-4
FAIRNESS = 1.0
ROUNDS = 400
# Share of toxic rows that is assumed before any label is seen, with the weight of one row.
PRIOR = 0.05

WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """The distinct words, and the first four and five letters (with a mark) of longer ones."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


def counterfactuals(text: str | None, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[str]:
    """The text with the names of each sort of group replaced by each other name of that sort."""
    lowered = (text or "").lower()
    spoken = set(WORD.findall(lowered))
    swapped = []
    for sort in terms:
        named = [t for t in sort if t in spoken]
        if named:
            pattern = re.compile(rf"\b(?:{'|'.join(map(re.escape, named))})\b")
            swapped += [pattern.sub(other, lowered) for other in sort if [other] != named]
    return swapped


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        total = self.bias + sum(self.weights[f] for f in sorted(features(text) & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, text) of at most `rows` labelled documents for which `usable` (of doc_id) holds. A doc_id that is labelled
    twice counts as toxic if either label says so; labels without a value or a document teach nothing. A doc_id that
    repeats teaches each of its texts once; only hashes of the texts are shuffled and sorted."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & usable)
    by_id = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    texts = identified(docs.where(F.col("doc_id").isNotNull())).distinct().join(by_id, F.col("doc_id") == F.col("_id"))
    best = texts.orderBy(F.xxhash64("_id"), "_id", "_twin").limit(rows)
    chosen = stored(best.select("_id", "_toxic", F.col("_twin").alias("_text_hash")), "labelled")
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_text_hash"))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), same)
    return found.groupBy("_id", "_text_hash").agg(F.first("_toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text")


def chosen_features(sample: DataFrame, most: int = MOST_FEATURES) -> list[str]:
    """The features whose share differs most surely between toxic and other rows: log odds over their standard error."""

    def run(batches):
        for batch in batches:
            found = [(y, f) for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for f in features(t)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in found], pa.int32()), pa.array([f for _, f in found], pa.string())], ["toxic", "feature"])

    exploded = sample.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, "toxic int, feature string")
    bad, all_rows = F.sum("toxic"), F.count(F.lit(1))
    counts = exploded.groupBy("feature").agg(bad.alias("bad"), (all_rows - bad).alias("good")).where(F.col("bad") + F.col("good") >= LEAST_ROWS)
    totals = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("n_bad"), F.count(F.lit(1)).alias("n")).first()
    n_bad, n_good = totals["n_bad"], totals["n"] - totals["n_bad"]
    odds = F.log((F.col("bad") + 0.5) / (F.lit(n_bad + 0.5) - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (F.lit(n_good + 0.5) - F.col("good") + 0.5))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = counts.withColumn("z", F.round(F.abs(odds / error), 6)).where(F.col("z") > LEAST_Z).orderBy(F.desc("z"), "feature").limit(most)
    return [r["feature"] for r in best.select("feature").collect()]


def sparse_rows(sample: DataFrame, names: Sequence[str], terms: Sequence[Sequence[str]]) -> tuple[np.ndarray, list, list]:
    """Labels, present features per row, and (row, features lost, features won) per swapped sentence."""
    known = {f: i for i, f in enumerate(names)}

    def run(batches):
        for batch in batches:
            ids, lost, won = [], [], []
            for text in batch.column(1).to_pylist():
                own = features(text) & known.keys()
                others = [features(t) & known.keys() for t in counterfactuals(text, terms)]
                ids.append(sorted(known[f] for f in own))
                lost.append([sorted(known[f] for f in own - o) for o in others if o != own])
                won.append([sorted(known[f] for f in o - own) for o in others if o != own])
            lists = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(lost, lists), pa.array(won, lists)], ["toxic", "ids", "lost", "won"]
            )

    schema = "toxic int, ids array<int>, lost array<array<int>>, won array<array<int>>"
    rows = sample.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, schema).collect()
    rows.sort(key=lambda r: (r["toxic"], r["ids"], r["lost"], r["won"]))
    swaps = [(lost, won) for r in rows for lost, won in zip(r["lost"], r["won"])]
    return np.array([r["toxic"] for r in rows], float), [r["ids"] for r in rows], swaps


def fit(labels: np.ndarray, rows: list, swaps: list, n: int, fairness: float = FAIRNESS) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps with adaptive rates on log loss + ridge + fairness x squared logit changes."""
    prior = (labels.sum() + PRIOR) / (len(labels) + 1)
    bias = float(np.log(prior / (1 - prior)))
    weights = np.zeros(n)
    if not n or not len(labels):
        return weights, bias
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((i for r in rows for i in r), np.int64, len(row))
    swap_row = np.array([k for k, (lost, won) in enumerate(swaps) for _ in range(len(lost) + len(won))], np.int64)
    swap_column = np.array([i for lost, won in swaps for i in (*lost, *won)], np.int64)
    sign = np.array([s for lost, won in swaps for s in (*[-1.0] * len(lost), *[1.0] * len(won))])
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, ROUNDS + 1):
        logits = bias + np.bincount(row, weights[column], len(rows))
        error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels) / len(labels)
        gradient = np.bincount(column, error[row], n) + RIDGE * weights
        if swaps:
            change = np.bincount(swap_row, sign * weights[swap_column], len(swaps))
            gradient += 2 * fairness * np.bincount(swap_column, sign * change[swap_row], n) / len(swaps)
        step = np.append(gradient, error.sum())
        mean, square = 0.9 * mean + 0.1 * step, 0.999 * square + 0.001 * step**2
        move = 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
        weights, bias = weights - move[:-1], float(bias - move[-1])
    return weights, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    fairness: float = FAIRNESS,
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on a bounded sample of labelled rows. Without any label every score is that of the prior."""
    sample = stored(training_rows(docs, labels, usable, rows).select("toxic", "text"), "training-texts")
    names = chosen_features(sample)
    toxic, present, swaps = sparse_rows(sample, names, terms)
    weights, bias = fit(toxic, present, swaps, len(names), fairness)
    return Model({f: float(w) for f, w in zip(names, weights) if w}, bias)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of docs: doc_id, score. Null and empty texts get the score of no evidence; whole texts of any length are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        judge = shared.value
        for batch in batches:
            scores = pa.array([judge.score(t) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns; rows keep to themselves, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        judge = shared.value
        for batch in batches:
            yield batch.filter(pa.array([judge.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
