"""The filter audit against plain Python."""

from __future__ import annotations

import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sunledger.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text: str) -> fa.Counts:
    words = WORD.findall(text)
    return fa.Counts(len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


@given(st.text(alphabet=st.sampled_from("aAéß€\U0001f600 \t\n\x0b\x0c\r\x1c\x85 #|Zz"), max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_one_pass_counts_whatever_the_segment(text, segment):
    whole = fa.SEGMENT
    try:
        fa.SEGMENT = segment
        assert fa.measure(text.encode()) == brute_counts(text)
    finally:
        fa.SEGMENT = whole
    assert fa.measure(text.encode()) == brute_counts(text)


def test_very_long_text():
    text = "né A$ " * 700_000 + "x" * 1_500_000
    assert fa.measure(text.encode()) == brute_counts(text)


LONG = " ".join(f"w{i}" for i in range(200))
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, LONG, "en"), (4, LONG, "de"), (4, LONG, "de"), (None, LONG, None), (5, LONG + " x", None), (6, "a " * 300, "fr"),
    (7, LONG + " #", "en"), (8, LONG.upper(), "en"), (9, "A B # A", ""), (10, LONG + " x", "en"), (11, "short", "en"), (11, "other", "en"),
]
LABELS = [(1, 1, 0), (4, 1, 1), (4, 0, None), (6, 0, 1), (6, None, 0), (9, 1, 1), (11, 1, None), (None, 1, 1), (99, 1, 1)]


def brute_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    judged = []
    for i, t, lang in rows:
        c = brute_counts(t or "")
        tests = (c.words < 200, 100 * c.distinct < 50 * c.words, 100 * c.capitals > 3 * c.points, c.symbols > 0, i is not None and i > first[t or ""])
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        judged.append((lang or "", {x for x, y in zip("ABCDE", tests) if y}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    result = {}
    for part in {j[0] for j in judged}:
        some = [j for j in judged if j[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for step, own in enumerate(order):
                before = set(order[:step])
                here = [j for j in some if own in j[1] and not j[1] & before]
                kept = sum(not j[1] & (before | {own}) for j in some)
                redundant = sum(own in j[1] and bool(j[1] & before) for j in some)
                total[own] += len(here)
                key = (part, "".join(order), step + 1)
                result[key] = [kept, len(here), redundant, sum(j[1] == {own} for j in some), sum(j[2] for j in here), sum(j[3] for j in here), own]
        for (p, _, _), v in result.items():
            if p == part:
                v[6] = total[v[6]]
    return {k: tuple(v) for k, v in result.items()}


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(i, t, g, "clash", True, "x") for i, t, g in ROWS]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, digest STRING, good BOOLEAN, failed STRING")
    labels = spark.createDataFrame([(*x, "clash") for x in LABELS], "doc_id LONG, quality INT, toxic INT, part STRING")
    return docs, labels


def test_audit(frames):
    docs, labels = frames
    found = fa.audit_filters(docs.repartition(5), labels.repartition(3)).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(found) == 600 * len({g or "" for _, _, g in ROWS}) and got == brute_audit(ROWS, LABELS)
    assert got["en", "ABCDE", 5][0] == sum(r[0] == "en" and not r[1] for r in [(g, f) for g, f in parts(docs)])


def parts(docs):
    return [(r.part, r.failed) for r in fa.failed_filters(docs).collect()]


def test_audit_without_labels_documents_or_some_filters(frames):
    docs, labels = frames
    assert fa.audit_filters(docs.where("1 = 0"), labels).count() == 0
    bare = fa.audit_filters(docs, labels.where("1 = 0")).agg({"good_lost": "sum", "toxic_lost": "sum", "removed": "sum"}).first()
    assert bare["sum(good_lost)"] == bare["sum(toxic_lost)"] == 0 < bare["sum(removed)"]
    two = fa.audit_filters(docs, labels, {"S": "n_words < 3", "U": "n_capitals > 0"}).collect()
    assert {(r.filter_order, r.step) for r in two} == {("SU", 1), ("SU", 2), ("US", 1), ("US", 2)}


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("b", "same", "en"), ("a", "same", "en")], "doc_id STRING, text STRING, lang STRING")
    assert {r.doc_id: r.failed for r in fa.failed_filters(docs).collect()} == {"a": "A", "b": "AE"}
