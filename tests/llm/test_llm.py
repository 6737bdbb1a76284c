"""The operators against brute force, on small inputs with nulls, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import random
import re

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sunledger.llm import (
    chat,
    decontamination,
    exact_dedup,
    mixing,
    pii,
    repeats,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _twin STRING, heads LONG, n LONG"


def corpus() -> list[tuple[int | None, str | None]]:
    """Null and blank texts, copies, near copies, shared passages, one text that repeats itself, repeated rows, no id."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, long = text(60), text(900)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, text(19)), (7, text(20))]
    rows += [(i, f"{text(rng.randint(0, 30))} {passage} {text(rng.randint(0, 30))}") for i in range(10, 22)]
    rows += [(i, long) for i in (30, 31, 32)] + [(33, long.replace(" ", "\n", 1)), (34, f"{long} {word()}"), (35, long[:-4])]
    near = long.split()
    rows += [(40 + i, " ".join([*near[: 100 * i], word(), *near[100 * i + 1 :]])) for i in range(8)]
    rows += [(60, f"{passage} {text(5)} {passage} {text(3)} {passage}"), (61, "x y " * 300), (62, "é" * 700)]
    rows += [(70, passage), (70, passage), (71, text(50)), (71, text(50)), (None, passage), (None, text(30))]
    return rows


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 4 else None, 0, "clash", 7, 8) for k, (i, t) in enumerate(rows)], schema)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shown(values):
    return sorted(map(repr, values))


# ---- 1
def test_mixing_reaches_targets_whatever_the_block(docs, rows):
    total = sum(len(brute.SPACE.findall(t or "")) for _, t in rows)
    answers = []
    for block in (1, 7, 64, 10**6):
        got = mixing.words_taken(mixing.mix_sources(docs, block_words=block)).collect()
        assert len(got) == len(rows)
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        by_source = {}
        for r in got:
            by_source.setdefault((r.source_size, r.target), []).append(r.taken)
        assert all(sum(v) == int(t) for (_, t), v in by_source.items())
        assert sum(t for _, t in by_source) == pytest.approx(1.5 * total)
        answers.append(shown((r.doc_id, r["size"], r.taken) for r in got))
    assert all(a == answers[0] for a in answers)


def test_schedule_holds_weights_in_every_stretch(spark):
    targets = spark.createDataFrame([("a", 1, 500, 800.0), ("b", 2, 300, 150.0), ("c", 3, 100, 50.0)], "source STRING, no INT, source_size LONG, target DOUBLE")
    schedule, block = mixing.slot_schedule(targets, 1000.0, 1)
    slots = [r.no for r in schedule.orderBy("slot").collect()]
    assert block == 1 and len(slots) == 1000
    for start in range(0, 950, 50):
        assert abs(slots[start : start + 50].count(1) - 40) <= 3


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [(7, f"other {i}") for i in range(300)]
    assert mixing.sized_documents(frame(spark, rows)).select("order").distinct().count() == 600


def test_mixing_of_nothing(nothing):
    assert mixing.mix_sources(nothing).count() == 0


# ---- 2
def test_suffix_dedup(docs, rows, nothing):
    found = suffix_dedup.dedup_suffixes(docs).select("doc_id", "n_bytes", "spans", "kept").collect()
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), brute.sha(bytes(r.kept))) for r in found]
    want = [(i, *x) for (i, _), x in zip(rows, brute.removed_bytes([t for _, t in rows], 200))]
    assert shown(got) == shown(want) and sum(w[2] for w in want) > 10_000
    assert suffix_dedup.dedup_suffixes(nothing).count() == 0


def test_suffix_dedup_counts_windows_of_crowded_grams(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_KINDS", 2)
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_PER_RANGE", 5)
    found = suffix_dedup.dedup_suffixes(docs, 40, 16).collect()
    want = brute.removed_bytes([t for _, t in rows], 40)
    assert shown((r.doc_id, brute.sha(bytes(r.kept))) for r in found) == shown((i, x[3]) for (i, _), x in zip(rows, want))


@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: b.replace(b"\xff", b"a")), max_size=12), max_size=6))
@settings(max_examples=150, deadline=None)
def test_loser_tree_merges_and_knows_prefixes(runs):
    packed = [suffix_dedup.pack_run([suffix_dedup.Suffix(k, b"l", 1, 2, 3) for k in sorted(r)]) for r in runs]
    merged = [(s.key, shared) for s, shared in suffix_dedup.LoserTree(suffix_dedup.read_run(p) for p in packed)]
    assert [k for k, _ in merged] == sorted(k for r in runs for k in r)
    assert all(n == suffix_dedup.common_prefix(a, b) for (a, _), (b, n) in zip(merged, merged[1:]))


@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", min_size=1, max_size=9), st.integers(1, 3)), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_prefix_lengths_decide_what_repeats(parts):
    window, gram = 8, b"G" * 3
    group = {(left, right): count for left, right, count in parts if len(left) + len(gram) + len(right) >= window}
    suffixes = [suffix_dedup.Suffix(b"8 bytes " + gram + right.encode(), left.encode(), 1, k, c) for k, ((left, right), c) in enumerate(group.items())]
    # As in the operator, a stretch ends where its last window would lose the gram.
    suffixes = sorted((s for s in suffixes if len(s.key) - 8 <= window), key=lambda s: s.key)
    if not suffixes:
        return
    shared = [0, *(suffix_dedup.common_prefix(a.key, b.key) for a, b in zip(suffixes, suffixes[1:]))]
    times = {}
    windows = [[(j - len(s.left), (s.left + s.key[8:])[j : j + window]) for j in range(len(s.left) + len(s.key) - 8 - window + 1)] for s in suffixes]
    for s, found in zip(suffixes, windows):
        for w in found:
            times[w] = times.get(w, 0) + s.count
    got = {s.union: {j for a, b in late for j in range(a, b + 1)} for s, late in suffix_dedup.repeated_windows(suffixes, shared, window)}
    want = {s.union: {j for j, w in enumerate(found) if times[w] > 1} for s, found in zip(suffixes, windows)}
    assert got == {u: js for u, js in want.items() if js}


# ---- 3
def test_exact_dedup(spark, docs, rows, nothing, tmp_path):
    got = exact_dedup.open_index(spark).add(docs).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(brute.sha(t or ""), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        same = texts[bytes(r.digest).hex()]
        assert r.group_size == len(same) and r.keep_id == max((i for i in same if i is not None), default=None)
    assert sum(r.kept for r in got) == len(texts)
    assert exact_dedup.open_index(spark).add(nothing).count() == 0
    assert len(exact_dedup.dedup_exact(docs, exact_dedup.open_index(spark)).collect()) == len(texts)


def test_digest_index_persists_between_batches(spark, tmp_path):
    place = str(tmp_path / "index")
    first = frame(spark, [(1, "a"), (2, "a"), (3, "b")])
    exact_dedup.DigestIndex(spark, place, 4).add(first)
    again = exact_dedup.DigestIndex(spark, place, 4)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.add(frame(spark, [(8, "b"), (9, "c"), (7, "a")])).collect()}
    assert got == {8: (3, 1, False), 9: (9, 1, True), 7: (2, 1, False)}
    assert again.entries().count() == 3
    plan = first.select(exact_dedup.text_digest().alias("digest")).join(again.entries().hint("merge"), "digest", "left_anti")
    assert "SortMergeJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_digest_index_keeps_its_buckets(spark, tmp_path, monkeypatch):
    """Another number of buckets is refused, none asks for the stored one; appends and crowding make buckets anew."""
    place = str(tmp_path / "index")
    texts = frame(spark, [(i, f"t{i}") for i in range(200)])
    index = exact_dedup.DigestIndex(spark, place, 8)
    assert index.add(texts).where("kept").count() == 200
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        exact_dedup.DigestIndex(spark, place, 16)
    again = exact_dedup.DigestIndex(spark, place)
    assert again.add(texts).where("kept").count() == 0 and again.about["buckets"] == 8
    again.compact(16)
    opened = exact_dedup.DigestIndex(spark, place, 16)
    assert opened.add(texts).where("kept").count() == 0 and opened.entries().count() == 200
    monkeypatch.setattr(exact_dedup, "MOST_APPENDS", 2)
    for n in range(3):
        assert opened.add(frame(spark, [(n, f"new {n}"), (n, "t5")])).where("kept").count() == 1
    assert opened.about["version"] == 4 and opened.entries().count() == 203
    monkeypatch.setattr(exact_dedup, "ROWS_PER_BUCKET", 2)
    assert opened.add(texts).where("kept").count() == 0 and opened.about["buckets"] == 102
    for i in (index, again, opened):
        i.close()
    assert not [t for t in spark.catalog.listTables() if t.name in (index.name, again.name, opened.name)]
    fresh = exact_dedup.DigestIndex(spark, str(tmp_path / "none"))
    assert fresh.entries().count() == 0 and fresh.add(texts.where("1 = 0")).count() == 0


# ---- 4
def test_simhash_components(spark, docs, rows, nothing):
    named = [(i, t) for i, t in dict(rows).items() if i is not None]
    got = simhash.near_duplicates(frame(spark, named)).collect()
    want = brute.near_components(named)
    assert {r.doc_id: (f"{r.fingerprint & (2**64 - 1):016x}", r.component_id) for r in got} == want
    assert len(simhash.near_duplicates(docs).collect()) == len(rows)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.dedup_near(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 31 OR doc_id = 2").count() == 0


def test_near_dedup_keeps_one_of_each_component(spark):
    """Ids that repeat with other texts, rows that repeat, and rows without an id."""
    one, two, three = ("a b c d e", "quite another text", "no id at all here")
    rows = [(5, one), (5, two), (5, two), (8, two), (9, three), (None, three), (None, None), (None, ""), (None, "left alone")]
    kept = [(r.doc_id, r.text or "") for r in simhash.dedup_near(frame(spark, rows)).collect()]
    assert shown(kept) == shown([(5, one), (5, two), (9, three), (None, ""), (None, "left alone")])


@pytest.mark.parametrize("bucket", [0, 3, 64])
def test_links_connect_all_close_fingerprints(spark, bucket):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:20]:
        for _ in range(6):
            v ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint LONG")
    roots = {r.node: r.root for r in simhash.components(simhash.links(prints, bucket_rows=bucket)).collect()}
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: roots.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_thresholds_are_the_cheapest_that_suffice():
    costs = [[5.0, 50.0, 500.0], [1.0, 2.0, 300.0], [9.0, 90.0, 900.0]]
    best, chosen = simhash.allocate(costs, 0)
    assert sum(chosen) == 0 and best == 7.0 and chosen == [0, 1, -1]


# ---- 5
@given(st.text(alphabet="<>/\\[]sINTSY\n ok", max_size=40), st.text(alphabet="user\\n\n<s>/", max_size=8))
@settings(max_examples=400, deadline=None)
def test_rendered_turns_read_back(text, role):
    piece, start, end = chat.render(role, text)
    assert list(chat.parse(piece + chat.render("assistant", text)[0])) == [(role, text), ("assistant", text)]
    assert chat.unescape(piece[start:end]) == (text if role == "assistant" else "")
    assert not any(c in chat.escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, 1, "start", "user", None), (1, 0, 2, "delta", None, "he"), (1, 0, 3, "delta", None, "llo"),
        (1, 1, 4, "start", "assistant", None), (1, 1, 5, "delta", None, "bad"), (1, 2, 6, "message", "user", "why"),
        (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "good"),
        (2, 0, 1, "message", "user", "a"), (2, 1, 2, "message", "assistant", "b"), (2, 0, 3, "edit", None, "A"),
        (2, 1, 4, "message", "assistant", "B"), (3, 0, 1, "noise", "user", "x"), (None, 0, 1, "message", None, None),
    ]
    frame_ = spark.createDataFrame(log, "conv_id LONG, turn LONG, seq LONG, kind STRING, role STRING, text STRING")
    got = {}
    for r in chat.format_conversations(frame_.repartition(3)).orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).extend(chat.parse(r.piece))
    assert got == {1: [("user", "hello"), ("assistant", "good")], 2: [("user", "A"), ("assistant", "B")], None: [("", "")]}
    assert chat.format_conversations(frame_.where("1 = 0")).count() == 0


def test_conversations_as_a_log_read_back(spark):
    """Null and empty texts, texts beyond one delta, repeated rows, tied turns, no conv_id, clashing columns, no rows."""
    talks = [
        (1, 0, "user", "é\n" * 7), (1, 1, "assistant", "</s>[INST] ok"), (1, 1, "assistant", "</s>[INST] ok"), (1, 1, "assistant", None),
        (2, 0, "assistant", ""), (2, 0, "user", "b"), (None, 0, "user", "x" * 11), (3, None, "assistant", "late"), (3, 0, "user", None),
    ]
    schema = "conv_id LONG, turn LONG, role STRING, text STRING, seq LONG, kind STRING, part STRING"
    table = spark.createDataFrame([(*t, 5, "noise", "clash") for t in talks], schema)
    got = chat.conversation_digests(chat.format_conversations(chat.as_log(table.repartition(3), delta_chars=4))).collect()
    want = {}
    for conv, turn, role, text in sorted(talks, key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3] or "")):
        want.setdefault(conv, []).append((role, text or ""))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert len(got) == len(want) == 4
    for r in got:
        turns = want[r.conv_id]
        said = "".join(text for role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(said), sha(said))
        assert r.formatted_chars == sum(len(chat.render(*t)[0]) for t in turns)
    assert chat.conversation_digests(chat.format_conversations(chat.as_log(table.where("1 = 0")))).count() == 0


# ---- 6
def test_contamination(spark, docs, rows, nothing):
    words = (dict(rows)[70]).split()
    items = [(1, " ".join(words[5:40])), (2, "ONE"), (3, None), (None, " ".join(words[20:33])), (3, "nowhere to be found"), (3, "one")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id LONG, text STRING, n STRING")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontamination.find_contamination(docs, bench).collect()]
    want = [(i, *x) for (i, _), x in zip(rows, brute.contamination([t for _, t in rows], items))]
    assert shown(got) == shown(want) and sum(w[4] for w in want) > 5
    # Beyond the bound of a broadcast the joins shuffle, and the words around a prefix travel along.
    wide = decontamination.find_contamination(docs, bench, most_broadcast=0)
    assert shown((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in wide.collect()) == shown(want)
    clean = decontamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[4] for w in want)
    assert decontamination.drop_contaminated(docs, bench.where("1 = 0")).count() == len(rows)
    assert decontamination.find_contamination(nothing, bench).count() == 0


# ---- 7
PERSONAL = [
    None, "", "mail a.b@c.de, x@y x@y.z@w.vu a@b.com_x@y.zz", "1.2.3.4.5.6.7.8 999.1.1.1 010.000.255.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 12",
    "call +41 (44) 123.45.67 or +1 2 +12345678901234567890", "\U0001f600é +49 30 1234567 é a@b.c", "iban GB82 WEST 1234 5698 7654 32 no GB83 WEST 1234 5698 7654 32",
    "ssn: 123-45-6789", "number 123-45-6789", "a" * 60_000 + "@", "1" * 60_000, "1 " * 40_000, "+1" + " " * 50_000, "a@b" + ".c" * 30_000, "x@y.z " * 3000,
]


def test_personal_data(spark, docs, nothing):
    frame_ = frame(spark, list(enumerate(PERSONAL)))
    got = {r.doc_id: r.spans for r in pii.find_personal_data(frame_).collect()}
    base = [k.name for k in pii.BASE_KINDS]
    for i, text in enumerate(PERSONAL):
        counts, digest = brute.personal(text)
        mine = [s for s in got[i] if s.kind in base]
        assert [sum(s.kind == k for s in mine) for k in base] == counts, text and text[:60]
        assert brute.sha(",".join(f"{s.kind}:{s.start}:{s.end}" for s in mine)) == digest
    extra = {i: [s.kind for s in spans if s.kind not in base] for i, spans in got.items()}
    assert [k for v in extra.values() for k in v] == ["iban", "ssn"] and extra[7] == ["iban"] and extra[8] == ["ssn"]
    assert pii.find_personal_data(nothing).count() == 0


DE, GB = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
IBANS = [
    (f"{DE} Please pay", [DE]), (f"{GB} BIC ABCDEF", [GB]), (f"{DE} 12 EUR", [DE]), (f"AB12 {DE}", [DE]), (f"MD12 {DE} {GB}.", [DE, GB]),
    (f"\U0001f600 é{DE}{GB}", [DE, GB]), (f"IBAN{DE.replace(' ', '')}EUR 7", [DE.replace(" ", "")]), ("NO93 8601 1117 947 X1", ["NO93 8601 1117 947"]),
    ("MT84 MALT 0110 0001 2345 MTLC AST0 01S A", ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"]), (f"{DE[:-1]}1 Please", []), (DE[:-1], []), (f"{DE} " * 300, [DE] * 300),
    ("DE12" * 20_000, None),
]


def test_ibans_beside_capitals_digits_and_codes(spark):
    kind = [k for k in pii.KINDS if k.name == "iban"]
    docs = frame(spark, [(i, text) for i, (text, _) in enumerate(IBANS)])
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs, kind).collect()}
    for i, (text, want) in enumerate(IBANS):
        if want is not None:
            assert [text[s.start : s.end] for s in got[i]] == want, text[:60]
    codes = [c for v in pii.IBAN_LENGTHS.values() for c in v.split()]
    assert len(codes) == len(set(codes))


def test_context_reaches_past_neighbouring_matches(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 50)
    many = ", ".join(["123-45-6789"] * 120)
    texts = [
        "SSNs: 123-45-6789, 987-65-4321", "123-45-6789, 987-65-4321 ssn", f"ssn {many}", f"{many} ssn", f"{many}, the ssn {many}", "\U0001f600 ssn é 123-45-6789 987-65-4321",
        f"ssn{' ' * 37}123-45-6789", f"ssn{' ' * 38}123-45-6789", f"123-45-6789{' ' * 37}ssn", f"123-45-6789{' ' * 38}ssn", "social security 1 123-45-6789;987-65-4321;111-22-3333", many,
        " ".join(["123-45-6789 a@b.c"] * 60) + " SSN",
    ]
    kind = {k.name: k for k in pii.KINDS}
    docs = frame(spark, list(enumerate(texts)))
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs, [kind["ssn"], kind["email"]]).collect()}
    for i, text in enumerate(texts):
        hits = [m.span() for m in re.finditer(kind["ssn"].pattern, text)]
        want = [(a, b) for a, b in hits if re.search(kind["ssn"].context, f"{text[max(0, a - 40) : a]} {text[b : b + 40]}".lower())]
        assert [(s.start, s.end) for s in got[i] if s.kind == "ssn"] == want, text[:60]
    assert [len(got[i]) for i in (0, 1, 6, 7, 8, 9, 10, 11)] == [2, 2, 1, 0, 1, 0, 2, 0]


# ---- 8
def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://a.net", "http://a.net/", "HTTP://A.Example.NET/en/x?y", "http://example.net/english/", "x://example.com/de/1#z",
        "x://notexample.com/de/", "x://b.org/fr/", "x://b.org?/fr/", "x://y.com/top/casino/1", "x://y.com/casinos", "x://net/a", "x://a.net/p://b.org/fr/",
    ]
    pages = spark.createDataFrame([(i, u, "<h>", "r") for i, u in enumerate(urls)], "page_id LONG, url STRING, html STRING, rule STRING")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.net", "", None, "allow") and got[4][2:] == ("net/", "block") and got[5] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[6][2] == "net/" and got[7][2:] == ("example.com/de/", "block") and got[8][2:] == (None, "allow") and got[9][2:] == ("org/fr/", "allow")
    assert got[10][:3] == ("b.org", "", None) and got[11][2:] == (None, "block") and got[12][3] == "allow" and got[13][2] == "net/" and got[14][2] == "net/"
    assert url_filter.judge_urls(pages.where("1 = 0")).count() == 0


def test_words_in_either_case_and_site_rules_as_they_are(spark):
    urls = ["x://y.com/Casino/x", "x://y.com/casino/x", "x://y.com/a-XXX", "x://Y.COM/CASINOS", "x://example.com/DE/", "x://example.com/de/XXX", "x://caſino.y/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id LONG, url STRING")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert [got[i][1] for i in range(7)] == ["block", "block", "block", "allow", "allow", "block", "allow"] and got[5][0] == "example.com/de/"


def test_rules_are_indexed_by_their_rarest_token():
    index = url_filter.RuleIndex(url_filter.SITE_RULES, {"example": 100, "net": 50, "en": 5, "com": 70, "de": 60, "org": 3, "fr": 9})
    assert {t: [index.rules[i].name for i in v] for t, v in index.by_token.items()} == {
        "net": ["net/"], "en": ["example.net/en/"], "de": ["example.com/de/"], "org": ["org/fr/"]
    }


# ---- 9
def labelled(spark):
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed".split()) for _ in range(12))
    texts = []
    for i in range(400):
        toxic = i % 4 == 0
        group = rng.choice(["muslims", "jews"]) if rng.random() < (0.9 if toxic else 0.08) else "christians" if rng.random() < 0.5 else ""
        texts.append((i, f"{plain()} {group} {'vermin' if toxic and i % 8 else ''} {plain()}", int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id LONG, text STRING")
    return docs, spark.createDataFrame([(i, y, 9) for i, _, y in texts], "doc_id LONG, toxic INT, text INT")


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    docs, labels = labelled(spark)
    blunt = toxicity.train(docs, labels, F.lit(True), fairness=0.0)
    fair = toxicity.train(docs, labels, F.lit(True), fairness=5.0)
    gap = lambda m: abs(m.score("lorem muslims ipsum") - m.score("lorem christians ipsum"))
    assert gap(blunt) > 0.1 and gap(fair) < gap(blunt) / 3
    assert fair.score("vermin muslims") > toxicity.THRESHOLD > fair.score("dolor christians sit")
    assert fair == toxicity.train(docs.repartition(7), labels, F.lit(True), fairness=5.0)


def test_toxicity_sample_bounds_rows_of_repeated_ids(spark):
    rows = [(1, "a")] * 400 + [(1, "b")] * 3 + [(1, None), (1, "")] + [(i, f"t{i}") for i in range(2, 30)] + [(2, f"u{i}") for i in range(50)] + [(None, "n")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 25)] + [(77, 1)], "doc_id LONG, toxic INT")
    taken = lambda n, d=docs: shown((r.toxic, r.text or "") for r in toxicity.training_rows(d, labels, F.lit(True), n).collect())
    every = {(i, t or "") for i, t in rows if i and i < 25}
    assert taken(1000) == shown((i % 2, t) for i, t in every)
    assert len(taken(10)) == 10 and taken(10) == taken(10, docs.repartition(3)) and set(taken(10)) <= set(taken(1000))


def test_toxicity_without_labels_or_documents(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(1, None), (None, 1), (10**9, 1)], "doc_id LONG, toxic INT")
    model = toxicity.train(docs, labels, F.lit(True))
    scores = toxicity.score_texts(docs, model).collect()
    assert len(scores) == len(rows) and all(0 <= r.score < toxicity.THRESHOLD for r in scores)
    assert toxicity.drop_toxic(docs, model).columns == docs.columns and toxicity.drop_toxic(docs, model).count() == len(rows)
    assert toxicity.score_texts(nothing, model).count() == 0


def test_toxicity_scores_equal_a_plain_fit(spark, docs, rows):
    """The query over the smallest tables, and sentences that name groups, next to a dense fit in plain Python."""
    from sunledger.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    scored = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, folder).collect()}
    seen = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if not scored[r.doc_id].held_out and r.toxic is not None}
    want = brute.toxicity_scores([(y, texts[i]) for i, y in seen.items()], list(texts.values()), toxicity.counterfactuals)
    assert [scored[i].score for i in texts] == pytest.approx(want, abs=1e-6)
    docs_, labels = labelled(spark)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    known = [(r.doc_id, r.text) for r in docs_.collect()]
    model = toxicity.train(docs_, labels, F.lit(True))
    want = brute.toxicity_scores([(toxic[i], t) for i, t in known], [t for _, t in known], toxicity.counterfactuals)
    assert [model.score(t) for _, t in known] == pytest.approx(want, abs=1e-6)


def test_toxicity_on_held_out_rows(spark):
    from sunledger.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = [(labels[r.doc_id], r.predicted) for r in QUERIES["op9_toxicity"](spark, folder).where("held_out").collect() if r.doc_id in labels]
    toxic = sum(y for y, _ in scored)
    assert sum(y and p for y, p in scored) >= 0.9 * toxic and sum(p and not y for y, p in scored) <= 0.01 * len(scored)


# ---- 10
def test_substring_dedup(docs, rows, nothing):
    for window in (41, 20, 3):
        found = substring_dedup.dedup_substrings(docs, window).collect()
        want = [(i, *x) for (i, _), x in zip(rows, brute.removed_words(rows, window))]
        assert shown((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in found) == shown(want)
    assert substring_dedup.dedup_substrings(nothing).count() == 0


def test_levels_double_until_nothing_survives(spark):
    """Survivors of each level, counted against what truly repeats at its length."""
    assert substring_dedup.levels(20) == [10, 20] and substring_dedup.levels(41) == [6, 11, 21, 41]
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = {size: text(size) for size in (14, 30, 60)}
    texts = [" ".join(text(80) + shared[size] + text(80)) for size in shared for _ in range(2)]
    docs = frame(spark, list(enumerate(texts)))
    gram, *runs = substring_dedup.levels(40)
    assert [gram, *runs] == [10, 20, 40]
    anchors = repeats.repeated_anchors(repeats.anchor_rows(docs, substring_dedup.word_values, gram, 40, runs[:-1]))
    first = {r.doc_id for r in anchors.select("doc_id").collect()}
    second = {r.doc_id for r in repeats.distinct_unions(anchors, runs[:-1]).select("head.doc_id").collect()}
    third = {r.doc_id for r in substring_dedup.late_spans(docs, 40).select("doc_id").collect()}
    # Runs of 14, 30 and 60 words may live on at 10, those of 30 and 60 at 20, that of 60 alone repeats a window.
    assert {4, 5} <= first <= set(range(6)) and len(first) > 2
    assert {4, 5} <= second <= {2, 3, 4, 5} and third == {5}
    assert substring_dedup.late_spans(frame(spark, [(1, texts[0]), (2, " ".join(text(90)))]), 40).isEmpty()


@pytest.mark.parametrize("values_of", [suffix_dedup.byte_values, substring_dedup.word_values])
def test_unions_and_windows_of_thue_morse_texts_differ(values_of):
    letters = ["ab"[bin(i).count("1") % 2] for i in range(2048)]
    swapped = ["ba"["ab".index(c)] for c in letters]
    gap = " " if values_of is substring_dedup.word_values else ""
    one, two = (values_of(gap.join(t).encode()) for t in (letters, swapped))
    start, end = np.array([0]), np.array([2048])
    assert repeats.Rolling(one).hashes(start, end) == repeats.Rolling(two).hashes(start, end)
    assert repeats.PrimeRolling(one).hashes(start, end) != repeats.PrimeRolling(two).hashes(start, end)
    unions = [np.concatenate([p[1] for p in repeats.anchors_of(v, 1024, 2048)]) for v in (one, two)]
    assert unions[0] != unions[1]


@pytest.mark.parametrize("rolling", [repeats.Rolling, repeats.PrimeRolling])
def test_hashes_depend_on_content_alone(rolling):
    values = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    at = np.arange(4900)
    shifted = rolling(np.concatenate([values[:3], values])).hashes(at + 3, at + 80)
    assert (rolling(values).hashes(at, at + 77) == shifted).all() and len(set(shifted.tolist())) == 4900


def test_long_documents_are_cut_into_segments(spark, monkeypatch):
    from sunledger.llm import repeats

    monkeypatch.setattr(repeats, "SEGMENT", 50)
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cut = [np.concatenate(c) for c in zip(*repeats.anchors_of(values, 4, 10))]
    monkeypatch.setattr(repeats, "SEGMENT", 1 << 17)
    whole = [np.concatenate(c) for c in zip(*repeats.anchors_of(values, 4, 10))]
    places = lambda a: {int(f) + j: int(f) + int(lead) for f, lead, n in zip(*a[2:]) for j in range(int(n))}
    assert places(cut) == places(whole) and len(places(whole)) == 391


# ---- pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), ~toxicity.held_out(F.col("doc_id")))
    kept = [(r.doc_id, r.text) for r in docs.collect() if model.score(r.text) < toxicity.THRESHOLD]
    largest = {t: max(i for i, u in kept if u == t) for _, t in kept}
    kept = [(i, t) for i, t in kept if largest[t] == i]
    roots = brute.near_components(kept)
    kept = [(i, t) for i, t in kept if roots[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = [(i, t) for (i, t), found in zip(kept, brute.contamination([t for _, t in kept], items)) if not found[3]]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == names
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, _ in kept)
    got = {r.doc_id: r["size"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == {i: len(brute.SPACE.findall(t or "")) for i, t in kept}
