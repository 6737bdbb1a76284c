"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score. Column functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matches that one running sum handles; longer lists are summed block by block, so a text with any number is linear.
BLOCK = 128
CONTEXT_CHARS = 40
REPORTED = 0.5
SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"
PAIRS = "array<struct<hit:string,before:string,after:string>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The sum of the digits, every second one from the right doubled (and reduced by 9 above 9), divides by ten."""
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Country and check digits moved to the end, letters read as 10 to 35: the number leaves 1 modulo 97."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest, i):
        c = F.substring(moved, i, F.lit(1))
        letter = F.ascii(c) - 55
        return F.when(c >= "A", (rest * 100 + letter) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


# Letters and digits of an IBAN by country: the registry, and countries that write them without being in it.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
IBAN = "|".join(rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())

PART_255 = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """`pattern` proposes, `confirmed` judges the match; a confirmed match scores `score`, plus `bonus` where one of the
    `context` words stands within 40 characters before or after it, in other matches too. It is reported from 0.5 on.

    Patterns loop over single characters or possessively, so no text overflows the matcher's stack; a run of one
    character class is entered at its start or where the last match ended, so none is rescanned from each position.

    A kind that `overlaps` is proposed wherever its pattern fits, also inside another proposal, so one that is not
    confirmed hides none behind it; its pattern must end within a bounded number of characters."""

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    bonus: float = 0.1
    overlaps: bool = False

    @property
    def proposal(self) -> str:
        """What is searched for; the match of a kind that overlaps is one character, followed by the rest of it."""
        return rf"(?=({self.pattern}))(?s:.)" if self.overlaps else self.pattern

    @property
    def group(self) -> int:
        """The number of the match's group in the proposal; the next one is what `seen` captures."""
        return int(self.overlaps)

    @property
    def seen(self) -> str:
        """The proposal with the characters after the match captured."""
        after = rf"((?s:.{{0,{CONTEXT_CHARS}}}))"
        return rf"(?=({self.pattern}){after})(?s:.)" if self.overlaps else rf"(?:{self.pattern})(?={after})"

    def taken(self, hit: Column) -> Column:
        """The part of the hit after which the search goes on."""
        return F.substring(hit, 1, 1) if self.overlaps else hit


BASE_KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.8,
        "mail|contact|kontakt|correo",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{PART_255}(?:\.{PART_255}){{3}}$"),
        0.6,
        r"\bip\b|host|server|addr",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda m: F.length(digits_of(m)).between(14, 19) & luhn(digits_of(m)),
        0.8,
        "card|karte|carte|tarjeta|visa|credit",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(digits_of(m)).between(10, 15),
        0.6,
        "phone|call|tel|mobil|fax",
    ),
)
ADDED_KINDS = (
    Kind("iban", rf"(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})", mod97, 0.8, "iban|bank|konto|account|compte|cuenta", overlaps=True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: F.lit(True), 0.3, "ssn|social security", 0.4),
)
KINDS = BASE_KINDS + ADDED_KINDS


def located(pairs: Column, kind: Kind, rank: int) -> Column:
    """Spans of the confirmed matches, with offsets in code points: the lengths of gaps and matches are summed within
    blocks, and block lengths over the blocks. The text before a match is carried along as its last characters; as every
    match takes one at least, those before a block lie within as many matches."""
    width = lambda p: F.length(p["before"]) + F.length(kind.taken(p["hit"]))
    numbers = F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK)))
    widths = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + width(p)))
    begins = F.transform(numbers, lambda b: F.aggregate(F.slice(widths, F.lit(1), b), F.lit(0), lambda n, w: n + w))
    last = lambda text: F.substring(text, -CONTEXT_CHARS, CONTEXT_CHARS)
    through = lambda p: last(F.concat(p["before"], kind.taken(p["hit"])))
    ahead = lambda b: F.slice(pairs, b * BLOCK + 1 - CONTEXT_CHARS, F.lit(CONTEXT_CHARS))
    tails = F.transform(numbers, lambda b: F.when(b > 0, last(F.array_join(F.transform(ahead(b), through), ""))).otherwise(""))
    states = F.zip_with(begins, tails, lambda begin, tail: F.struct(begin.alias("at"), tail.alias("tail")))
    nothing = F.array().cast(f"array<{SPAN}>")

    def add(state, p):
        start = state["at"] + F.length(p["before"])
        end = start + F.length(p["hit"])
        before = last(F.concat(state["tail"], p["before"]))
        near = F.lower(F.concat_ws(" ", before, p["after"]))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), F.lit(kind.bonus)).otherwise(F.lit(0.0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"))
        kept = kind.confirmed(p["hit"]) & (score >= REPORTED)
        found = F.when(kept, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        at = start + F.length(kind.taken(p["hit"]))
        return F.struct(at.alias("at"), last(F.concat(before, kind.taken(p["hit"]))).alias("tail"), found.alias("found"))

    def of_block(block, begin):
        state = F.struct(begin["at"].alias("at"), begin["tail"].alias("tail"), nothing.alias("found"))
        return F.aggregate(block, state, add, lambda s: s["found"])

    return F.flatten(F.zip_with(blocks, states, of_block))


def find_personal_data(docs: DataFrame, kinds: Sequence[Kind] = KINDS, text: str = "text") -> DataFrame:
    """Per row of docs: doc_id and `spans`, by start, then kind as listed: start, rank, end, kind, score. Offsets count
    code points, the end is exclusive. Each kind is matched on its own, leftmost and without overlap; a match that is
    not confirmed is dropped and not tried again. Of a kind that overlaps every confirmed match is reported. Null and empty texts have no spans; repeated rows are judged one by one.
    """
    whole = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    hits = whole.select("doc_id", "_text", *[F.regexp_extract_all("_text", F.lit(k.proposal), F.lit(k.group)).alias(f"_hits{i}") for i, k in enumerate(kinds)])
    gaps = hits.select(
        "doc_id",
        *[f"_hits{i}" for i in range(len(kinds))],
        *[F.when(F.size(f"_hits{i}") > 0, F.split("_text", k.proposal, -1)).alias(f"_gaps{i}") for i, k in enumerate(kinds)],
        *[
            F.when(F.size(f"_hits{i}") > 0, F.regexp_extract_all("_text", F.lit(k.seen), F.lit(k.group + 1))).alias(f"_after{i}")
            for i, k in enumerate(kinds)
        ],
    )

    def pairs(i):
        n = F.size(f"_hits{i}")
        sides = F.arrays_zip(F.col(f"_hits{i}").alias("hit"), F.slice(f"_gaps{i}", F.lit(1), n).alias("before"), F.col(f"_after{i}").alias("after"))
        return F.when(n > 0, sides.cast(PAIRS)).alias(f"_pairs{i}")

    paired = gaps.select("doc_id", *[pairs(i) for i in range(len(kinds))])
    none = F.array().cast(f"array<{SPAN}>")
    lists = [
        F.when(F.col(f"_pairs{i}").isNotNull(), located(F.col(f"_pairs{i}"), k, i)).otherwise(none) for i, k in enumerate(kinds)
    ]
    return paired.select("doc_id", F.array_sort(F.concat(*lists)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
