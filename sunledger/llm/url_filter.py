"""URL rules indexed by their rarest literal token: a URL's tokens fetch the rules worth running."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import UPPER, ascii_lower

# A rule list is a parameter and is sent to every task: at most this many rules.
MOST_RULES = 1_000_000
LOWER = str.maketrans(UPPER, UPPER.lower())
TOKEN = re.compile(r"[^./?#&=_~%+:@!$'()*,;\-]+")


@dataclass(frozen=True)
class Rule:
    """`pattern` runs over host + path; `tokens` are literals of which each is a whole token of every URL that the
    pattern matches (none: the rule runs on every URL). Of several matching rules the highest rank wins, then the first.
    A rule that ignores case sees A-Z lower-cased, in path and host; its tokens and pattern are in small letters."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int
    any_case: bool = False


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits a host and its subdomains where the path starts with `path`; longer rules win over shorter ones."""
    inside = path if path.endswith("/") else path[: path.rfind("/") + 1]  # a cut token need not be a whole one
    tokens = tuple(TOKEN.findall(host)) + tuple(TOKEN.findall(inside))
    return Rule(host + path, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tokens, len(host + path))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """A word that stands alone anywhere in host or path, in letters of either case. Nameless and of the lowest rank."""
    return Rule("", rf"(?s:.*)(?<![^./_~\-]){re.escape(word)}(?![^./_~\-])", verdict, (word,), -1, any_case=True)


SITE_RULES = (
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
)
UNWANTED_WORDS = ("casino", "porn", "xxx", "viagra", "warez", "torrent")
RULES = SITE_RULES + tuple(word_rule(w) for w in UNWANTED_WORDS)


def host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path. Both are empty for a null URL or one without `://`."""
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return pages.select(
        "page_id",
        ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many URLs each of the rules' tokens stands, A-Z lower-cased (they order the tokens only; capitals count as
    rare); as many rows come back as the rules have tokens."""
    if not tokens:
        return {}
    wanted = F.broadcast(urls.sparkSession.createDataFrame([(t,) for t in tokens], "token string"))
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(F.concat("host", "path")), F.lit(TOKEN.pattern), F.lit(0)))
    rows = urls.select(F.explode(found).alias("token")).join(wanted, "token").groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


class RuleIndex:
    """Rules by their rarest token."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.rules = list(rules)
        self.by_token: dict[str, list[int]] = defaultdict(list)
        self.always: list[int] = []
        for i, rule in enumerate(self.rules):
            if rule.tokens:
                self.by_token[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
            else:
                self.always.append(i)
        self.compiled: dict[int, re.Pattern] = {}

    def matches(self, i: int, url: str, lowered: str) -> bool:
        if i not in self.compiled:
            self.compiled[i] = re.compile(self.rules[i].pattern)
        return self.compiled[i].match(lowered if self.rules[i].any_case else url) is not None

    def judge(self, url: str) -> Rule | None:
        lowered = url.translate(LOWER)
        candidates = set(self.always)
        for token in {*TOKEN.findall(url), *(TOKEN.findall(lowered) if lowered != url else ())}:
            candidates.update(self.by_token.get(token, ()))
        best = max(candidates, key=lambda i: (self.rules[i].rank, -i), default=None)
        while best is not None and not self.matches(best, url, lowered):
            candidates.discard(best)
            best = max(candidates, key=lambda i: (self.rules[i].rank, -i), default=None)
        return None if best is None else self.rules[best]


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    `rule` is the name of the winning rule, null where none or a nameless one decides; `verdict` is that rule's, else
    `default`. Null and unparsable URLs have an empty host and path and meet no rule that needs a token. Repeated pages
    are judged one by one; a hot host costs nothing beyond its rows, as nothing is shuffled but token counts.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit")
    urls = host_and_path(pages)
    counts = token_counts(urls, sorted({t for r in rules for t in r.tokens}))
    shared = urls.sparkSession.sparkContext.broadcast((tuple(rules), counts))

    def run(batches):
        index = RuleIndex(*shared.value)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            won = [index.judge(h + p) for h, p in zip(hosts, paths)]
            rule = pa.array([r.name or None if r else None for r in won], pa.string())
            verdict = pa.array([r.verdict if r else default for r in won], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], ["page_id", "host", "path", "rule", "verdict"])

    id_type = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string")
