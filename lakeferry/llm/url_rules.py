"""URL filters: pattern rules, each indexed by its rarest literal token.

A rule is a regular expression on a URL's host and path. Most rules demand some
literal tokens (runs of ASCII letters and digits that stand whole in whatever
they match). Each rule is filed under the one of them that is rarest in the URLs
at hand, counted over all of them. A URL's tokens fetch the rules filed under
them, and only those run their expressions; a rule without a whole token is a
candidate for every URL. The longest fitting host rule decides. Where none
fits, the verdict is block if any pattern rule fits, else allow.

Rules are sent to all tasks in blocks of at most `BLOCK_RULES`; more take more
passes over the URLs, which are the only column read for this. Nothing is grouped or shuffled, so
a host that all pages share costs no more than others.

Hosts are what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case;
paths go from there up to `?`, `#` or the end.

Defined results: a null URL, or one without `://`, has an empty host and path,
and no rule that needs either fits. Of equally long fitting rules the first by text wins. Without
rules, all is allowed. Repeated rows are judged alike; other columns pass
through, but for those named like a result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_RULES = 100_000
TOKEN = re.compile(r"[0-9A-Za-z]+")
RESULT = ("host", "path", "rule", "verdict")

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class HostRule:
    """A verdict on a host, its subdomains, and paths that begin so."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return rf"(?:[^/]*\.)?{re.escape(self.host)}(?![^/]){re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens that stand whole in every URL that fits."""
        whole = self.host + self.path
        found = list(TOKEN.finditer(whole))
        return [m[0] for m in found if m.end() < len(whole) or m.end() <= len(self.host)]


@dataclass(frozen=True)
class PatternRule:
    """Block what fits a pattern: literal text, with * for any characters."""

    pattern: str
    verdict: str = "block"

    @property
    def text(self) -> str:
        return self.pattern

    @property
    def regex(self) -> str:
        return "[\\s\\S]*".join(map(re.escape, self.pattern.split("*"))) + r"\Z"

    @property
    def tokens(self) -> list[str]:
        n = len(self.pattern)
        inside = lambda i: 0 <= i < n and self.pattern[i] == "*"
        found = TOKEN.finditer(self.pattern)
        return [m[0] for m in found if not inside(m.start() - 1) and not inside(m.end())]


Rule = HostRule | PatternRule

#: what the method blocks by itself: hosts and paths that sell, spam or load programs
PATTERNS: tuple[PatternRule, ...] = tuple(
    map(
        PatternRule,
        (
            "spam-farm.*",
            "*.spam-farm.*",
            "cheap-pills.*",
            "*.cheap-pills.*",
            "casino.*",
            "*.casino.*",
            "*/casino/*",
            "*/adult/*",
            "*/login/*",
            "*/cart/*",
            "*.exe",
            "*.apk",
        ),
    )
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


class Index:
    """Rules by their rarest token, with compiled expressions."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]) -> None:
        self.by_token: dict[str, list] = defaultdict(list)
        self.always: list = []
        for rule in rules:
            entry = (rule, re.compile(rule.regex))
            tokens = rule.tokens
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token[rarest].append(entry)
            else:
                self.always.append(entry)

    def fitting(self, place: str) -> Iterator[Rule]:
        """The rules that fit a host and path."""
        seen = [self.always, *[self.by_token[t] for t in set(TOKEN.findall(place)) if t in self.by_token]]
        for entries in seen:
            for rule, regex in entries:
                if regex.match(place):
                    yield rule


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many URLs have each of the rules' tokens; as many rows as there are of these at most."""
    wanted = sorted({t for rule in rules for t in rule.tokens})
    if not wanted:
        return {}
    tokens = F.regexp_extract_all(F.concat("host", "path"), F.lit("([0-9A-Za-z]+)"), 1)
    found = urls.select(F.explode(F.array_distinct(tokens)).alias("token"))
    known = urls.sparkSession.createDataFrame([(token,) for token in wanted], "token string")
    found = found.join(F.broadcast(known), "token")
    return {r.token: r.n for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def judged(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", block_rules: int = BLOCK_RULES
) -> DataFrame:
    """The pages with host, path, the deciding host rule (or null) and verdict."""
    kept = [c for c in pages.columns if c.lower() not in RESULT]
    frame = pages.select(
        *kept,
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.lit(None).cast("string").alias("rule"),
        F.lit("allow").alias("verdict"),
    )
    schema = frame.schema
    schema["verdict"].nullable = True
    for start in range(0, len(rules), block_rules):
        block = list(rules[start : start + block_rules])
        sent = frame.sparkSession.sparkContext.broadcast((block, token_counts(frame, block)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(*sent.value)
            for batch in batches:
                rules_, verdicts = [], []
                columns = (batch.column(c).to_pylist() for c in RESULT)
                for host, path, rule, verdict in zip(*columns, strict=True):
                    best = (len(rule), rule) if rule is not None else None
                    for other in index.fitting(host + path):
                        if isinstance(other, PatternRule):
                            verdict = verdict if best else other.verdict
                        elif best is None or (-len(other.text), other.text) < (-best[0], best[1]):
                            best, verdict = (len(other.text), other.text), other.verdict
                    rules_.append(best and best[1])
                    verdicts.append(verdict)
                columns = [*batch.columns[:-2], pa.array(rules_, pa.string()), pa.array(verdicts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        frame = frame.mapInArrow(run, schema)
    return frame
