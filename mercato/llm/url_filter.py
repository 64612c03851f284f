"""URL filter rules, indexed by their rarest literal token.

A rule is a pattern over "host/path" and lists literal tokens without which it can't
match. The index files each rule under the token that the fewest URLs have, counted over
all URLs. The tokens of a URL fetch its candidate rules, and only those run their regular
expressions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import read

TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Rule:
    """``pattern`` must match at the start of "host/path"; ``tokens`` must all occur in it.

    ``rank`` orders the matching rules: the largest wins, of equals the first by name.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def path_rule(name: str, verdict: str) -> Rule:
    """A host with all its subdomains, and a prefix of the path, as in ``example.org/a/``."""
    host, slash, rest = name.partition("/")
    path = slash + rest
    pattern = rf"(?:[^/]*\.)?{re.escape(host)}\x00{re.escape(path)}"
    # The last piece of a path prefix may go on in the URL, so it isn't a whole token there.
    whole = re.sub(r"[^\W_]+\Z", "", path)
    return Rule(name, verdict, pattern, tuple(TOKEN.findall(f"{host} {whole}")), len(name))


def host_rule(word: str, verdict: str) -> Rule:
    """A host with a label of that name."""
    label = rf"(?:[^/\x00]*\.)?{re.escape(word)}(?:\.[^\x00]*)?\x00"
    return Rule(word, verdict, label, tuple(TOKEN.findall(word)), len(word))


PATH_RULES = tuple(
    path_rule(name, verdict)
    for name, verdict in (
        ("org/", "allow"),
        ("example.org/es/", "block"),
        ("example.org/en/1", "block"),
        ("com/fr/", "allow"),
        ("com/de/", "block"),
    )
)
# What decides where no path rule fits.
HOST_RULES = tuple(host_rule(x, "block") for x in ("cheap-pills", "free-bets", "spam-farm"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def token_frequencies(urls: DataFrame, tokens: Iterable[str]) -> dict[str, int]:
    """In how many URLs each of ``tokens`` occurs. At most one row per token comes back."""
    wanted = frozenset(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update(wanted.intersection(TOKEN.findall(f"{host} {path}")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
            names=["token", "n"],
        )

    counts = urls.select("host", "path").mapInArrow(count, "token string, n long")
    return {r["token"]: r["n"] for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class RuleIndex:
    """Rules by their rarest token; rules without tokens are candidates for every URL."""

    def __init__(self, rules: Iterable[Rule], frequency: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern]] = []
        for rule in rules:
            entry = (rule, re.compile(rule.pattern, re.DOTALL))
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def best(self, host: str, path: str) -> Rule | None:
        found = [rule for rule, pattern in self.candidates(host, path) if pattern.match(f"{host}\0{path}")]
        return max(found, key=lambda r: r.rank) if found else None

    def candidates(self, host: str, path: str) -> list[tuple[Rule, re.Pattern]]:
        out = list(self.always)
        for token in set(TOKEN.findall(f"{host} {path}")):
            out.extend(self.by_token.get(token, ()))
        return sorted(out, key=lambda entry: entry[0].name)


def judge(
    pages: DataFrame,
    *,
    rules: Iterable[Rule] = PATH_RULES,
    fallback: Iterable[Rule] = HOST_RULES,
    default: str = "allow",
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    The best of ``rules`` decides and is named in ``rule``. Where none fits, ``rule`` is
    null and ``fallback`` rules decide by the same index, then ``default``. Null urls and
    urls without ``://`` have an empty host and path. Rules are a parameter, so the index
    that goes to the tasks doesn't grow with the data; tasks read URLs in place, without
    a shuffle.
    """
    rules, fallback = tuple(rules), tuple(fallback)
    parts = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("_url")
    )
    host, path = host_and_path(F.col("_url"))
    parts = parts.select("page_id", host.alias("host"), path.alias("path"))
    frequency = token_frequencies(parts, {t for r in (*rules, *fallback) for t in r.tokens})

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = RuleIndex(rules, frequency), RuleIndex(fallback, frequency)
        for batch in batches:
            names, verdicts = [], []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rule = first.best(host, path)
                other = None if rule else second.best(host, path)
                names.append(rule.name if rule else None)
                verdicts.append((rule or other).verdict if rule or other else default)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(names, pa.string()),
                 pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return parts.mapInArrow(
        decide, "page_id long, host string, path string, rule string, verdict string"
    )


def op5_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


OP5_SQL = """
WITH parts AS (
    SELECT page_id,
           CASE WHEN instr(url, '://') > 0
                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules (rule_host, rule_path, rule_verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
           ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict
    FROM split LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (
        PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, rule) = 1
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict,
                CASE WHEN regexp_matches(host, '(^|\\.)(cheap-pills|free-bets|spam-farm)(\\.|$)')
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""
