"""Secrets in texts, and credentials whose parts only tell together.

Strong findings stand by themselves: assignments to a secret's name, access key ids and
long runs of hex digits. An account name, a bare key or an endpoint is a weak candidate:
harmless alone, and reported only where the parts that complete it stand nearby, within one
scope (a paragraph of the text). Parts meet in an interval join: positions fall into cells as
long as the reach, so a partner lies in the same cell or a neighbour, and of each cell only
its first and last part of a role take part. No pairs are formed, and the cells of a long
text spread over tasks.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import read, small, stored, text_of

# The strong kinds in their order, patterns and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# The weak kinds, which follow in this order; a weak part that overlaps a finding or a part of
# a kind before it is none.
ENDPOINT = (
    r"""(https?|ftps?|sftp|ssh|smtps?|imaps?|ldaps?|postgres|postgresql|mysql|mongodb|redis|amqps?|s3)://[^\x00-\x20"'<>]+"""
    r"""|(hostname|host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+(:[0-9]+)?"""
)
ACCOUNT = r"""(username|user|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
KEY = r"[A-Za-z0-9+/_-]+"
LEAST_ACCOUNT, LEAST_KEY = 3, 20

KINDS = ("assign", "access", "hex", "endpoint", "account", "key")
IDENTIFIER, SECRET, PLACE = 0, 1, 2
ROLES = (SECRET, IDENTIFIER, SECRET, PLACE, IDENTIFIER, SECRET)
# What must stand near a weak part of each kind before it is reported.
NEEDS = {3: (IDENTIFIER, SECRET), 4: (SECRET,), 5: (IDENTIFIER,)}
STRONG = 3

SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
PART = pa.struct([*SPAN, pa.field("scope", pa.int64())])

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# A maximal run of a least length is what the patterns above find and keep.
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
_ENDPOINT = re.compile(ENDPOINT, re.IGNORECASE | re.ASCII)
_ACCOUNT = re.compile(ACCOUNT, re.IGNORECASE | re.ASCII)
_KEY = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_KEY},}}")
_SCOPE_END = re.compile(r"\n[ \t\r]*\n")


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what is reported without any other part, in order."""
    assigns = _ASSIGN.finditer(text) if ":" in text or "=" in text else ()
    found = [(m.start(), 0, m.end()) for m in assigns if m.end() - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _mixed(run: str) -> bool:
    return run.upper() != run and run.lower() != run and any("0" <= c <= "9" for c in run)


def weak_spans(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of endpoints, accounts and bare keys that overlap nothing before them."""
    assigned = ":" in text or "=" in text
    kinds = [
        [(m.start(), 3, m.end()) for m in _ENDPOINT.finditer(text)] if assigned else [],
        [
            (m.start(), 4, m.end())
            for m in (_ACCOUNT.finditer(text) if assigned else ())
            if m.end() - m.start(2) >= LEAST_ACCOUNT
        ],
        [(m.start(), 5, m.end()) for m in _KEY.finditer(text) if _mixed(m[0])],
    ]
    out: list[tuple[int, int, int]] = []
    for found in kinds:
        taken = sorted((start, end) for start, _, end in [*strong, *out])
        ends, reach = [], 0
        for _, end in taken:
            reach = max(reach, end)
            ends.append(reach)
        for start, kind, end in found:
            before = bisect_left(taken, (end,))  # spans that start ahead of this one's end
            if not before or ends[before - 1] <= start:
                out.append((start, kind, end))
    return sorted(out)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strong findings of each row, and all its parts with their scopes if some are weak."""
    for batch in small(batches):
        strong, parts = [], []
        for text in batch.column("text").to_pylist():
            found = strong_spans(text)
            weak = weak_spans(text, found)
            strong.append([dict(zip(("start", "kind", "end"), s)) for s in found])
            if len({ROLES[kind] for _, kind, _ in (*found, *weak)}) < 2 or not weak:
                parts.append([])
                continue
            breaks = [m.start() for m in _SCOPE_END.finditer(text)]
            parts.append(
                [
                    {"start": s, "kind": k, "end": e, "scope": bisect_right(breaks, s)}
                    for s, k, e in (*found, *weak)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(strong, pa.list_(SPAN)), pa.array(parts, pa.list_(PART))],
            ["doc_id", "strong", "parts"],
        )


def linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts of (row, scope, start, kind, end) that have their complement nearby.

    Near means: the same row and scope, and starts at most ``reach`` code points apart.
    """
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1)
    placed = parts.select(
        "row", "scope", "start", "kind", "end", role.alias("role"),
        F.floor(F.col("start") / reach).alias("cell"),
    )
    cells = placed.groupBy("row", "scope", "cell", "role").agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    )
    weak = placed.filter(F.col("kind") >= STRONG).select(
        "row", "scope", "start", "kind", "end",
        F.explode(F.array(*[F.col("cell") + i for i in (-1, 0, 1)])).alias("cell"),
    )
    near = (F.col("first") <= F.col("start") + reach) & (F.col("last") >= F.col("start") - reach)
    roles = (
        weak.join(cells, ["row", "scope", "cell"])
        .filter(near)
        .groupBy("row", "start", "kind", "end")
        .agg(*[F.max(F.col("role") == r).alias(f"has{r}") for r in (IDENTIFIER, SECRET)])
    )
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        whole = F.lit(True)
        for r in needs:
            whole = whole & F.col(f"has{r}")
        complete = complete | ((F.col("kind") == kind) & whole)
    return roles.filter(complete).select("row", "start", "kind", "end")


def scan(docs: DataFrame, *, reach: int = 200) -> DataFrame:
    """(doc_id, strong, spans): a row for each row of ``docs``, with (start, kind, end) structs.

    ``strong`` has the findings that stand alone, ``spans`` these and the linked parts, both by
    start, then kind (a number into ``KINDS``), then end. Positions are code points, ends
    exclusive. A null text is empty and has no spans; rows that repeat or whose id is null are
    judged one by one; an empty table gives none. Other columns are not read.
    """
    found = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .mapInArrow(
            _parts,
            "doc_id long, strong array<struct<start: long, kind: int, end: long>>, "
            "parts array<struct<start: long, kind: int, end: long, scope: long>>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "secret-parts",
    )
    alone = found.filter(F.size("parts") == 0).select("doc_id", "strong", F.col("strong").alias("spans"))
    some = found.filter(F.size("parts") > 0)
    more = (
        linked(some.select("row", F.inline("parts")), reach)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    )
    joined = some.join(more, "row", "left").select(
        "doc_id",
        "strong",
        F.array_sort(F.concat("strong", F.coalesce("more", F.array().cast(found.schema["strong"].dataType)))).alias("spans"),
    )
    return alone.unionByName(joined)


def findings(docs: DataFrame, *, reach: int = 200) -> DataFrame:
    """(doc_id, kind, start, end, strong): a row for each span, with the kind's name."""
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return scan(docs, reach=reach).select("doc_id", F.inline("spans")).select(
        "doc_id", name.alias("kind"), "start", "end", (F.col("kind") < STRONG).alias("strong")
    )


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def _count(kind: int) -> Column:
    return F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id",
        *[_count(kind) for kind in range(STRONG)],
        F.sha2(_listed("strong"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def _either_case(pattern: str) -> str:
    """The pattern with ASCII letters outside of classes and escapes in either case."""
    parts = re.split(r"(\[[^\]]*\]|\\x[0-9A-Fa-f]{2})", pattern)
    return "".join(
        part if i % 2 else re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", part)
        for i, part in enumerate(parts)
    )


def _sql() -> str:
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    patterns = [_either_case(ASSIGN), ACCESS, HEX, _either_case(ENDPOINT), _either_case(ACCOUNT), KEY]
    value = lambda k, group: f"length(regexp_extract(found, {quoted(patterns[k])}, {group}))"
    keeps = [
        f"{value(0, 2)} >= {LEAST_VALUE}", f"length(found) >= {LEAST_ACCESS}", f"length(found) >= {LEAST_HEX}",
        "true", f"{value(4, 2)} >= {LEAST_ACCOUNT}",
        f"length(found) >= {LEAST_KEY} AND regexp_matches(found, '[A-Z]') AND regexp_matches(found, '[a-z]')"
        " AND regexp_matches(found, '[0-9]')",
    ]
    kinds = "".join(
        f"""
pieces{k} AS (
  SELECT r, unnest(string_split(regexp_replace(text, {quoted(p)}, chr(1) || '\\0' || chr(2), 'g'), chr(1))) AS piece,
    generate_subscripts(string_split(regexp_replace(text, {quoted(p)}, chr(1) || '\\0' || chr(2), 'g'), chr(1)), 1) AS i
  FROM raw
),
kind{k} AS MATERIALIZED (
  SELECT r, {k} AS kind, low, low + length(found) AS high FROM (
    SELECT r, i, split_part(piece, chr(2), 1) AS found,
      coalesce(sum(length(replace(piece, chr(2), ''))) OVER (
        PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low
    FROM pieces{k})
  WHERE i > 1 AND {keeps[k]}
),"""
        for k, p in enumerate(patterns)
    )
    overlaps = "x.r = y.r AND x.low < y.high AND y.low < x.high"
    for k, before in enumerate(("strong", "first", "second"), STRONG):
        name = ("first", "second", "parts")[k - STRONG]
        kinds += f"""
{name} AS MATERIALIZED (
  FROM {before} UNION ALL
  SELECT * FROM kind{k} x WHERE NOT EXISTS (FROM {before} y WHERE {overlaps})
),"""
    role = lambda names: f"IN ({', '.join(str(k) for k, r in enumerate(ROLES) if r == names)})"
    near = lambda r: (
        f"EXISTS (FROM placed y WHERE y.r = x.r AND y.scope = x.scope AND y.kind {role(r)} AND abs(y.low - x.low) <= 200)"
    )
    complete = " OR ".join(
        f"kind = {k} AND " + " AND ".join(map(near, needs)) for k, needs in NEEDS.items()
    )
    names = f"[{', '.join(map(quoted, KINDS))}]"
    listed = f"string_agg({names}[kind + 1] || ':' || low || ':' || high, ',' ORDER BY low, kind, high)"
    strong = " UNION ALL ".join(f"FROM kind{k}" for k in range(STRONG))
    head, tail = kinds.split("\npieces3 AS", 1)
    return f"""
WITH raw AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS text
  FROM documents
),{head}
strong AS MATERIALIZED ({strong}),
pieces3 AS{tail}
placed AS MATERIALIZED (
  SELECT p.*, len(regexp_extract_all(substr(text, 1, CAST(low AS BIGINT)), '\\n[ \\t\\r]*\\n')) AS scope
  FROM parts p JOIN raw USING (r)
),
reported AS (
  SELECT * FROM placed x WHERE kind < {STRONG} OR {complete}
),
base AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, {listed} AS listed
  FROM strong GROUP BY r
),
spans AS (
  SELECT r, {listed} AS spans FROM reported GROUP BY r
)
SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM raw LEFT JOIN base USING (r) LEFT JOIN spans USING (r)
"""


OP11_SQL = _sql()
