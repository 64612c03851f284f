"""URL rules and vector searches against brute force and SQL."""

import math
import random
from fractions import Fraction

import duckdb
import pytest

from mercato.llm import collision_search, hamming_search, queries, url_filter
from checks.compare import difference

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", queries.SQL)
def test_same_as_sql(llm, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    assert difference(queries.OPERATORS[name](llm, DATA), con.sql(queries.SQL[name])) is None


def test_urls(llm):
    cases = {
        1: ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("https://example.org/en/123", "example.org", "/en/123", "example.org/en/1", "block"),
        3: ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        4: ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        5: ("http://x.com/de", "x.com", "/de", None, "allow"),
        6: ("http://spam-farm.example.net", "spam-farm.example.net", "", None, "block"),
        7: ("no scheme/org/", "", "", None, "allow"),
        8: (None, "", "", None, "allow"),
        9: ("http://org?/a", "org", "", None, "allow"),
        10: ("x://com/fr/\n", "com", "/fr/\n", "com/fr/", "allow"),
    }
    pages = llm.createDataFrame(
        [(k, v[0], "h", 1) for k, v in cases.items()] + [(1, cases[1][0], None, 1), (None, "", None, 1)],
        "page_id long, url string, html string, host long",
    )
    got = url_filter.judge(pages).collect()
    assert len(got) == len(cases) + 2
    for r in got:
        if r.page_id:
            assert (r.host, r.path, r.rule, r.verdict) == cases[r.page_id][1:]


def vectors(n, dim, seed):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    out = [(i, [x + draw.gauss(0, 0.4) for x in draw.choice(centres)]) for i in range(n)]
    common = out[0][1]
    out = [(i, common if i % 3 == 0 else v) for i, v in out]
    nan, inf = float("nan"), float("inf")
    return [
        *out, (n + 50, None), (n + 100, []), (n + 150, [0.0] * dim), (n + 200, [nan] * dim),
        (n + 250, [inf] * dim), (n + 300, [None] * dim), (None, common), (7, out[7][1]), (n + 400, [1.0]),
    ]


def usable(table):
    return [
        (i, tuple(v)) for i, v in table
        if i is not None and v and None not in v and all(map(math.isfinite, v))
    ]


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))


def test_nearest_neighbours(llm):
    table = vectors(600, 16, 1)
    df = llm.createDataFrame([(*r, 0) for r in table], "vec_id long, embedding array<double>, score long")
    got = {}
    for r in collision_search.nearest(df.repartition(3), block_rows=200).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    rows = sorted({(i, v) for i, v in usable(table) if any(v)})
    found = wanted = 0
    for q, v in rows:
        if q % 50 == 0 and len(v) == 16:
            best = sorted((-round(cosine(v, w), 12), i) for i, w in rows if i != q and len(w) == 16)[:5]
            assert sorted(got[q]) == [1, 2, 3, 4, 5]
            found += len({i for _, i in best} & {i for i, _ in got[q].values()})
            wanted += 5
            scores = dict(rows)
            assert all(abs(s - cosine(v, scores[i])) < 1e-12 for i, s in got[q].values())
    assert found >= 0.9 * wanted


@pytest.mark.parametrize("powers", [(200, -200), (300, -300), (-310, 0), (-320, 300)])
def test_cosines_of_huge_and_tiny_vectors(llm, powers):
    """Products of such components overflow or vanish; the ranking is that of the directions."""
    draw = random.Random(8)
    plain = [(i, [draw.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    table = [(i, [x * 10.0 ** powers[i % 2] for x in v]) for i, v in plain]
    rows = {i: v for i, v in table if any(v)}
    # directions from the scaled values, which may have lost digits
    exact = {i: [Fraction(x) for x in v] for i, v in rows.items()}
    df = llm.createDataFrame(table, "vec_id long, embedding array<double>")
    got = {}
    for r in collision_search.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    found = 0
    for q in range(0, 300, 50):
        best = {}
        for i, v in exact.items():
            if i != q:
                dot = sum(x * y for x, y in zip(exact[q], v))
                square = dot * dot / (sum(x * x for x in exact[q]) * sum(x * x for x in v))
                best[i] = math.sqrt(square) * (1 if dot > 0 else -1)
        wanted = sorted(best, key=lambda i: (-best[i], i))[:5]
        found += len({i for i, _ in got[q]} & set(wanted))
        assert all(abs(score - best[i]) < 1e-12 for i, score in got[q])
        assert got[q][0][0] == wanted[0]
    assert found >= 27


def test_repeated_rows_leave_room_for_other_neighbours(llm):
    """Queries and candidates that stand ten times in a block, and one with ten vectors."""
    table = [(i, v) for i, v in usable(vectors(300, 16, 3)) if len(v) == 16 and any(v)]
    rows = dict(table)
    near = tuple(x + 0.001 for x in rows[50])
    table += [(50, rows[50])] * 9 + [(1000, near)] * 10 + [(100, rows[100])] * 9
    table += [(1001, tuple(x + 0.0001 * j for x in rows[100])) for j in range(1, 11)]
    df = llm.createDataFrame([(i, list(v)) for i, v in table], "vec_id long, embedding array<double>")
    got = {}
    for r in collision_search.nearest(df.coalesce(1), block_rows=4096).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    best = {q: {} for q in (50, 100)}
    for q in best:
        for i, v in table:
            if i != q:
                best[q][i] = max(best[q].get(i, -1), round(cosine(rows[q], v), 12))
        assert len(got[q]) == 5
        wanted = sorted(best[q], key=lambda i: (-best[q][i], i))[:5]
        assert len({*got[q]} & {*wanted}) >= 4 and wanted[0] in got[q]


def test_hamming_search_is_exact(llm):
    table = vectors(500, 40, 2)
    df = llm.createDataFrame([(*r, 0) for r in table], "vec_id long, embedding array<double>, code long")
    got = {}
    for r in hamming_search.top_k(hamming_search.sign_codes(df), k=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.distance)
    codes = {i: tuple(x > 0 for x in v) for i, v in usable(table)}
    for q, c in codes.items():
        if q % 100 == 0:
            best = sorted(
                (sum(a != b for a, b in zip(c, d)), i) for i, d in codes.items() if i != q and len(d) == len(c)
            )[:7]
            assert got.get(q, {}) == {n + 1: (i, d) for n, (d, i) in enumerate(best)}


def test_hamming_search_counts_an_id_once(llm):
    """An id with more codes near a query than there are places."""
    draw = random.Random(4)
    table = [(i, [draw.choice((-1.0, 1.0)) for _ in range(40)]) for i in range(200)]
    for q in (0, 100):
        for bit in range(30):
            table.append((q + 1, [-x if j == bit else x for j, x in enumerate(table[q][1])]))
            table.append((q, [-x if j in (bit, bit + 1) else x for j, x in enumerate(table[q][1])]))
    df = llm.createDataFrame(table, "vec_id long, embedding array<double>")
    got = {}
    for r in hamming_search.top_k(hamming_search.sign_codes(df), k=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.distance)
    for q in (0, 100):
        best = {}
        for i, c in table:
            for j, d in table:
                if i == q and j != q:
                    best[j] = min(best.get(j, 99), sum(a != b for a, b in zip(c, d)))
        nearest = sorted((d, j) for j, d in best.items())[:7]
        assert got[q] == {n + 1: (j, d) for n, (d, j) in enumerate(nearest)}


def test_empty_vectors(llm):
    df = llm.createDataFrame([], "vec_id long, embedding array<double>")
    assert collision_search.nearest(df).count() == 0
    assert hamming_search.top_k(hamming_search.sign_codes(df)).count() == 0
