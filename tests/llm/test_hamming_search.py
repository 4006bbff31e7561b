import random

import duckdb
import pytest

from locusweave.llm import hamming_search as S
from locusweave.llm import queries

from .conftest import DATA, needs_data


def brute(rows, k):
    rows = sorted({(i, S_code(v)) for i, v in rows if i is not None and v is not None})
    out = []
    for q, code in rows:
        if q % 100 == 0:
            near = sorted((bin(code ^ other).count("1"), i) for i, other in rows if i != q)[:k]
            out += [(q, i, d, rank + 1) for rank, (d, i) in enumerate(near)]
    return sorted(out)


def S_code(vector):
    return sum(1 << i for i, x in enumerate(vector[:64]) if x is not None and x > 0)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS code", "2 AS rank", "'x' AS query")


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_neighbours_agree_with_brute_force(spark, spread):
    draw = random.Random(2)
    centres = [[draw.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [c + draw.gauss(0, spread) for c in draw.choice(centres)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(120)]  # a hot code
    rows += [(None, rows[1][1]), (2000, None), (2100, []), (2200, [None, 1.0]), (700, rows[7][1]), (700, rows[7][1]), (2300, [1.0] * 80)]
    assert sorted(map(tuple, S.top_k(table(spark, rows), 10).collect())) == brute(rows, 10)


def test_ids_with_several_near_vectors(spark):
    draw = random.Random(5)
    centre = [draw.gauss(0, 1) for _ in range(64)]
    near = lambda flips: [-c if i in flips else c for i, c in enumerate(centre)]
    rows = [(100, near({i})) for i in range(20)] + [(200, near({i, i + 1})) for i in range(6)] + [(300, centre), (300, centre)]
    rows += [(i, near(set(draw.sample(range(64), 3 + i % 20)))) for i in range(401, 500)] + [(7, near({3})), (8, near({3})), (9, near({5})), (9, [2 * x for x in near({5})])]
    rows += [(500, near({1, 2, 3})), (500, [2 * x for x in near({1, 2, 3})])]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = con.execute(f"SELECT query_id, neighbor_id, distance, rank FROM ({queries.SQL['op9_top_k_search']})").fetchall()
    assert sorted(map(tuple, S.top_k(table(spark, rows), 10).collect())) == sorted(want)


def test_few_rows(spark):
    assert S.top_k(table(spark, [])).count() == 0
    assert S.top_k(table(spark, [(100, [1.0])])).count() == 0
    assert [tuple(r) for r in S.top_k(table(spark, [(100, [1.0]), (7, [-1.0])])).collect()] == [(100, 7, 1, 1)]


@needs_data
def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = con.execute(f"SELECT query_id, neighbor_id, distance, rank FROM ({queries.SQL['op9_top_k_search']})").fetchall()
    assert sorted(want) == sorted(map(tuple, queries.op9_top_k_search(spark, DATA).collect()))
