import math
import random

import duckdb
import numpy as np
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.embedding_dedup import OP11_SQL, Order, embedding_groups, near_pairs, op11_embedding_dedup, tails, unit

SCHEMA = "vec_id long, embedding array<double>, label int, v string, copies int"


def brute(rows):
    """rows: (vec_id, vector) -> sorted (vec_id, n_links, component_id, kept)."""
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            a, b = rows[i][1], rows[j][1]
            if fine(a) and fine(b) and len(a) == len(b):
                a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
                if a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    up[find(i)] = find(j)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((v, links[i], least.get(find(i)), v == least.get(find(i))) for i, (v, _) in enumerate(rows)), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(rng, n, dim):
    """Random vectors of decaying energy, a large group of near copies, chains of neighbours."""
    scale = 1 / np.sqrt(np.arange(1, dim + 1))
    out = [rng.normal(size=dim) * scale for _ in range(n)]
    centre = rng.normal(size=dim) * scale
    out += [centre + rng.normal(size=dim) * 0.05 * scale for _ in range(n // 3)]
    at = rng.normal(size=dim) * scale
    for _ in range(20):     # each near the one before, the ends far apart
        at = unit(at[None])[0] + unit(rng.normal(size=(1, dim)))[0] * 0.42
        out.append(at)
    out += [out[0].copy() for _ in range(5)]
    return [x.tolist() for x in out]


def test_near_pairs_keep_every_pair_that_reaches_the_threshold():
    rng = np.random.default_rng(3)
    x = unit(np.array(planted(rng, 600, 24)))
    for sample in (x, x[:30], rng.normal(size=(50, 24))):
        order = Order(unit(sample), 8)
        p = x @ order.axes
        got = {(i, j) for a, b, _ in near_pairs(p, p, order.cuts, 0.9, True) for i, j in zip(a.tolist(), b.tolist())}
        c = x @ x.T
        assert got >= {(i, j) for i, j in zip(*np.nonzero(np.triu(c >= 0.9, 1)))}
        assert got <= {(i, j) for i, j in zip(*np.nonzero(np.triu(c >= 0.9 - 1e-8, 1)))}
        assert np.allclose(tails(p, order.cuts[0]) ** 2 + (p[:, :order.cuts[0]] ** 2).sum(axis=1), 1)


def test_groups_equal_brute_force_whatever_the_tiles(spark):
    rng = np.random.default_rng(5)
    vecs = planted(rng, 150, 16)
    ids = list(range(1000, 1000 + len(vecs)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, vecs))
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    want = brute(rows)
    assert max(w[1] for w in want) >= 49
    for tile, sample in ((4096, 16_384), (16, 64)):
        got = embedding_groups(df, tile_rows=tile, sample_rows=sample)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert collected(got) == want, tile


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (9, [9.0, math.sqrt(19)]), (None, [1.0, 0.01]), (None, [0.0, -3.0]), (10, [1.0, 0.0, 0.0]), (11, [1e300, 1e290]),
            (12, [-0.0, 5.0]), (13, [0.0, 5.0]), (None, None)]
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in rows], SCHEMA)
    assert collected(embedding_groups(df)) == brute(rows)
    empty = df.filter(F.lit(False))
    assert embedding_groups(empty).count() == 0
    assert embedding_groups(df.filter("vec_id = 3")).collect()[0].n_links == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    want = sorted(con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({OP11_SQL})").fetchall(), key=str)
    assert collected(op11_embedding_dedup(spark, SMALL)) == want
    rng = np.random.default_rng(8)
    vecs = planted(rng, 60, 8)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [[i, v] for i, v in enumerate(vecs)])
    got = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({OP11_SQL})").fetchall()
    assert sorted(got, key=str) == brute(list(enumerate(vecs)))


def test_tiles_meet_without_a_shuffle(spark, monkeypatch):
    """Every tile meets every other one: shuffled copies grow with the square of the input."""
    from loadkit.llm import embedding_dedup as E
    seen = {}

    def kept(df, name):
        seen[name] = df
        return cut(df, name)
    cut = E.cut
    monkeypatch.setattr(E, "cut", kept)
    monkeypatch.setattr(E, "TOLD_ROWS", 40, raising=False)
    rng = np.random.default_rng(9)
    rows = list(enumerate(planted(rng, 90, 12)))
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    assert collected(embedding_groups(df, tile_rows=16, sample_rows=64)) == brute(rows)
    plan = seen["vector-links"]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
