import math
import random
import re
from collections import Counter

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import loadkit.llm.lexical_search as ls
from loadkit.llm.lexical_search import OP13_SQL, op13_lexical_search, search

DOCS, ITEMS = "doc_id long, text string, score int, block string, term int", "item_id long, text string, rank int, place string"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=10):
    ts = [TERM.findall((t or "").translate(LOW)) for _, t in docs]
    n_docs, total = sum(bool(t) for t in ts), sum(map(len, ts))
    df, tf = Counter(w for t in ts for w in set(t)), [Counter(t) for t in ts]
    out = []
    for item_id, text in {tuple(i) for i in items}:
        want = set(TERM.findall((text or "").translate(LOW)))
        scored = []
        for (d, _), c, t in zip(docs, tf, ts):
            m = 100 - 90 + (90 * len(t) * n_docs) // total if t else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in want if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item_id, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms():
    text = "CafÉ naïve x, A1-b2_c3 D\x7fe \U0001f600\x00Z"
    assert [t.decode() for t in ls.terms_of(text.encode())] == TERM.findall(text.translate(LOW))
    assert ls.terms_of(None) == ls.terms_of(b"") == ls.terms_of(b" .,-") == []


def test_query_against_sql_and_brute_force(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = op13_lexical_search(spark, SMALL)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    got = collected(got)
    assert got == sorted(con.execute(OP13_SQL).fetchall(), key=str)
    rows = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(*c).collect()]
    assert got == brute(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))


@pytest.mark.parametrize("owners, block, bundle, rows", [(1, 8192, 256, 10), (4, 16, 256, 200_000), (7, 8, 4, 10)])
def test_pruning_loses_nothing(spark, monkeypatch, owners, block, bundle, rows):
    """Small blocks and bundles, many stages: every limit and opening rule is in play."""
    monkeypatch.setattr(ls, "BLOCK_DOCS", block)
    monkeypatch.setattr(ls, "BUNDLE_ITEMS", bundle)
    monkeypatch.setattr(ls, "BROADCAST_ROWS", rows)
    rng = random.Random(owners)
    vocab = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([3, 9, 40, 300])))) for i in range(240)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]      # a large group of ties
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 12])))) for i in range(18)] + [(99, docs[7][1][:300])]
    got = search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), owners=owners)
    assert collected(got) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(None, "alpha beta", 1, "x", 1), (1, None, 1, "x", 1), (2, "", 1, None, 1), (3, " .;", 1, None, 1), (4, "alpha beta", 1, None, 1),
            (4, "alpha beta", 1, None, 1), (5, "ALPHA gamma " * 100_000, 1, None, 1), (6, "delta Été", 1, None, 1)]
    docs += [(10 + i, "filler words", 1, None, 1) for i in range(20)]
    items = [(1, "Alpha alpha", 1, "x"), (1, "beta", 1, "x"), (2, None, 1, "x"), (None, "Été", 1, "x"), (3, "unknown", 1, "x"), (1, "beta", 1, "x"), (4, "", 1, "x"),
             (5, "filler", 1, "x")]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert collected(search(d, i)) == brute([r[:2] for r in docs], [r[:2] for r in items])
    assert search(d.filter(F.lit(False)), i).count() == 0
    assert search(d, i.filter(F.lit(False))).count() == 0
