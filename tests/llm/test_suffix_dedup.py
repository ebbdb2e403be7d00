import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.suffix_dedup import factors, op10_suffix_dedup, prefix_ranks, remove_repeats, text_runs


def brute(rows, length, keep_first=False):
    """rows: (doc_id, bytes) in corpus order -> (n_bytes, n_removed, n_spans, sha256) of each."""
    counts = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    seen, out = set(), []
    for _, t in rows:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            if (w in seen) if keep_first else counts[w] > 1:
                cover[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, x in zip(t, cover) if not x)
        n = sum(1 for i, x in enumerate(cover) if x and (i == 0 or not cover[i - 1]))
        out.append((len(t), len(t) - len(kept), n, hashlib.sha256(kept).hexdigest()))
    return out


def hostile(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(12) for _ in range(4)] + ["x" * 90, "ab" * 60, "the end. " * 12]
    out = []
    for _ in range(n):
        parts = [prose(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 8):len(p) - rng.randint(0, 8)], prose(rng.randint(0, 12))]
        out.append("".join(parts))
    return out + [out[3], out[3], out[5][:-1], "", "q" * 500, "q" * 300]


def test_runs_own_every_window_once_and_alike():
    t = hostile(1)[0].encode() * 3 + b"z" * 200
    first, n, owner, _ = text_runs(t, 40, 8)
    assert first[0] == 0 and (first[1:] == first[:-1] + n[:-1]).all() and first[-1] + n[-1] == len(t) - 39
    of = np.repeat(owner, n)
    by = {}
    for i in range(len(t) - 39):
        assert by.setdefault(t[i:i + 40], of[i]) == of[i]


def test_factors_are_the_definition():
    t = b"abracadabra abracadabra cadabra"
    at = np.arange(len(t) - 11)
    before, after = factors(prefix_ranks(np.frombuffer(t, np.uint8), at, 11))
    for i in at:
        assert before[i] == any(t[j:j + 11] == t[i:i + 11] for j in range(i))
        assert after[i] == any(t[j:j + 11] == t[i:i + 11] for j in range(i + 1, len(t) - 10))


@pytest.mark.parametrize("hot,keep_first", [(10_000, False), (1, False), (10_000, True), (1, True)])
def test_against_brute_force(spark, hot, keep_first):
    rows = list(enumerate(x.encode() for x in hostile(2)))
    docs = spark.createDataFrame([(d, t.decode(), 1) for d, t in rows], "doc_id long, text string, spans int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in remove_repeats(docs, 40, keep_first, gram=8, hot_blocks=hot).collect()}
    for (d, t), w in zip(rows, brute(rows, 40, keep_first)):
        assert got[d] == w, (d, t)


def test_query(spark):
    rows = sorted((r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = {(d, *w) for (d, _), w in zip(rows, brute(rows, 200))}
    got = op10_suffix_dedup(spark, SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {tuple(r) for r in got.collect()} == want


def test_odd_rows(spark):
    long = "".join(random.Random(3).choices("abcdefghij ", k=60_000))
    rows = [(None, None), (None, long), (1, ""), (2, "short"), (3, long[100:]), (4, "twice " * 40), (4, "twice " * 40), (4, "other " + "y" * 150)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, t string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept.decode()) for r in remove_repeats(docs).collect()), key=str)
    want = [(None, 0, 0, 0, ""), (None, 60_000, 59_900, 1, long[:100]), (1, 0, 0, 0, ""), (2, 5, 0, 0, "short"), (3, 59_900, 59_900, 1, ""),
            (4, 240, 240, 1, ""), (4, 240, 240, 1, ""), (4, 156, 0, 0, "other " + "y" * 150)]
    assert got == sorted(want, key=str)
    assert remove_repeats(docs.filter(F.lit(False))).count() == 0
