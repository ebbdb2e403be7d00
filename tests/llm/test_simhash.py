import random

import numpy as np
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.simhash import fingerprint, link_fingerprints, near_dedup, op1_simhash, segments, simhash_groups

SCHEMA = "doc_id long, text string, lang string, fp string, _th int"


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(items):
    """items: list of (doc_id, fp) -> component id per item."""
    fps = sorted({f for _, f in items})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                up[find(a)] = find(b)
    least = {}
    for d, f in items:
        r = find(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(f)) for _, f in items]


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "a", "A b", "one two three", "ONE two\x0bthree four", "\u00c9t\u00c9 \x1c x\u00a0y z w"]
    texts += [" ".join(rng.choice(["a", "B", "the", "fox", "x1"]) for _ in range(n)) for n in (4, 5, 17, 400)]
    for t in texts:
        assert fingerprint(None if t is None else t.encode()) == brute_fp(t), t


def test_links_equal_brute_force_on_cold_and_hot_paths(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    for f in list(fps)[:20] + [centre] * 60:
        for _ in range(2):
            x = f
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, 2**64 - 1}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    want = brute_components(list(zip(signed, fps)))
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    from loadkit.llm.common import connected_components
    for hot, segs in ((256, None), (0, None), (3, None), (256, segments(1 << 40, 4))):
        cc = {r.node: r.root for r in connected_components(link_fingerprints(frame, 4, hot, segs)).collect()}
        assert [cc.get(x, x) for x in signed] == want, (hot, segs)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    comp = brute_components([(r.doc_id, f) for r, f in zip(rows, fps)])
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comp)}
    got = op1_simhash(spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == want


def test_odd_rows(spark):
    rows = [(None, None, None, "x", 1), (7, "", None, None, 2), (5, "  ", None, None, 3), (9, "same text here now ok", None, None, 4),
            (9, "same text here now ok", None, None, 4), (8, "same text here now ok", None, None, 4), (1, "long " * 200_000, None, None, 5),
            (None, "lonely words in a row", None, None, 6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in simhash_groups(docs).collect()), key=str)
    assert got == sorted([(None, 5), (7, 5), (5, 5), (9, 8), (9, 8), (8, 8), (1, 1), (None, None)], key=str)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([5, 8, 1, None], key=str)
    empty = docs.filter(F.lit(False))
    assert simhash_groups(empty).count() == 0 and near_dedup(empty).count() == 0
    twice = docs.filter("doc_id = 9")
    assert near_dedup(twice).count() == 1


def test_no_fingerprint_goes_through_the_driver(spark, monkeypatch):
    """broadcasts planned from file sizes hold every fingerprint, point or edge; they outgrow the files."""
    from loadkit.llm import common, simhash
    plans = []

    def spied(df, name, cut=common.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)
    monkeypatch.setattr(common, "cut", spied)
    monkeypatch.setattr(simhash, "cut", spied)
    docs = spark.createDataFrame([(i, f"w{i // 3} " * 8, "en", "", 0) for i in range(60)], SCHEMA)
    got = near_dedup(docs)
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 60, 3))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    near = spark.createDataFrame([(0,), (1,), (3,), (7,), (1 << 40,)], "fp long")
    hot = link_fingerprints(near, 4, 1)
    assert hot.count() >= 4
    plans.append(hot._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not [p for p in plans if "Broadcast" in p]
