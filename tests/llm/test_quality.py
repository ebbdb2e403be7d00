import random
import re

from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.quality import best_threshold, fit, judge, op3_quality_rules, quality_filter


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, by the definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_columns_and_labels(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op3_quality_rules(spark, sf)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rows = got.collect()
    assert len(rows) == len(docs)
    right = {0: [], 1: []}
    for r in rows:
        n = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r.kept and r.base_failed)
        if r.doc_id in labels and not r.base_failed:
            right[labels[r.doc_id]].append(r.kept == bool(labels[r.doc_id]))
    assert sum(right[1]) >= 0.98 * len(right[1])


def test_rejects_new_junk_and_keeps_new_clean_text(spark):
    """Fitted with half of the labels, asked on the other half."""
    sf = SMALL.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scorer = fit(docs, labels.filter("doc_id % 2 = 0"))
    odd = labels.filter("doc_id % 2 = 1").withColumnRenamed("doc_id", "id")
    rows = judge(docs, scorer).join(odd, F.col("doc_id") == F.col("id")).filter("not base_failed").collect()
    for quality, share in ((1, 0.99), (0, 0.95)):
        of = [r for r in rows if r.quality == quality]
        assert sum(r.kept == bool(quality) for r in of) >= share * len(of), quality


def test_threshold():
    assert best_threshold([1.0, 2.0], [-2.0, -1.0]) == 0.0
    assert best_threshold([], [1.0]) == best_threshold([1.0], []) == float("-inf")
    assert best_threshold([0.0, 5.0], [1.0]) < 0.0   # losing a good one costs more


def test_odd_rows(spark):
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.random())[2:5] for _ in range(n))
    good = [(i, words(40)) for i in range(30)]
    rows = good + [(100, None), (101, ""), (102, "a\x1cb " * 50_000), (103, words(90_000)), (None, words(30)), (1, good[1][1])]
    docs = spark.createDataFrame([(d, t, True, "q") for d, t in rows], "doc_id long, text string, kept boolean, good string")
    labels = spark.createDataFrame([(i, 1, None) for i in range(20)] + [(100, 0, 0), (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    got = judge(docs, fit(docs, labels)).collect()
    assert len(got) == len(rows)
    for r, t in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_words)), sorted(rows, key=lambda r: (str(r[0]), brute(r[1])[0]))):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t[1])
    kept = quality_filter(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {*range(30), 103, None} and kept.count() == 33
    none = labels.filter(F.lit(False))
    assert quality_filter(docs, none).count() == 33
    assert judge(docs.filter(F.lit(False)), fit(docs.filter(F.lit(False)), none)).count() == 0
