import zlib

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import loadkit.llm.langid as langid
from loadkit.llm.langid import CrossParser, identify, op2_language_id

TEXTS = {"aa": ["the cat sat on the mat", "a dog and a cat"], "bb": ["der hund und die katze", "ein haus über dem see"]}


def naive(parser, text, lang):
    """Greedy longest matches by plain substring search, over the whole text."""
    sample = [parser.encode(t).tolist() for t in TEXTS[lang]]
    found = lambda x: any(x == s[i:i + len(x)] for s in sample for i in range(len(s) - len(x) + 1))
    symbols, n = parser.encode(text).tolist(), 0
    i = 0
    while i < len(symbols):
        k = 1
        while i + k < len(symbols) and found(symbols[i:i + k + 1]):
            k += 1
        n, i = n + 1, i + k
    return n


@pytest.mark.parametrize("block", [1, 3, 16, 256])
def test_phrases_equal_plain_search(monkeypatch, block):
    """Whatever the block: a phrase goes on over its end."""
    monkeypatch.setattr(langid, "BLOCK", block)
    parser = CrossParser(TEXTS)
    texts = ["the cat", "katze und hund", "xyz", "the dog über 12 the see", "cat sat on the " * 40, "你好 cat", "", "the cat sat on the mat a dog and a cat der hund und die katze " * 5]
    got = parser.phrases([parser.encode(t) for t in texts])
    for t, row in zip(texts, got):
        assert [naive(parser, t, lang) for lang in parser.langs] == row.tolist(), t


def test_held_out_accuracy_and_columns(spark):
    sf = SMALL.replace("0.001", "0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_language_id(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_predictions_ignore_labels_and_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ours = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs).collect()}
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in identify(other).collect()} == ours


def test_odd_rows(spark):
    rows = [(0, "the cat sat", "aa"), (2, "der hund und", "bb"), (3, None, "aa"), (4, "", None), (5, "12 !?", "bb"), (None, "the cat", "cc"),
            (6, "the cat sat " * 20_000, None), (6, "the cat sat", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    got = {(r.doc_id, r.lang_pred) for r in identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (6, "aa"), (None, "aa")} <= got
    assert identify(docs).count() == len(rows)
    none = identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert identify(docs.filter(F.lit(False))).count() == 0


def test_texts_are_learned_from_their_first_letter_on(spark):
    rows = [(i, "0123456789 " * 200 + t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "aa"), ("der hund und die katze", "bb")] * 6)]
    rows += [(100, "the cat on the mat", None), (101, "die katze und der hund", None)]
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100] == "aa" and got[101] == "bb"
