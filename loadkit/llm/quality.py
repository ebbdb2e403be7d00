"""Quality rules: hashed n-gram log-likelihood ratio (operator 3).

Word 1- and 2-grams are hashed into buckets. Two multinomials over the buckets are
estimated: the trusted target, from a bounded sample of documents labelled good,
and the raw corpus, from all documents; the raw one is brought to the target's size
and ``SMOOTHING`` counts are added to both, so that buckets too rare to tell say
little. A document's score is the summed log ratio target / raw of its n-grams over
their number plus ``SHRINK`` (so that a few words decide nothing). The threshold is
the point with the fewest errors between the scores of labelled documents that the
target has not seen (a quarter of the good, all bad of the sample), a good document
lost counting ``GOOD_WEIGHT`` times; every document below it is rejected, as is one
that fails the base rules.

Defined results: NULL is a text without words and fails the base rules; without
labels of both kinds the base rules alone decide; a label is the least of its
document's labels, and a NULL label is none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from loadkit.llm.common import cut, map_slices, slices, table, text_rows, utf8

BUCKET_BITS = 17          # per n-gram order
SAMPLE_DOCS = 4000        # labelled documents of each kind, those of least hash
GOOD_WEIGHT = 20
SMOOTHING = 1.0
SHRINK = 20
MIN_WORDS = 20
WINDOW = 8
REPEAT_SHARE = 30         # per cent of words
SYMBOLS = b"#*$%&|<>"
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def buckets(h: np.ndarray) -> np.ndarray:
    """Bucket of every 1-gram, then of every 2-gram (in a range of its own)."""
    down = np.uint64(64 - BUCKET_BITS)
    pairs = (h[:-1] * MIX + h[1:] * MIX2) >> down
    return np.concatenate([h >> down, pairs + np.uint64(1 << BUCKET_BITS)]).astype(np.int64)


def repeated_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    w = np.zeros(n, np.uint64)
    for k in range(window):
        w = w * MIX + h[k:k + n]
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_columns(text: bytes, words: list[bytes], h: np.ndarray) -> tuple[int, int, int, int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(h))


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > REPEAT_SHARE * n_words


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """N-gram counts of all texts by bucket: each task sums its own, Spark the tasks'."""
    def run(batches):
        total = np.zeros(2 << BUCKET_BITS, np.int64)
        for batch in slices(batches):
            found = [buckets(word_hashes(t.split())) for t in utf8(batch) if t]
            if found:
                total += np.bincount(np.concatenate(found), minlength=len(total))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], ["bucket", "n"])
    out = np.zeros(2 << BUCKET_BITS, np.float64)
    got = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()   # at most one row a bucket
    return out


def labelled(labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``sample_docs`` ids of each quality, 0 and 1."""
    one = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("good"))
           .filter("id is not null and good in (0, 1)").groupBy("id").agg(F.min("good").alias("good")))
    return (one.filter("good = 1").orderBy(F.xxhash64("id"), "id").limit(sample_docs)
            .unionByName(one.filter("good = 0").orderBy(F.xxhash64("id"), "id").limit(sample_docs)))


class Scorer:
    """Log ratios per bucket and the threshold below which a document goes."""

    def __init__(self, ratio: np.ndarray, threshold: float = -np.inf):
        self.ratio, self.threshold = ratio, threshold

    def score(self, h: np.ndarray) -> float:
        b = buckets(h)
        return float(self.ratio[b].sum(dtype=np.float64) / (len(b) + SHRINK))

    def judge(self, text: bytes | None) -> tuple:
        text = text or b""
        words = text.split()
        h = word_hashes(words)
        base = base_columns(text, words, h)
        failed = base_fails(base[0], base[4])
        score = self.score(h)
        return (*base, failed, not failed and score >= self.threshold, score)


def best_threshold(good: list[float], bad: list[float]) -> float:
    """Middle of the gap between scores with the least weighted errors."""
    if not good or not bad:
        return -np.inf
    marks = sorted({*good, *bad})
    g, b = np.sort(good), np.sort(bad)
    edges = np.array([marks[0] - 1e-9, *((x + y) / 2 for x, y in zip(marks, marks[1:]))])
    errors = GOOD_WEIGHT * np.searchsorted(g, edges) + len(b) - np.searchsorted(b, edges)
    best = np.flatnonzero(errors == errors.min())
    return float(edges[best[len(best) // 2]])


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Scorer:
    marks = labelled(labels, sample_docs)   # bounded: 2 * sample_docs rows
    texts = text_rows(docs)
    known = cut(texts.join(F.broadcast(marks), texts["doc_id"] == marks["id"]).select("doc_id", "good", "text"), "quality-sample")
    raw = bucket_counts(texts)
    learn = F.expr("good = 1 and pmod(xxhash64(doc_id, 1), 4) <> 0")   # the others set the threshold
    target = bucket_counts(known.filter(learn))
    ratio = np.zeros(len(raw))
    for part in (slice(0, 1 << BUCKET_BITS), slice(1 << BUCKET_BITS, None)):
        expected = raw[part] * (target[part].sum() / max(raw[part].sum(), 1))
        ratio[part] = np.log((target[part] + SMOOTHING) / (expected + SMOOTHING))
    scorer = Scorer(ratio.astype(np.float32))

    def make():
        def one(batch):
            got = [scorer.judge(t) for t in utf8(batch)]
            return pa.RecordBatch.from_arrays([batch.column("good"), pa.array([g[5] for g in got], pa.bool_()),
                                               pa.array([g[-1] for g in got], pa.float64())], ["good", "failed", "score"])
        return one
    rest = known.filter(~learn)
    rows = [r for r in map_slices(rest.select("good", "text"), make, "good int, failed boolean, score double").collect() if not r.failed]
    scorer.threshold = best_threshold([r.score for r in rows if r.good], [r.score for r in rows if not r.good])
    return scorer


def judge(docs: DataFrame, scorer: Scorer) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]

    def make():
        def one(batch):
            got = list(zip(*[scorer.judge(t) for t in utf8(batch)])) or [()] * len(names)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(got, kinds))],
                                              ["doc_id", *names])
        return one
    return map_slices(text_rows(docs), make, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                      "n_repeat_words long, base_failed boolean, kept boolean, score double")


def quality_filter(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are."""
    scorer, at = fit(docs, labels, sample_docs), docs.columns.index("text")

    def make():
        def one(batch):
            texts = batch.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()
            return batch.filter(pa.array([scorer.judge(t)[6] for t in texts], pa.bool_()))
        return one
    return map_slices(docs, make, docs.schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
