import random
import re
import zlib
from collections import Counter

from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.spelling import neighbours, op12_spelling_variants, rotations, spelling_variants, word_counts

SCHEMA = "doc_id long, text string, word string, n int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words):
    close = {w: [] for w in words}
    drop = {}
    for w in words:
        for i in range(len(w)):
            for gap in (w[:i] + "?" + w[i + 1:], w[:i] + w[i + 1:]):
                drop.setdefault(gap, set()).add(w)
        drop.setdefault(w, set()).add(w)
    for group in drop.values():     # candidates, judged by the definition
        for a in group:
            close[a] += [b for b in group if b not in close[a] and near(a, b)]
    form = {}
    for w, ks in close.items():
        if ks:
            best = min(ks, key=lambda k: (-words[k], k))
            if words[best] >= 5 * words[w]:
                form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], len(close[w]), words.get(form.get(w))))
    return out


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = op12_spelling_variants(spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {tuple(r) for r in got.collect()}
    assert got == brute(brute_words([(r.doc_id, r.text) for r in rows]))
    assert sum(r[1] is not None for r in got) > 0


def test_neighbours_of_random_words(spark):
    rng = random.Random(4)
    words = {}
    while len(words) < 700:
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        words[w] = rng.choice([5, 6, 30, 31, 200, 1200])
    words |= {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "aaaaaaaaa": 1200}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {r[0]: r[4] for r in brute(words) if r[4]}
    got = neighbours(df).collect()
    assert {r.word: r.n_near for r in got} == want
    groups = rotations(df).groupBy("prefix").count().agg(F.max("count")).first()[0]
    assert groups <= 4      # three letters and the whole rotation
    text = " ".join(w for w, n in words.items() for _ in range(n))
    docs = spark.createDataFrame([(1, text, "x", 3)], SCHEMA)
    assert {tuple(r) for r in spelling_variants(docs).collect()} == brute(brute_words([(1, text)]))


def test_chains_end_at_their_last_form(spark):
    text = " ".join(["wordaa"] * 5 + ["wordab"] * 25 + ["wordbb"] * 125 + ["wordbbb"] * 625 + ["lonely"] * 7)
    docs = spark.createDataFrame([(None, text, None, None)], SCHEMA)
    got = {r.word: (r.form, r.root) for r in spelling_variants(docs).collect()}
    want = {r[0]: (r[1], r[2]) for r in brute(brute_words([(None, text)]))}
    assert got == want
    assert {v[1] for k, v in got.items() if k != "lonely" and len(k) >= 6} == {"wordbbb"}


def test_odd_rows(spark):
    rows = [(None, None, "x", 1), (1, "", "x", 1), (2, "short words only here", None, None), (3, "ÉtÉÉtÉ " * 6, None, None),
            (4, "abcdef× " * 5, None, None), (4, "abcdef× " * 5, None, None), (5, "REPEATED " * 60_000, None, None), (None, "repeatd " * 9, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute_words([r[:2] for r in rows])
    assert {r.word: r.n for r in word_counts(docs).collect()} == want
    assert {tuple(r) for r in spelling_variants(docs).collect()} == brute(want)
    assert spelling_variants(docs.filter(F.lit(False))).count() == 0
