import random

import numpy as np
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.decontaminate import Block, drop_leaks, item_passages, lcs, leaks, op5_decontamination, words_of


def test_lcs():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert lcs(a, b) == t[-1][-1]


def test_passages():
    assert item_passages(None) == item_passages(" . ") == []
    assert item_passages("One two. Three") == [(["one", "two", "three"], 3)]
    parts = item_passages(" ".join(f"w{i}" for i in range(100)))
    assert [len(p) for p, _ in parts] == [34, 34, 32] and [a for _, a in parts] == [0, 0, 32]


def _fitted(rng, n_items=12, n_words=20, vocabulary=60):
    block = Block([(i, " ".join(f"t{rng.integers(vocabulary)}" for _ in range(n_words))) for i in range(n_items)])
    block.idf = np.r_[0, rng.uniform(1, 3, block.size - 1)].astype(np.float32)
    a = rng.standard_normal((50, 3)) @ rng.standard_normal((3, block.size)) * (block.idf > 0)
    w = rng.standard_normal((block.size, 10))
    w[0] = 0
    block.fit(a.T @ (a @ w), w)
    return block, a


def test_latent_space_has_the_corpus_singular_vectors_and_the_items():
    rng = np.random.default_rng(3)
    block, a = _fitted(rng, 4)
    _, sizes, top = np.linalg.svd(a)
    assert np.allclose(block.spread[:3], sizes[:3], rtol=1e-6)
    assert np.allclose(np.abs((top[:3] @ block.leading[:, :3]).diagonal()), 1, atol=1e-6)
    # more dimensions than passages: products in the space are those of the vectors
    p, w, x = block.rows(np.where(block.idf < 1, 0, block.idf))
    m = np.zeros((4, block.size))
    m[p, w] = x
    assert np.allclose(block.queries @ block.queries.T, (m @ m.T) / np.outer(*[np.linalg.norm(m, axis=1)] * 2), atol=1e-4)


def test_a_truncated_space_is_the_one_its_singular_vectors_span(monkeypatch):
    import loadkit.llm.decontaminate as d
    monkeypatch.setattr(d, "ITEM_RANK", 5)
    block, _ = _fitted(np.random.default_rng(8), 30)
    p, w, x = block.rows(block.idf.astype(float))
    m = np.zeros((30, block.size))
    m[p, w] = x
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    own = np.linalg.svd(m)[2][:5]
    basis = np.linalg.svd(np.hstack([block.leading, own.T]), full_matrices=False)[0]
    assert block.adds.shape[1] == basis.shape[1] == block.leading.shape[1] + 5 < 30
    q = m @ basis
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    assert np.allclose(block.queries @ block.queries.T, q @ q.T, atol=1e-4)


def test_cosines_and_energies_equal_brute_force():
    rng = np.random.default_rng(4)
    block, _ = _fitted(rng)
    docs = [rng.integers(0, block.size, n).astype(block.kind) for n in (0, 5, 32, 33, 64, 65, 300, 31)]
    docs[6][100:120] = block.words[3]
    docs[4][20:40] = block.words[7]
    rows = list(zip(*(x.tolist() for x in block.candidates(docs))))
    assert {(6, 3), (4, 7)} <= {(d, p) for d, _, p, _ in rows}
    want = {}
    for d, ids in enumerate(docs):
        for at in range(0, max(1, len(ids) - 32), 32):
            parts = [ids[at:at + 32], ids[at + 32:at + 64]]
            place = block.adds[np.concatenate(parts).astype(int)].sum(axis=0) if len(ids) else np.zeros(block.adds.shape[1])
            cos = block.queries @ place / max(np.linalg.norm(place), 1e-9)
            for p in range(len(block.words)):
                own = {int(w): float(block.energy[k]) for w in range(block.size) for k in range(block.start[w], block.start[w + 1]) if block.posted[k] == p}
                energy = sum(own.get(int(w), 0) for part in parts for w in set(part.tolist()))
                if len(ids) and (energy >= 0.5 * block.need[p] or cos[p] >= 0.3 and energy >= 0.25 * block.need[p]):
                    want[d, at, p] = cos[p]
    assert {r[:3] for r in rows} == set(want)
    assert all(abs(want[r[:3]] - r[3]) < 1e-4 for r in rows)
    whole = block.search(docs)
    assert {(d, i) for d, i, *_ in whole} == {(6, 3), (4, 7)} == {(d, i) for k, x in enumerate(docs) for d, i, *_ in [(k, *r[1:]) for r in block.search([x])]}


def test_paraphrases_and_spread_items_are_found(spark):
    import random
    sf = SMALL.replace("0.001", "0.01")
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rng, filler = random.Random(5), words_of(" ".join(texts[:50]))

    def edited(words, rate):
        out = []
        for w in words:
            r = rng.random() / rate if rate else 9
            out += [] if r < 1 / 3 else [rng.choice(filler)] if r < 2 / 3 else [w, rng.choice(filler)] if r < 1 else [w]
        return out

    def hosted(words):
        host = words_of(rng.choice(texts))
        at = rng.randrange(len(host) + 1)
        return " ".join(host[max(0, at - 200):at] + words + host[at:at + 200])
    spread = [(i, [x for w in words_of(t)[:48] for x in (w, rng.choice(filler))]) for i, t in items if len(words_of(t)) <= 48]
    made = [(i, 0, hosted(edited(words_of(t), 0.2))) for i, t in items for _ in range(3)] + [(i, 1, hosted(w)) for i, w in spread]
    rows = [(k, t) for k, (_, _, t) in enumerate(made)] + [(10_000 + k, t) for k, t in enumerate(texts)]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                                 spark.createDataFrame(items, "item_id long, text string")).collect()}
    for kind in (0, 1):
        own = [(k, i) for k, (i, kd, _) in enumerate(made) if kd == kind]
        assert sum(x in got for x in own) >= 0.9 * len(own), kind


def test_query_finds_every_document_that_holds_an_item(spark):
    sf = SMALL.replace("0.001", "0.1")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    import ahocorasick
    whole = ahocorasick.Automaton()
    for i, t in items.items():
        whole.add_word(t, i)
    whole.make_automaton()
    want = {(d, i) for d, t in docs.items() for _, i in whole.iter(t)}
    got = {(r.doc_id, r.item_id): r for r in op5_decontamination(spark, sf).collect()}
    assert want <= {*got}
    parts = {i: {tuple(words_of(t)[k:k + 5]) for k in range(len(words_of(t)) - 4)} for i, t in items.items()}
    for d, i in {*got} - want:      # what else is found shares much of the item's own wording
        text = words_of(docs[d])
        assert len(parts[i] & {tuple(text[k:k + 5]) for k in range(len(text) - 4)}) >= 0.3 * len(parts[i]), (d, i)


def test_paraphrases_answers_and_odd_rows(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    q, a = prose(30), prose(10)
    item = " ".join(q) + ". " + " ".join(a) + "."
    edited = [w if i % 3 else "changed" for i, w in enumerate(q)]
    docs = [(1, " ".join(prose(200) + q + a + prose(100))), (2, " ".join(prose(77) + edited + a + prose(40))), (3, " ".join(prose(50) + edited + prose(60))),
            (4, " ".join(prose(300))), (5, " ".join(prose(10) + a)), (6, "Only TINY\nitem here"), (7, "only the tiny item"), (None, item), (8, None), (8, ""),
            (1, "clean row with the same id"), (9, " ".join(prose(60_000) + q + a)), (9, item), (9, item)]
    frame = spark.createDataFrame([(*d, 0.1) for d in docs], "doc_id long, text string, cosine double")
    bench = spark.createDataFrame([(10, item, 1), (11, "only tiny item", 1), (12, None, 1), (13, " ", 1), (None, "x", 1), (14, " ".join(prose(150)), 1)],
                                  "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id) for r in leaks(frame, bench).collect()), key=str)
    assert got == sorted([(1, 10), (2, 10), (6, 11), (None, 10), (9, 10), (9, 10), (9, 10)], key=str)
    left = drop_leaks(frame, bench)
    assert left.schema == frame.schema
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 7, 8, 8]
    assert drop_leaks(frame, bench.filter(F.lit(False))).count() == len(docs)
    assert leaks(frame.filter(F.lit(False)), bench).count() == 0


def test_items_among_words_of_the_benchmark_are_found(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(2000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [prose(n) for n in (1, 2, 3, 5, 7, 8, 10, 15, 20, 48) for _ in range(4)]
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(1000 + i, " ".join(vocabulary[i:i + 40])) for i in range(0, 2000, 40)]
    docs = [(i, " ".join(prose(90 + i) + x + prose(100))) for i, x in enumerate(items)]   # every word is the benchmark's
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                spark.createDataFrame(bench, "item_id long, text string")).collect()}
    text = {d: f" {t} " for d, t in docs}
    whole = {(d, i) for d in text for i, t in bench if f" {t} " in text[d]}
    assert whole >= {(i, i) for i in text} and whole <= got
    assert all(len(items[i]) >= 8 for _, i in got - whole if i < 1000)
