import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loadkit.llm.toxicity import FEATURES, Lexicon, logistic, op9_toxicity, score


@pytest.mark.parametrize("text,hit", [
    ("You are an idiot.", {"direct", "targeted"}), ("What an idiot", {"direct"}), ("You are not an idiot.", {"negated"}),
    ("He said you are an idiot, and a moron.", {"reported"}), ("He said so. You idiot!", {"direct", "targeted"}),
    ("I will kill you", {"threat", "targeted_threat"}), ("We burn wood", {"threat"}), ("You and I.\nSuch a clown", {"direct"}),
    ("Idiotism is a word, you know", set()), ("", set()), (None, set()), ("not one of the many here is an idiot", {"direct"}),
])
def test_clauses(text, hit):
    got = Lexicon({}).features(text)
    assert {f for f, x in zip(FEATURES, got) if x} == hit


def test_learned_stems_match_beginnings_and_words():
    words = Lexicon({"lowei": 4.0, "=ab": 3.0})
    assert words.features("die loweian ist")[0] == pytest.approx(np.log1p(4.0))
    assert words.features("ab abc")[0] == pytest.approx(np.log1p(3.0))


def test_logistic_separates():
    x = np.array([[0.0], [0.2], [1.0], [1.5]])
    w = logistic(x, np.array([0, 0, 1, 1.0]), ridge=0.01)
    assert ((x @ w[:-1] + w[-1] > 0) == [False, False, True, True]).all()


def test_held_out_quality(spark):
    sf = SMALL.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op9_toxicity(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p for p, y in held if y)
    assert hit >= 0.9 * sum(y for _, y in held) and hit >= 0.95 * sum(p for p, _ in held)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in score(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_odd_rows(spark):
    rows = [(0, "you idiot"), (1, None), (2, ""), (3, "... !!"), (None, "you moron"), (1, "fine day"), (1, "fine day"), (4, "kind words " * 50_000 + "you scum.")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1, 1), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.filter(F.lit(False))):
        got = score(docs, given).collect()
        assert sorted((str(r.doc_id), r.predicted) for r in got) == sorted(
            [("0", 1), ("1", 0), ("2", 0), ("3", 0), ("None", 1), ("1", 0), ("1", 0), ("4", 1)])
    assert score(docs.filter(F.lit(False)), labels).count() == 0


def brute_features(text, learned):
    """The clause patterns told one by one, without automata."""
    from loadkit.llm.toxicity import INSULTS, NEGATIONS, REPORTS, TARGETS, THREATS
    sums, sentences, clause = dict.fromkeys(FEATURES, 0.0), [[[]]], None
    for word in (text or "").replace("\n", " . ").split():
        sentences[-1][-1].append(word)
        if word.rstrip("\"'”»)")[-1:] in tuple(".!?…"):
            sentences.append([[]])
        elif word[-1] in ",;:":
            sentences[-1].append([])
    for sentence in sentences:
        reported = False
        for clause in sentence:
            core = [w.strip("\"'“”«»()[]*_~|.,;:!?…").lower() for w in clause]
            weight, insult, threat, target = 0.0, False, False, False
            for i, w in enumerate(core):
                reported |= w in REPORTS
                target |= w in TARGETS and w not in INSULTS + THREATS
                own = 5.0 if w in INSULTS + THREATS else 0.0
                if w not in NEGATIONS + TARGETS + REPORTS:
                    own = max(own, learned.get("=" + w, 0.0), *(learned.get(w[:k], 0.0) for k in (3, 4, 5, 6, 7) if len(w) >= k), 0.0)
                if own:
                    threat |= w in THREATS
                    insult |= w not in THREATS
                    if any(x in NEGATIONS for x in core[max(0, i - 3):i]):
                        sums["negated"] += own
                    else:
                        weight += own
            for name, hit in (("reported", reported), ("direct", not reported and insult), ("targeted", not reported and insult and target),
                              ("threat", not reported and threat), ("targeted_threat", not reported and threat and target)):
                sums[name] += weight * hit
    return [np.log1p(sums[f]) for f in FEATURES]


def test_clauses_equal_brute_force():
    import random
    rng = random.Random(6)
    learned = {"zorg": 3.5, "=blob": 2.0}
    vocabulary = ["idiot", "Moron", "kill", "you", "him", "not", "never", "said", "the", "house", "zorgan", "blob", "blobs", "nobody", "claims", "and", "\n"]
    words = Lexicon(learned)
    for _ in range(3000):
        text = " ".join(rng.choice(["", "", "\"", "("]) + rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ".", "!", ";", ".\"", "?)"])
                        for _ in range(rng.randint(0, 25)))
        assert np.allclose(words.features(text), brute_features(text, learned)), text


def test_negated_and_reported_insults_score_apart(spark):
    """The grammar decides: the same insults, direct in toxic texts, negated or reported in others."""
    import random
    rng = random.Random(9)
    filler = "the house was old and we went along the river to see it again".split()
    frames = {1: ["you are a {}", "what a {} you are", "you {}"], 0: ["he said they are a {}", "you are not a {}", "she wrote that you are a {}"]}
    docs, labels = [], []
    for i in range(600):
        kind = i % 2
        insult = rng.choice(["idiot", "moron", "loser", "clown"])
        docs.append((i, " ".join(rng.choices(filler, k=30)) + ". " + rng.choice(frames[kind]).format(insult) + ". " + " ".join(rng.choices(filler, k=20))))
        labels.append((i, kind))
    got = score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 80 and sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held)
