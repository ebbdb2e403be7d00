"""Toxicity by a weighted finite-state pattern grammar (operator 9).

A word is read as one symbol: insult, threat, target, negation, reported speech or
other, with the end of clause or sentence that follows it. Five small automata (an
insult was met, a threat was met, a target was met, how long a negation still
reaches, whether the sentence reports speech) are composed into one table; at the
end of each clause it names the clause's pattern, and the clause's insults and
threats add their weights to that pattern. A document is scored from its patterns,
not from its words: direct attacks, attacks on a target, negated and reported ones
have weights of their own, fitted by logistic regression.

The insult transducer's word stems are learned: whole words and word beginnings that
toxic documents of a bounded labelled sample have and others do not, weighted by
their log odds, beside the fixed lists below. Only rows whose id's CRC-32 modulo 5
is not 0 are learned from.

Defined results: NULL, empty and wordless texts have no clause and score as any text
without a match; with no labels of both kinds fixed weights are used; a document's
label is the largest of its labels.
"""

from __future__ import annotations

from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm.common import cut, map_slices, slices, table, text_rows

SAMPLE_DOCS = 4000          # labelled documents of each kind, those of least hash
STEM_LETTERS = (3, 4, 5, 6, 7)
LEAST_EVIDENCE = 20.0       # log-likelihood ratio statistic of a learned stem
IMPURITY = 1.0              # its clean documents for each toxic one, at most
LEAST_ODDS = 1.8            # its log odds
FIXED_WEIGHT = 5.0
CACHE_WORDS = 300_000
NEGATION_REACH = 3          # words after a negation that it covers

# Fixed lists.
INSULTS = ("idiot idiots idiotic moron morons moronic stupid dumb fool fools loser losers scum trash garbage pathetic worthless disgusting "
           "clown clowns jerk jerks imbecile imbeciles bastard bastards asshole assholes bitch bitches scumbag vermin filth retard retards retarded "
           "dummkopf trottel arschloch abschaum connard connards salaud salope débile ordure imbécile imbéciles estúpido estúpida estúpidos basura "
           "escoria gilipollas cabrón").split()
THREATS = ("kill hurt destroy murder shoot stab strangle beat punish burn töten umbringen erschießen verletzen tuer détruire frapper "
           "brûler matar destruir golpear quemar").split()
TARGETS = "you your yours yourself u he she they them him her his their du dich dir ihr euch tu te toi vous tú usted ustedes vosotros".split()
NEGATIONS = "not never no none nobody isn't aren't wasn't don't doesn't didn't won't cannot can't nicht nie kein keine niemals pas jamais nunca jamás".split()
REPORTS = ("said says say saying told tells claimed claims wrote writes quoted quotes reported reportedly alleged according sagte sagt schrieb "
           "laut dit disait écrit selon dijo dice escribió según").split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLAUSE, SENTENCE = 8, 16
FEATURES = ("direct", "targeted", "negated", "reported", "threat", "targeted_threat")


def compose(parts: list[tuple[int, callable]]) -> tuple[list[tuple], list[list[int]]]:
    """Product of automata (states, step(state, symbol)): its states and its table."""
    states = list(product(*(range(n) for n, _ in parts)))
    index = {s: i for i, s in enumerate(states)}
    return states, [[index[tuple(step(x, sym) for x, (_, step) in zip(s, parts))] for sym in range(24)] for s in states]


def grammar() -> tuple[list[tuple], list[list[int]]]:
    kind = lambda sym: sym & 7
    flag = lambda k: lambda s, sym: int(s or kind(sym) == k)
    reach = lambda s, sym: NEGATION_REACH if kind(sym) == NEGATION else max(0, s - 1)
    return compose([(2, flag(INSULT)), (2, flag(THREAT)), (2, flag(TARGET)), (NEGATION_REACH + 1, reach), (2, flag(REPORT))])


STATES, TABLE = grammar()
INDEX = {s: i for i, s in enumerate(STATES)}
CLEARED = [INDEX[(0, 0, 0, 0, s[4])] for s in STATES]   # after a clause: reported speech lasts to the sentence's end


class Lexicon(dict):
    """White-space-delimited word -> symbol, for all words; `weights` of the matched ones."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.fixed = {w: k for k, ws in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS)) for w in ws}
        self.stems = stems
        self.weights: dict[str, float] = {}

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.weights.clear()
        core = word.strip("\"'“”«»()[]*_~|.,;:!?…").lower()
        sym = self.fixed.get(core, OTHER)
        weight = FIXED_WEIGHT if sym in (INSULT, THREAT) else 0.0
        if sym not in (REPORT, NEGATION, TARGET):
            learned = max([self.stems.get("=" + core, 0.0), *(self.stems.get(core[:k], 0.0) for k in STEM_LETTERS if len(core) >= k)])
            if learned:
                sym, weight = (sym or INSULT), max(weight, learned)
        if weight:
            self.weights[word] = weight
        if word[-1] in ".!?…" or word.rstrip("\"'”»)")[-1:] in tuple(".!?…"):
            sym |= SENTENCE
        elif word[-1] in ",;:":
            sym |= CLAUSE
        self[word] = sym
        return sym

    def features(self, text: str | None) -> list[float]:
        out = [0.0] * len(FEATURES)
        words = (text or "").replace("\n", " . ").split()
        symbols = bytes(map(self.__getitem__, words))
        if not symbols.translate(None, QUIET):
            return out
        state, weight = 0, 0.0
        for word, sym in zip(words, symbols):
            before = state
            state = TABLE[state][sym]
            if sym & 7 in (INSULT, THREAT):
                w = self.weights.get(word)
                if w is None:   # the cache was cleared in between
                    self.pop(word, None)
                    self[word]
                    w = self.weights.get(word, FIXED_WEIGHT)
                if STATES[before][3]:
                    out[2] += w
                else:
                    weight += w
            if sym >= CLAUSE:
                if weight:
                    self.emit(out, state, weight)
                state, weight = (0 if sym >= SENTENCE else CLEARED[state]), 0.0
        if weight:
            self.emit(out, state, weight)
        return [float(np.log1p(x)) for x in out]

    @staticmethod
    def emit(out: list[float], state: int, weight: float) -> None:
        insult, threat, target, _, report = STATES[state]
        if report:
            out[3] += weight
            return
        if insult:
            out[0] += weight
            out[1] += weight * target
        if threat:
            out[4] += weight
            out[5] += weight * target


QUIET = bytes(s for s in range(256) if s & 7 not in (INSULT, THREAT))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def labelled(labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    one = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(learnable(F.col("id")) & F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic")))
    return (one.filter("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(sample_docs)
            .unionByName(one.filter("toxic = 0").orderBy(F.xxhash64("id"), "id").limit(sample_docs)))


def word_stems(text: str | None) -> set[str]:
    """Whole words (marked ``=``) and beginnings of a text's words."""
    out = set()
    for w in {x.strip("\"'“”«»()[]*_~|.,;:!?…").lower() for x in (text or "").split()}:
        if w and any(c.isalpha() for c in w):
            out.add("=" + w)
            out.update(w[:k] for k in STEM_LETTERS if len(w) >= k)
    return out


def learn_stems(known: DataFrame) -> dict[str, float]:
    """Stems of the labelled texts ``(text, toxic)`` that mark toxic ones, with log odds."""
    def run(batches):
        counts = (Counter(), Counter())
        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic].update(word_stems(text))
        for part in range(0, len(keys := list({*counts[0], *counts[1]})) or 1, 50_000):
            own = keys[part:part + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([counts[1][k] for k in own], pa.int64()),
                                              pa.array([counts[0][k] for k in own], pa.int64())], ["stem", "c1", "c0"])
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    s1, s0 = n[1] / (n[0] + n[1]), n[0] / (n[0] + n[1])
    found = (known.select("text", "toxic").mapInArrow(run, "stem string, c1 long, c0 long")
             .groupBy("stem").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0")))
    c1, c0, c = F.col("c1"), F.col("c0"), F.col("c1") + F.col("c0")
    part = lambda x, s: F.when(x > 0, x * F.log(x / (c * s))).otherwise(0.0)
    odds = F.log((c1 + 0.5) / (n[1] + 1)) - F.log((c0 + 0.5) / (n[0] + 1))
    rows = (found.filter((c1 / n[1] > c0 / n[0]) & (c0 <= c1 * IMPURITY) & (2 * (part(c1, s1) + part(c0, s0)) >= LEAST_EVIDENCE))
            .select("stem", odds.alias("w"), "c1").filter(F.col("w") >= LEAST_ODDS).collect())   # of the words of a bounded sample
    return {r.stem: r.w for r in sorted(rows, key=lambda r: (-r.c1, r.stem))}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the last: constant) by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(w))
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


FIXED_MODEL = np.array([1.5, 0.5, -0.3, -0.3, 1.0, 0.5, -2.0])


def feature_rows(texts: DataFrame, stems: dict[str, float], carry: list[str], kinds: str) -> DataFrame:
    def make():
        words = Lexicon(stems)

        def one(batch):
            got = np.array([words.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *(pa.array(got[:, i]) for i in range(len(FEATURES)))],
                                              [*carry, *FEATURES])
        return one
    return map_slices(texts, make, kinds + "".join(f", {f} double" for f in FEATURES))


def score(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the pattern features of every row."""
    texts = text_rows(docs)
    marks = labelled(labels, sample_docs)   # bounded: 2 * sample_docs rows
    known = cut(texts.join(F.broadcast(marks), texts["doc_id"] == marks["id"]).select("text", "toxic"), "toxicity-sample")
    stems = learn_stems(known)
    got = sorted(feature_rows(known, stems, ["toxic"], "toxic int").collect(), key=tuple)   # of the bounded sample
    y = np.array([r.toxic for r in got], float)
    model = FIXED_MODEL
    if 0 < y.sum() < len(y):
        model = logistic(np.array([[r[f] for f in FEATURES] for r in got]), y)
    z = F.lit(float(model[-1]))
    for f, w in zip(FEATURES, model):
        z = z + F.col(f) * F.lit(float(w))
    rows = feature_rows(texts.select("doc_id", "text"), stems, ["doc_id"], "doc_id long").withColumn("score", 1 / (1 + F.exp(-z)))
    return rows.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
