"""Benchmark decontamination by latent semantic retrieval (operator 5).

The query set is the benchmark: its items, cut into passages of at most
``ITEM_WORDS`` words, are taken in blocks of about ``BLOCK_PASSAGES``; every document meets
every block. For a block:

1. Documents become sequences of the block's vocabulary (0: any other word), written
   once; document frequencies over all of them give the weights.
2. The TF-IDF matrix of the corpus' passages (windows of ``WINDOW_WORDS`` words) gets
   a randomised SVD: each task adds up A'A W for a fixed Gaussian W, and from the sum
   alone the Nystroem form gives the ``RANK`` leading right singular vectors. The
   ``ITEM_RANK`` leading ones of the benchmark's own passages join them, as a corpus'
   directions alone say too little of a passage that is rare in it. A word then costs as
   many numbers as the space has dimensions, however many passages there are.
3. Every window (overlapping by half) is projected and compared with every passage: a
   latent cosine of ``CANDIDATE`` makes a candidate, if the window also holds ``LEAST``
   of the passage's own energy (the squared weights of its telling words). A window that
   holds ``HELD`` of it is a candidate whatever its cosine, which falls with every word
   beside the passage. Passages under ``SHORT_WORDS`` words must be there with all words.
4. A candidate is verified on its words: in the window and half a window around it the
   longest common subsequence must hold ``LCS_SHARE`` of the passage's words; or, in the
   window, ``PARAPHRASE_SHARE`` of them and ``ANSWER_SHARE`` of its answer (the last
   sentence, at least its last ``ANSWER_WORDS`` words). Passages under ``SHORT_WORDS``
   words must occur unbroken.

Defined results: NULL and empty texts and items hold nothing; items with equal ids
are one item; rows with equal id and text get the same answer; an empty benchmark
leaks nowhere.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm.common import cut, fresh, map_slices, slices, table, text_rows

BLOCK_PASSAGES = 4096
ITEM_WORDS = 48
WINDOW_WORDS = 64          # steps of half of it
RANK = 32                  # of the corpus' SVD
ITEM_RANK = 96             # of the passages' own
COMMON = 1.0               # words of less idf (in over a third of the documents) are left out of both
TELLING = 0.9              # share of a passage's energy that its telling words, rarest first, hold
CANDIDATE = 0.3
LEAST = 0.25
HELD = 0.5
CELLS = 1 << 22            # windows times passages looked at together, about
LCS_SHARE = 0.7
PARAPHRASE_SHARE = 0.5
ANSWER_SHARE = 0.8
ANSWER_WORDS = 8
SHORT_WORDS = 8
SEED = 7
PARTS = 16                 # pieces in which tasks' sums are added up
WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def item_passages(text: str | None) -> list[tuple[list[str], int]]:
    """(words, words of the answer) of an item's passages; the answer is in the last."""
    words = words_of(text)
    if not words:
        return []
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n", text.strip()) if WORDS.search(s)]
    answer = max(ANSWER_WORDS, len(words_of(sentences[-1])))
    n = -(-len(words) // ITEM_WORDS)
    size = -(-len(words) // n)
    parts = [words[i:i + size] for i in range(0, len(words), size)]
    return [(p, min(len(p), answer) if i == len(parts) - 1 else 0) for i, p in enumerate(parts)]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit of ``a`` at a time in parallel."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for x in b:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


class Block:
    """Benchmark passages, their vocabulary and, once fitted, their places in the latent space."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.words, self.answers = [], [], []
        self.vocabulary: dict[str, int] = {}
        for item, text in items:
            for words, answer in item_passages(text):
                self.items.append(item)
                self.answers.append(answer)
                self.words.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
        self.size = len(self.vocabulary) + 1
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.idf = np.zeros(self.size, np.float32)

    def encode(self, text: str | None) -> bytes:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), self.kind, len(words)).tobytes()

    def rows(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The passages' vectors as (passage, word, value), a row per distinct word."""
        of = [(p, w, k) for p, words in enumerate(self.words) for w, k in Counter(words).items()]
        p, w, k = (np.array(x, np.int64) for x in zip(*of))
        return p, w, k * weights[w].astype(np.float64)

    def fit(self, sums: np.ndarray, w: np.ndarray) -> None:
        """The latent space; ``sums``: A'A W over the corpus' windows."""
        telling = np.where(self.idf < COMMON, 0, self.idf)
        shift = 1e-10 * np.linalg.norm(sums)
        y = sums + shift * w
        core = w.T @ y
        values, vectors = np.linalg.eigh((core + core.T) / 2)
        good = values > max(values.max(initial=0), 0) * 1e-12
        left, self.spread, _ = np.linalg.svd(y @ vectors[:, good] / np.sqrt(values[good]), full_matrices=False)
        self.leading = left[:, self.spread > self.spread[:1].max(initial=0) * 1e-9]
        # the passages' own leading directions, from their products with one another
        p, word, x = self.rows(telling)
        n = len(self.words)
        size = np.sqrt(np.bincount(p, x * x, n))
        x = x / np.maximum(size[p], 1e-9)
        by = np.argsort(word, kind="stable")
        gram = np.zeros((n, n))
        for run in np.split(by, np.flatnonzero(np.diff(word[by])) + 1):
            gram[np.ix_(p[run], p[run])] += np.outer(x[run], x[run])
        values, vectors = np.linalg.eigh(gram)
        vectors = vectors[:, values > 1e-6][:, -ITEM_RANK:]
        own = np.zeros((self.size, vectors.shape[1]))
        np.add.at(own, word, vectors[p] * x[:, None])
        basis, size, _ = np.linalg.svd(np.hstack([self.leading, own]), full_matrices=False)
        basis = basis[:, size > 1e-6]
        # what a word adds to a window's place in the space, and the passages' places
        self.adds = (basis * telling[:, None]).astype(np.float32)
        self.queries = np.zeros((n, basis.shape[1]))
        np.add.at(self.queries, p, basis[word] * x[:, None])
        self.queries = (self.queries / np.maximum(np.linalg.norm(self.queries, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        self.needed = [Counter(x) for x in self.words]
        self._gates()

    def _gates(self) -> None:
        """Postings of the words that tell a passage, and the energy that a window needs."""
        posted: list[list[tuple[int, float]]] = [[] for _ in range(self.size)]
        self.need = np.zeros(len(self.words), np.float32)     # share: LEAST and HELD are of this
        self.short = np.array([len(x) < SHORT_WORDS for x in self.words])
        for k, words in enumerate(self.words):
            own = sorted(set(words), key=lambda w: (-self.idf[w], w))
            energy = np.cumsum([float(self.idf[w]) ** 2 for w in own])
            last = len(own) if self.short[k] else int(np.searchsorted(energy, TELLING * energy[-1])) + 1
            for w in own[:last]:
                posted[w].append((k, float(self.idf[w]) ** 2))
            self.need[k] = energy[min(last, len(own)) - 1]
        self.many = np.array([len(x) for x in posted])
        self.start = np.concatenate([[0], np.cumsum(self.many)])
        flat = [x for one in posted for x in one]
        self.posted = np.array([k for k, _ in flat], np.int64)
        self.energy = np.array([e for _, e in flat], np.float32)

    def shared(self, of: np.ndarray, words: np.ndarray, n_halves: int) -> np.ndarray:
        """Energy of each passage's telling words in each half window."""
        keep = self.many[words] > 0
        # a word counts once in a half
        pairs = np.unique(of[keep] * self.size + words[keep])
        of, words = np.divmod(pairs, self.size)
        many = self.many[words]
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[words] - (ends - many), many)
        out = np.bincount(np.repeat(of, many) * len(self.words) + self.posted[at], self.energy[at], n_halves * len(self.words))
        return out.astype(np.float32).reshape(n_halves, -1)

    def halves(self, docs: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of ``weights`` over the half windows of all documents, and how many each has."""
        half = WINDOW_WORDS // 2
        counts = np.array([-(-len(d) // half) for d in docs], np.int64)
        words = np.concatenate(docs) if docs else np.empty(0, self.kind)
        pos = np.concatenate([np.arange(len(d)) for d in docs]) if docs else np.empty(0, np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        of = np.repeat(first, [len(d) for d in docs]) + pos // half
        known = words > 0
        out = np.zeros((int(counts.sum()), weights.shape[1]), np.float32)
        of, words = of[known], words[known]
        for a in range(0, len(of), 1 << 15):   # bounds what is gathered at once
            part, own = of[a:a + (1 << 15)], words[a:a + (1 << 15)]
            new = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
            out[part[new]] += np.add.reduceat(weights[own], new, axis=0)
        return out, counts

    def verify(self, doc: np.ndarray, at: int, passage: int) -> tuple[float, float] | None:
        """(share of the passage's words in order, share of its answer's) of a leak whose
        window begins at word ``at``."""
        words, answer = self.words[passage], self.answers[passage]
        half = WINDOW_WORDS // 2
        near, around = doc[at:at + WINDOW_WORDS].tolist(), doc[max(0, at - half):at + WINDOW_WORDS + half].tolist()
        n = len(words)
        if n < SHORT_WORDS:
            places = (i for i, x in enumerate(near) if x == words[0])
            return (1.0, 1.0) if any(near[i:i + n] == words for i in places) else None
        have, common = Counter(around), 0
        for w, k in self.needed[passage].items():
            common += min(k, have[w])
        if common < PARAPHRASE_SHARE * n:
            return None
        share = lcs(words, around) / n
        told = lcs(words[n - answer:], near) / answer if answer else 0.0
        if share >= LCS_SHARE:
            return share, told
        share = lcs(words, near) / n
        return (share, told) if share >= PARAPHRASE_SHARE and told >= ANSWER_SHARE else None

    def search(self, docs: list[np.ndarray]) -> list[tuple[int, int, float, float, float]]:
        """(document, item, cosine, shares) of the leaks in some documents."""
        out, lo, half = [], 0, WINDOW_WORDS // 2
        most = max(1, CELLS // len(self.words)) * half
        sizes = np.cumsum([0] + [len(d) + half for d in docs])
        while lo < len(docs):      # some documents at a time, a very long one by itself
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + most, side="right")) - 1)
            out += [(lo + d, *rest) for d, *rest in self._search(docs[lo:hi])]
            lo = hi
        return out

    def candidates(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, passage, latent cosine) of the windows to verify."""
        half = WINDOW_WORDS // 2
        places, counts = self.halves(docs, self.adds)
        none = np.zeros(0, np.int64)
        if not len(places):
            return none, none, none, none.astype(np.float32)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        words = np.concatenate(docs).astype(np.int64)
        of = np.repeat(first, [len(d) for d in docs]) + np.concatenate([np.arange(len(d)) for d in docs]) // half
        energy = self.shared(of, words, len(places))
        doc = np.repeat(np.arange(len(docs)), counts)
        last = np.append(doc[1:] != doc[:-1], True)
        alone = last & np.append(False, ~last[:-1])    # a last half alone, where there is a half before it
        for x in (places, energy):
            x[:-1] += np.where(last[:-1, None], 0, x[1:])
            x[alone] = 0
        cosines = (places / np.maximum(np.linalg.norm(places, axis=1, keepdims=True), 1e-9)) @ self.queries.T
        told = energy >= np.where(self.short, 0.999, HELD) * self.need
        told |= ~self.short & (cosines >= CANDIDATE) & (energy >= LEAST * self.need)
        k, p = np.nonzero(told)
        return doc[k], (k - first[doc[k]]) * half, p, cosines[k, p]

    def _search(self, docs: list[np.ndarray]) -> list[tuple[int, int, float, float, float]]:
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for d, at, p, cosine in zip(*(x.tolist() for x in self.candidates(docs))):
            got = self.verify(docs[d], at, p)
            if got:
                best = (min(cosine, 1.0), *got)
                key = d, self.items[p]
                found[key] = max(found.get(key, best), best, key=lambda x: (x[1], x[2], x[0]))
        return [(*key, *best) for key, best in found.items()]


def _documents(batch: pa.RecordBatch, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in batch.column("ids").to_pylist()]


def encode(docs: DataFrame, block: Block) -> DataFrame:
    def make():
        def one(batch):
            ids = [block.encode(t) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(ids, pa.binary())], ["doc_id", "th", "ids"])
        return one
    return map_slices(text_rows(docs), make, "doc_id long, th long, ids binary")


def inverse_frequencies(ids: DataFrame, block: Block) -> np.ndarray:
    def run(batches):
        count = np.zeros(block.size, np.int64)
        n = 0
        for batch in slices(batches):
            for d in _documents(batch, block.kind):
                count[np.unique(d)] += 1
                n += 1
        count[0] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(block.size)), pa.array(count)], ["w", "n"])
    got = ids.select("ids").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).toArrow()   # a row a word
    n = np.zeros(block.size)
    n[got["w"].to_numpy()] = got["n"].to_numpy()
    out = np.log((n[0] + 1) / (n + 0.5)).clip(0.01)
    out[0] = 0
    return out.astype(np.float32)


def sketch(ids: DataFrame, block: Block, w: np.ndarray) -> np.ndarray:
    """A'A W over all windows (not overlapping here, so that each word counts once).
    Tasks' sums are added up in ``PARTS`` pieces."""
    idf = np.where(block.idf < COMMON, 0, block.idf)
    telling = idf > 0
    scaled = (w * idf[:, None]).astype(np.float32)
    cuts = np.linspace(0, block.size, PARTS + 1).astype(int)

    def run(batches):
        total = np.zeros((block.size, w.shape[1]))
        for batch in slices(batches):
            docs = [np.where(telling[d], d, 0) for d in _documents(batch, block.kind) if len(d)]
            if not docs:
                continue
            y, counts = block.halves(docs, scaled)
            first = np.concatenate([[0], np.cumsum(counts)])[:-1]
            window = np.concatenate([f + np.arange(c) // 2 for f, c in zip(first, counts)])   # halves to windows
            y = np.add.reduceat(y, np.concatenate([[0], np.flatnonzero(np.diff(window)) + 1]), axis=0)
            number = np.cumsum(np.concatenate([[0], np.diff(window) > 0]))
            half = WINDOW_WORDS // 2
            words = np.concatenate(docs)
            of = number[np.repeat(first, [len(d) for d in docs]) + np.concatenate([np.arange(len(d)) for d in docs]) // half]
            known = words > 0
            words, of = words[known], of[known]
            if not len(words):
                continue
            order = np.argsort(words, kind="stable")   # 16-bit words: a radix sort
            new = np.concatenate([[0], np.flatnonzero(np.diff(words[order])) + 1])
            total[words[order][new]] += np.add.reduceat(y[of[order]], new, axis=0)
        total *= idf[:, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS)), pa.array([total[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["part", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches, 16):
            for part, x in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(x)
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([sums[k].tobytes() for k in keys], pa.binary())], ["part", "sums"])
    kind = "part long, sums binary"
    rows = ids.select("ids").mapInArrow(run, kind).repartition(PARTS, "part").mapInArrow(add, kind).collect()   # PARTS rows
    if not rows:
        return np.zeros_like(w)
    return np.concatenate([np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.part)]).reshape(block.size, -1)


def block_leaks(docs: DataFrame, block: Block) -> DataFrame:
    ids = cut(encode(docs, block), "benchmark-words")
    block.idf = inverse_frequencies(ids, block)
    w = np.random.default_rng(SEED).standard_normal((block.size, min(RANK, block.size)))
    w[0] = 0
    block.fit(sketch(ids, block, w), w)

    def make():
        def one(batch):
            rows = block.search(_documents(batch, block.kind))
            cols = list(zip(*rows)) or [()] * 5
            of = pa.array(cols[0], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("th").take(of), pa.array(cols[1], pa.int64()),
                 *(pa.array(c, pa.float64()) for c in cols[2:])], ["doc_id", "th", "item_id", "cosine", "lcs_share", "answer_share"])
        return one
    return map_slices(ids, make, "doc_id long, th long, item_id long, cosine double, lcs_share double, answer_share double", rows=64)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, th, item_id, cosine, lcs_share, answer_share``: a row for each document
    and benchmark item that it holds, with the best of its windows."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("t"))
             .filter("item is not null and t is not null"))
    size = F.size(F.split("t", r"[^\\w]+")) / ITEM_WORDS + 1   # about its passages
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_PASSAGES))
    out = None
    for k in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item", "t").collect()   # about BLOCK_PASSAGES passages
        block = Block([(r.item, r.t) for r in own])
        if block.words:
            found = block_leaks(docs, block)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, th long, item_id long, cosine double, lcs_share double, answer_share double")
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, as they are."""
    found = cut(leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("th").alias("_leak_th")).distinct(), "leaks")
    th = fresh("_th", docs.columns)
    keyed = docs.withColumn(th, F.xxhash64(F.col("text").cast("string")))
    return keyed.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col(th) == F.col("_leak_th")), "left_anti").select(*docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")
