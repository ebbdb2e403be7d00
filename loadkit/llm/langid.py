"""Language identification by cross-parsing entropy (operator 2).

A bounded sample of labelled text per language is turned into a suffix automaton.
A text is parsed against each: from every phrase start the longest stretch that
occurs in the language's sample is one phrase. The language that needs the fewest
phrases, normalised by the size of its sample and the length of the text
(``phrases * log2(sample) / symbols``, bits a symbol), wins; ties go to the first
name in order.

Texts are lower-cased; every run of non-letters is one space. Blocks of ``BLOCK``
symbols of many texts step through the automaton's table together; then each block is
run again from the state in which the one before it ended, so that phrases go on over
its beginning and a text's phrases are those of the whole text.

Defined results: NULL text or text without a letter is ``und`` with score 0; with
nothing to learn from, every text is. Letters that no sample holds are a phrase
each. Rows with a NULL id are not learned from and not held out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import map_slices, table, text_rows

TRAIN_DOCS = 64            # labelled documents per language, those of least hash
TRAIN_CHARS_PER_DOC = 640  # of each of them, from its first letter: bounds the sample, not what is predicted
BLOCK = 256
SHARPNESS = 12.0           # of the score: share of exp(-SHARPNESS * bits a symbol)
SPACE, PAD = 0, 1
TABLES: dict[int, tuple] = {}   # per worker process


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def samples(docs: DataFrame, train_docs: int = TRAIN_DOCS,
            train_chars: int = TRAIN_CHARS_PER_DOC) -> dict[str, list[str]]:
    """Bounded labelled sample: at most ``train_docs * train_chars`` characters a language."""
    doc_id = F.col("doc_id").cast("string")
    text = F.col("text").cast("string")
    first = F.regexp_instr(text, F.lit(r"\p{L}"))      # a head of numbers or marks teaches nothing
    rows = docs.filter(F.col("lang").isNotNull() & (F.crc32(doc_id) % 3 != 1) & (first > 0)).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64(doc_id).alias("h"), doc_id.alias("id"),
        F.substring(text, first, F.lit(train_chars)).alias("t"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "t"))
    out: dict[str, list[str]] = {}
    for r in rows.withColumn("n", nth).filter(F.col("n") <= train_docs).orderBy("lang", "n").collect():
        out.setdefault(r.lang, []).append(r.t)
    return out


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``symbols``."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(to)
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to


class CrossParser:
    """Transition tables of every language. An entry is the next state, or, where the
    symbol starts a new phrase, the bitwise complement of the state after it."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        self.is_letter = letters()
        used = sorted({c for t in texts.values() for x in t for c in x.lower() if self.is_letter[ord(c)]})
        self.width = len(used) + 3
        self.symbol = np.where(self.is_letter, self.width - 1, SPACE).astype(np.uint16)   # the last: unknown letter
        for i, c in enumerate(used):
            self.symbol[ord(c)] = PAD + 1 + i
        self.tables, self.bits = [], []
        for lang in self.langs:
            sample: list[int] = []
            for x in texts[lang]:
                sample += [*self.encode(x).tolist(), PAD]
            to = suffix_automaton(sample)
            t = np.full((len(to) + 1, self.width), -1, np.int32)
            for s, row in enumerate(to):
                t[s, list(row)] = list(row.values())
            # the last state, where parsing starts, follows a symbol that the sample lacks
            t = np.where(t < 0, ~np.where(t[0] < 0, len(to), t[0]), t)
            t[:, PAD] = np.arange(len(t))
            self.tables.append(np.ascontiguousarray(t.ravel()))
            self.bits.append(math.log2(len(sample) + 2))

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        s = self.symbol[points]
        keep = s != SPACE
        keep[1:] |= s[:-1] != SPACE
        return s[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each encoded text against each language: (texts, languages)."""
        blocks = [-(-len(t) // BLOCK) for t in texts]
        grid = np.full(sum(blocks) * BLOCK, PAD, np.uint16)
        at = 0
        for t, n in zip(texts, blocks):
            grid[at:at + len(t)] = t
            at += n * BLOCK
        steps = np.ascontiguousarray(grid.reshape(-1, BLOCK).T.astype(np.int64))
        owner = np.repeat(np.arange(len(texts)), blocks)
        follows = np.append(owner[1:] == owner[:-1], False)     # the next block is of the same text
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        for k, t in enumerate(self.tables):
            begin = np.full(len(owner), len(t) // self.width - 1, np.int64)
            count, end = self._run(t, steps, begin)
            # each block again from where the one before it ends, until no end changes: a
            # phrase that reaches into a block soon gives the ends that the block has alone
            todo = np.flatnonzero(follows) + 1
            while len(todo := todo[end[todo - 1] != begin[todo]]):
                begin[todo] = end[todo - 1]
                count[todo], now = self._run(t, steps[:, todo], begin[todo])
                moved = todo[(now != end[todo]) & follows[todo]] + 1
                end[todo] = now
                todo = moved
            out[:, k] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return out

    def _run(self, t: np.ndarray, steps: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in each block (a column of ``steps``), and the state after it."""
        state, count = begin, np.zeros(steps.shape[1], np.int64)
        for c in steps:
            v = t[state * self.width + c]
            new = v < 0
            count += new
            state = np.where(new, ~v, v).astype(np.int64)
        return count, state

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        encoded = [self.encode(t or "") for t in texts]
        counts = self.phrases(encoded)
        out = []
        for t, n in zip(encoded, counts):
            if not self.langs or not (t > PAD).any():
                out.append(("und", 0.0))
                continue
            h = n * self.bits / len(t)
            best = int(h.argmin())
            out.append((self.langs[best], float(1 / np.exp(-SHARPNESS * (h - h[best])).sum())))
        return out


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``; learned from
    ``train`` (default ``docs``): rows with a language whose id's CRC-32 modulo 3 is
    not 1."""
    texts = samples(train if train is not None else docs)

    def make():
        key = hash(tuple((k, tuple(v)) for k, v in texts.items()))
        if key not in TABLES:
            TABLES.clear()
            TABLES[key] = CrossParser(texts)
        parser = TABLES[key]

        def one(batch):
            got = parser.predict(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got]), pa.array([g[1] for g in got], pa.float64())],
                ["doc_id", "lang_pred", "score"])
        return one
    got = map_slices(text_rows(docs), make, "doc_id long, lang_pred string, score double", rows=512)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
