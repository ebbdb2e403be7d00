"""Best-fit packing after Martello-Toth dominance reduction (operator 7).

Only the number of pieces of each length matters to a packing, and a length is at
most the capacity, so the instance is a histogram of at most ``capacity`` rows
whatever the corpus holds. `reduce_by_dominance` fixes sets of lengths that
dominate every other bin content for their largest piece, all copies at once;
`best_fit` packs what remains, largest first, into the fullest bin that fits. Both
give patterns (which lengths, how often) with a multiplicity.

Pieces then find their place without meeting each other: a piece's rank among the
pieces of its length (counts per length and salt bucket, then a row number inside
each bucket, so a length that holds a third of all pieces is spread over buckets)
is looked up in the rank intervals that the patterns give to that length.

Defined results: NULL and empty texts are one piece, the separator alone; rows with
equal ids are packed each on its own.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadkit.llm.common import cut, map_slices, table, text_rows
from loadkit.llm.tokens import TOKENIZER, words_of

CAPACITY = 2048
SEPARATOR = 0
MARKS = ".,;:!?"
LATIN_END = "\u0250"
TOGETHER = 128             # words in one call of the library
CACHE_WORDS = 500_000      # that a worker keeps; then it starts anew
PIECES_PER_BUCKET = 100_000

#: Lengths of one bin, each with its number of pieces, largest first.
Pattern = tuple[tuple[int, int], ...]


class TextIds:
    """Ids of texts as little-endian 32-bit bytes.

    The file's normalizer and pre-tokenizer never look across white space, so a text's
    ids are those of its words in turn; they lower-case (at once, where a text is plain
    Latin-1), and they always cut between a letter and the marks that end a word, so
    a marked word has the ids of its core and its marks. New words that are one
    pre-token go to the library many at a time and are told apart by the tokens that
    end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core; idle threads cost memory and time
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ids: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha() and (w.isascii() or max(w) < LATIN_END)]
        texts = [" ".join(plain[i:i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        for i, got in enumerate(self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids, part = np.array(got.ids, "<u4"), plain[i * TOGETHER:(i + 1) * TOGETHER]
            to = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(to) != len(part):   # lower case made two pre-tokens of some word
                continue
            raw = ids.tobytes()
            self.ids.update(zip(part, [raw[a:b] for a, b in zip([0, *to], to)]))
        for w in words:
            if w not in self.ids:
                self.ids[w] = np.array(self.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        lists, ids = [words_of(lowered(t or "")) for t in texts], self.ids
        if len(ids) > CACHE_WORDS:
            ids.clear()
        fresh, marked = [], []
        for w in set().union(*lists).difference(ids):
            core = w.rstrip(MARKS)
            if len(core) == len(w) or not core or core[-1] >= LATIN_END or not core[-1].isalpha():
                fresh.append(w)
            else:
                marked.append((w, core))
        fresh += {x for w, core in marked for x in (core, w[len(core):]) if x not in ids}.difference(fresh)
        self.learn(fresh)
        for w, core in marked:
            ids[w] = ids[core] + ids[w[len(core):]]
        return [b"".join(map(ids.__getitem__, ws)) for ws in lists]


def lowered(text: str) -> str:
    """In lower case if that surely is the normalizer's: Latin-1 without special strings."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text if "<|" in text else text.lower()


IDS: dict[str, TextIds] = {}   # per worker process, by file


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, th, piece, start, length, ids_crc32`` of every row's pieces: its ids,
    then the separator; only what is longer than ``capacity`` is cut."""
    def make():
        path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
        ids_of = IDS.get(path) or IDS.setdefault(path, TextIds(path))
        last, step = np.array([SEPARATOR], "<u4").tobytes(), 4 * capacity

        def one(batch):
            rows = [array("q") for _ in range(5)]
            for i, ids in enumerate(ids_of(batch.column("text").to_pylist())):
                ids += last
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    for column, x in zip(rows, (i, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(x)
            of = pa.array(np.frombuffer(rows[0], np.int64) if rows[0] else np.empty(0, np.int64))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("th").take(of),
                 *(pa.array(np.array(c, np.int64)) for c in rows[1:])],
                ["doc_id", "th", "piece", "start", "length", "ids_crc32"])
        return one
    return map_slices(text_rows(docs), make,
                      "doc_id long, th long, piece long, start long, length long, ids_crc32 long")


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Fix bins that some optimal packing has; returns them and the counts left.

    For a piece j with room r = capacity - j: alone, if nothing fits beside it; with
    the largest k that fits, if k fills the room or no two pieces fit beside j; with
    k and the largest b beside it, if no three fit and b is at least the smaller of
    any two that fit. Whatever else could share j's bin can then trade places with
    pieces at least as large, so no packing gets worse.
    """
    left = {x: n for x, n in counts.items() if n > 0}
    fixed: list[tuple[Pattern, int]] = []

    def largest(room: int, used: Counter) -> int | None:
        i = bisect_right(order, room) - 1
        while i >= 0 and left[order[i]] <= used[order[i]]:
            i -= 1
        return order[i] if i >= 0 else None

    def smallest(n: int, used: Counter) -> list[int]:
        out: list[int] = []
        for x in order:
            out += [x] * min(n - len(out), left[x] - used[x])
            if len(out) >= n:
                break
        return out

    def smaller_of_two(room: int, used: Counter) -> int:
        """The largest d that fits beside some piece of at least d."""
        best = 0
        for i in range(bisect_right(order, room // 2) - 1, -1, -1):
            d = order[i]
            rest = left[d] - used[d]
            if rest <= 0:
                continue
            over = any(left[c] > used[c] for c in order[i + 1:bisect_right(order, room - d)])
            if rest >= 2 or over:
                best = d
                break
        return best

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j, 0) > 0:
                order = sorted(x for x in left if left[x] > 0)
                used, room = Counter([j]), capacity - j
                k = largest(room, used)
                if k is None:
                    take = Counter([j])
                else:
                    small = smallest(3, used)
                    if k == room or len(small) < 2 or small[0] + small[1] > room:
                        take = Counter([j, k])
                    elif len(small) < 3 or sum(small) > room:
                        b = largest(room - k, used + Counter([k]))
                        if b is None or b < smaller_of_two(room, used):
                            break
                        take = Counter([j, k, b])
                    else:
                        break
                times = min(left[x] // n for x, n in take.items())
                for x, n in take.items():
                    left[x] -= n * times
                fixed.append((tuple(sorted(take.items(), reverse=True)), times))
                changed = True
    return fixed, {x: n for x, n in left.items() if n > 0}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: bins that look alike are one group."""
    groups: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []
    full: list[tuple[Pattern, int]] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if not n:
            return
        if not room:
            full.append((pattern, n))
            return
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append((pattern, n))

    for x in sorted(counts, reverse=True):
        todo = counts[x]
        while todo:
            i = bisect_left(rooms, x)
            if i == len(rooms):
                room, pattern, n = capacity, (), todo
            else:
                room = rooms[i]
                pattern, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            each = room // x
            filled = min(n, todo // each)
            put(room - each * x, pattern + ((x, each),), filled)
            todo -= filled * each
            some = todo if filled < n and todo else 0
            if some:
                some = min(some, each - 1) if some < each else 0
            if some:
                put(room - some * x, pattern + ((x, some),), 1)
                todo -= some
            if pattern:
                put(room, pattern, n - filled - bool(some))
    return full + [g for room in rooms for g in groups[room]]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def intervals(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Per (length, first rank): first sequence, pieces of that length a sequence,
    and where they begin in it; sorted by length and rank."""
    used: Counter = Counter()
    rows, base = [], 0
    for pattern, times in patterns:
        at = 0
        for x, n in pattern:
            rows.append((x, used[x], base, n, at))
            used[x] += n * times
            at += x * n
        base += times
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "rank", "base", "each", "at"))}


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    pieces = cut(cut_pieces(docs, capacity, tokenizer), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    places = intervals(solve(counts, capacity))
    buckets = max(16, -(-sum(counts.values()) // PIECES_PER_BUCKET))
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "th", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "bucket").count()
               .select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "th", "piece")
    ranked = (salted.withColumn("n", F.row_number().over(inside)).join(offsets, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("n") - 1).alias("rank")))

    def make():
        key = places["length"] << 44 | places["rank"]

        def one(batch):
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(key, length << 44 | rank, "right") - 1
            nth = rank - places["rank"][i]
            each = places["each"][i]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("piece").cast(pa.int32()), *(batch.column(c) for c in ("start", "length", "ids_crc32")),
                 pa.array(places["base"][i] + nth // each), pa.array(places["at"][i] + nth % each * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
        return one
    return map_slices(ranked, make, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                      "sequence_id long, offset long", rows=1 << 16)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
