"""Exact removal of repeated byte strings by longest-previous-factor arrays
(operator 10).

A string of ``length`` bytes is repeated if it also starts elsewhere. Suffixes are
compared only where that can be:

1. Every window of ``length`` bytes is owned by the ``GRAM``-byte string of least
   hash inside it (the leftmost of equals), so equal windows have equal owners.
   Consecutive windows of one owner are a run; its bytes are a block. Runs whose
   owner occurs once in the corpus (most) are done.
2. Runs are grouped by owner and block. Equal blocks repeat as a whole. Only the
   distinct blocks of owners with several, at the edges of copied stretches, go on.
3. Blocks meet by owner, in corpus order. Suffixes of at least ``length`` bytes are
   ranked by prefix doubling up to that length; in suffix order, with ties in corpus
   order, the previous smaller position of a suffix gives its longest previous factor
   of ``length`` bytes or more, the next larger one its longest next factor. Owners
   with more than ``hot_blocks`` distinct blocks are not put into one task: their
   windows are counted by content instead, over all tasks.

``keep_first=True`` removes what has a previous factor (all copies but the first in
order of doc_id), ``False`` also what has a next one (every copy).

Defined results: NULL and texts shorter than ``length`` lose nothing; repeated rows
are copies of each other; among rows that share an id, the lower text hash is first,
rows alike in both count as one place for ``keep_first``, which then keeps them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

from loadkit.llm.common import cut, map_slices, table, text_rows

LENGTH = 200
GRAM = 32
HOT_BLOCKS = 8192
PART_BYTES = 4 << 20       # text whose windows are owned at once; a run never crosses such parts
GROUP_BYTES = 2 << 20      # bytes of blocks that are ranked at once
POSITION = np.uint64((1 << 24) - 1)
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
HALF = np.uint64(32)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each position on."""
    n = len(data) - gram + 1
    words = np.zeros(n + gram - 8, np.uint64)
    for k in range(8):
        words |= data[k:k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    h = np.zeros(n, np.uint64)
    for k in range(0, gram, 8):
        h = (h ^ words[k:k + n]) * MIX
        h = (h ^ (h >> HALF)) * MIX2
        h ^= h >> HALF
    return h


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and owner's hash of every run of ``data``."""
    h = gram_hashes(data, gram)
    least = (h & ~POSITION) | np.arange(len(h), dtype=np.uint64)
    width, want = 1, length - gram + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if want > width:
        least = np.minimum(least[:width - want], least[want - width:])
    owner = (least & POSITION).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    return first, np.diff(np.append(first, len(owner))), h[owner[first]]


def text_runs(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, windows, owner and block hash of all runs of a text."""
    out = []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, PART_BYTES):
        first, n, owner = runs(data[at:at + PART_BYTES + length - 1], length, gram)
        first = first + at
        ends = (first + n + (length - 1)).tolist()
        blocks = np.fromiter((xxh3_64_intdigest(text[a:b]) for a, b in zip(first.tolist(), ends)), np.uint64, len(ends))
        out.append((first, n, owner, blocks))
    if not out:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*out))


def corpus_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``g, b, doc_id, t, p, n``: owner, block, row (id and low text-hash bits), first
    window, windows."""
    rows = text_rows(docs).withColumn("t", F.expr(LOW_HASH)).select("doc_id", "t", "text")

    def make():
        def one(batch):
            parts, of = [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                text = text.as_py()
                if text is not None and len(text) >= length:
                    got = text_runs(text, length, gram)
                    parts.append(got)
                    of.append(np.full(len(got[0]), i, np.int64))
            if not parts:
                parts, of = [text_runs(b"", length, gram)], [np.empty(0, np.int64)]
            p, n, g, b = (np.concatenate(c) for c in zip(*parts))
            of = pa.array(np.concatenate(of))
            return pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), pa.array(b.view(np.int64)), batch.column("doc_id").take(of),
                 batch.column("t").take(of), pa.array(p), pa.array(n.astype(np.int32))], ["g", "b", "doc_id", "t", "p", "n"])
        return one
    return map_slices(rows, make, "g long, b long, doc_id long, t long, p long, n int")


def prefix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at ``at`` by their first ``length`` bytes (equal ranks:
    equal bytes), by prefix doubling over all positions of ``data``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.zeros(len(data), np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | padded[k:k + len(data)]
    rank, width = np.unique(keys, return_inverse=True)[1].astype(np.uint64), 8
    while width < length:
        step = min(width, length - width)
        after = np.concatenate([rank[step:], np.zeros(step, np.uint64)])
        rank = np.unique((rank << HALF) | after, return_inverse=True)[1].astype(np.uint64)
        width += step
    return rank[at]


def factors(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix, given in corpus order, has a previous and a next factor of
    full length: in suffix order with ties in corpus order, the nearest smaller
    position before it and the nearest larger one after it have its rank."""
    order = np.argsort(rank, kind="stable")
    same = rank[order[1:]] == rank[order[:-1]]
    before, after = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    before[order[1:][same]] = True
    after[order[:-1][same]] = True
    return before, after


def spans_of(marks: np.ndarray, length: int) -> list[dict]:
    """Byte ranges that the marked windows cover."""
    at = np.flatnonzero(marks)
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at) > length) + 1
    return [{"s": int(a), "e": int(b) + length} for a, b in zip(at[np.concatenate([[0], new])], at[np.concatenate([new - 1, [-1]])])]


LOW_HASH = "th & 4294967295L"
SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def rank_blocks(length: int, keep_first: bool):
    """Arrow function over blocks ordered by owner: ``g, b, spans`` of what repeats in
    each block that occurs once (or, to keep the first, in its first place)."""
    def ranked(rows: list[dict]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["t"], r["p"]))
        sizes = [len(r["block"]) for r in rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        n = np.array([r["n"] for r in rows])
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
        before, after = factors(prefix_ranks(np.frombuffer(b"".join(r["block"] for r in rows), np.uint8), at, length))
        marks = np.split(before if keep_first else before | after, np.cumsum(n)[:-1])
        return pa.RecordBatch.from_arrays(
            [pa.array([r["g"] for r in rows], pa.int64()), pa.array([r["b"] for r in rows], pa.int64()),
             pa.array([spans_of(m, length) for m in marks], SPANS)], ["g", "b", "spans"])

    def run(batches):
        held, size, owner = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["g"] != owner and size > GROUP_BYTES:
                    yield ranked(held)
                    held, size = [], 0
                owner = row["g"]
                held.append(row)
                size += len(row["block"])
        if held:
            yield ranked(held)
    return run


def hot_spans(blocks: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for owners with many blocks, by counting windows over all tasks."""
    def make():
        def one(batch):
            of, at, low, high = [], [], [], []
            for i, (block, n) in enumerate(zip(batch.column("block").to_pylist(), batch.column("n").to_pylist())):
                for k in range(n):
                    h = xxh3_128_intdigest(block[k:k + length])
                    of.append(i)
                    at.append(k)
                    low.append(h & (1 << 64) - 1)
                    high.append(h >> 64)
            own = pa.array(of, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(c).take(own) for c in ("g", "b", "doc_id", "t", "p")]
                + [pa.array(at, pa.int64()), pa.array(np.array(low, np.uint64).view(np.int64)),
                   pa.array(np.array(high, np.uint64).view(np.int64))], ["g", "b", "doc_id", "t", "p", "k", "lo", "hi"])
        return one
    windows = map_slices(blocks.select("g", "b", "doc_id", "t", "p", "n", "block"), make,
                         "g long, b long, doc_id long, t long, p long, k long, lo long, hi long", rows=128)
    place = F.struct(F.col("doc_id").isNotNull().alias("i"), "doc_id", "t", (F.col("p") + F.col("k")).alias("p"))
    twice = windows.groupBy("lo", "hi").agg(F.count("*").alias("c"), F.min(place).alias("first")).filter("c > 1")
    hit = windows.withColumn("place", place).join(twice, ["lo", "hi"])
    if keep_first:
        hit = hit.filter(F.col("place") > F.col("first"))
    return hit.groupBy("g", "b").agg(F.collect_list(F.struct(F.col("k").alias("s"), (F.col("k") + length).alias("e"))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, gram: int = GRAM,
                   hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``doc_id, t, spans``: byte ranges (overlapping ones too) to remove, for the rows that have any."""
    found = cut(corpus_runs(docs, length, gram), "runs")
    # written: a join with a table, not with an aggregate, is one whose hot owner can be split
    often = cut(found.groupBy("g").agg(F.count("*").alias("c")).filter("c > 1").select("g"), "run-owners")
    hits = cut(found.join(often, "g"), "run-hits")
    place = F.struct(F.col("doc_id").isNotNull().alias("i"), "doc_id", "t", "p")
    blocks = hits.groupBy("g", "b").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.min(place).alias("at"))
    blocks = cut(blocks, "run-blocks")
    per_owner = cut(blocks.groupBy("g").agg(F.count("*").alias("n_blocks")), "owner-blocks")
    blocks = cut(blocks.join(per_owner, "g").filter("c > 1 or n_blocks > 1")
                 .select("g", "b", "c", "n", "n_blocks", "at.doc_id", "at.t", "at.p"), "blocks")

    # the bytes of blocks that share their owner with others
    several = blocks.filter("n_blocks > 1")
    texts = text_rows(docs).select(F.col("doc_id").alias("id"), F.expr(LOW_HASH).alias("tt"),
                                   F.encode("text", "UTF-8").alias("bytes"))
    wanted = several.groupBy("doc_id", "t").agg(F.collect_list(F.struct("g", "b", "n", "p", "n_blocks")).alias("want"))
    one_each = texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("tt") == F.col("t")))
    cuts = (one_each.select("doc_id", "t", "bytes", F.explode("want").alias("w"))
            .select("w.g", "w.b", "doc_id", "t", "w.p", "w.n", "w.n_blocks",
                    F.substring("bytes", F.col("w.p").cast("int") + 1, F.col("w.n") + F.lit(length - 1)).alias("block"))
            .dropDuplicates(["g", "b"]))
    block_bytes = cut(cuts, "block-bytes")
    spread = block_bytes.filter(F.col("n_blocks") <= hot_blocks).drop("n_blocks").repartition("g").sortWithinPartitions("g")
    kind = "g long, b long, spans array<struct<s:long,e:long>>"
    partly = spread.mapInArrow(rank_blocks(length, keep_first), kind)
    hot = block_bytes.filter(F.col("n_blocks") > hot_blocks)
    if not hot.isEmpty():
        partly = partly.unionByName(hot_spans(hot, length, keep_first))

    known = (blocks.select("g", "b", "c", F.struct("doc_id", "t", "p").alias("rep"))
             .join(partly, ["g", "b"], "left"))
    here = F.struct("doc_id", "t", "p")
    whole = ~here.eqNullSafe(F.col("rep")) if keep_first else F.col("c") > 1
    all_of_it = F.array(F.struct(F.col("p").alias("s"), (F.col("p") + F.col("n") + F.lit(length - 1)).alias("e")))
    parts = F.transform("spans", lambda x: F.struct((x["s"] + F.col("p")).alias("s"), (x["e"] + F.col("p")).alias("e")))
    return (hits.join(known, ["g", "b"]).select("doc_id", "t", F.when(whole, all_of_it).otherwise(parts).alias("spans"))
            .filter("size(spans) > 0").groupBy("doc_id", "t").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def cut_spans(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed ranges."""
    if not spans:
        return text, 0
    left, at, n = [], 0, 0
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if s > at or n == 0:
            left.append(text[at:s])
            n += 1
        at = max(at, e)
    return b"".join(left) + text[at:], n


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, gram: int = GRAM,
                   hot_blocks: int = HOT_BLOCKS, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and ``kept``
    (the bytes left; a cut can fall inside a character) with ``with_text``."""
    spans = repeated_spans(docs, length, keep_first, gram, hot_blocks)
    rows = text_rows(docs).select(F.col("doc_id").alias("id"), F.expr(LOW_HASH).alias("tt"), "text")
    joined = (rows.join(spans, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("tt") == F.col("t")), "left")
              .select(F.col("id").alias("doc_id"), "text", "spans"))

    def make():
        def one(batch):
            out = []
            for text, own in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                kept, n = cut_spans(text or b"", own)
                out.append((len(text or b""), len(text or b"") - len(kept), n, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_text else 5]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds[: len(names) - 1]))], names)
        return one
    return map_slices(joined, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                      + (", kept binary" if with_text else ""))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


#: The definition of what repeats, window by window.
OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, {2 * LENGTH})) AS k
  FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - {LENGTH} + 1))) AS p FROM d)),
often AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM w JOIN often USING (k)),
island AS (SELECT doc_id, p, count(*) FILTER (gap IS NULL OR gap > {LENGTH}) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM hit),
span AS (SELECT doc_id, n, min(p) AS s, max(p) + {LENGTH} AS e FROM island GROUP BY doc_id, n),
piece AS (
  SELECT doc_id, n, s, e, substr(h, 2 * done + 1, 2 * (s - done)) AS before, h
  FROM (SELECT span.*, h, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY n), 0) AS done FROM span JOIN d USING (doc_id))),
cut AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY n) || substr(any_value(h), 2 * max(e) + 1) AS kept
        FROM piece GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""
