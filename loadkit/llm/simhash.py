"""SimHash near-duplicates by multi-index hashing (operator 1).

A fingerprint is cut into ``m`` segments. Two fingerprints at distance <= r agree
on some segment up to ``r // m`` bits (the first ``r % m + 1`` segments) or one bit
less (the others), so each fingerprint looks up the small Hamming ball around each
of its segments in a table keyed by segment value, and complete distances are
checked in the join. ``m`` follows the number of fingerprints: longer segments keep
buckets short, shorter ones keep balls small; the links are the same.

Buckets above ``HOT_BUCKET`` fingerprints (a large group of near copies) are not
paired. Two fingerprints differ in <= r bits exactly if some point lies within
``ceil(r/2)`` of one and ``floor(r/2)`` of the other, so every member of such a
bucket is filed under the points around it (only over the bits that vary in the
bucket) and linked to the smallest member at each point: linear in the members,
and no link between different components is lost or added.

Defined results: NULL, empty and blank texts have no words and fingerprint zero,
which links like any other; rows with equal ids are separate documents that share
the id; a component whose ids are all NULL has a NULL id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from loadkit.llm.common import connected_components, cut, fresh, map_slices, table, text_rows, utf8

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
HOT_BUCKET = 256
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text: lower-case A-Z, words between ASCII white
    space, word shingles with repeats, XXH64; a bit is 1 if set in over half."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return int.from_bytes(xxh64_digest(b" ".join(words), SEED))
    line = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(words) - shingle_words + 1].tolist()
    ends = ends[shingle_words - 1:].tolist()
    h = b"".join([xxh64_digest(line[a:b], SEED) for a, b in zip(starts, ends)])
    h = np.frombuffer(h, np.uint8).reshape(-1, 8)
    sums = np.concatenate([np.bincount(h[:, i], minlength=256) @ BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(sums * 2 > len(h)).tobytes())


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, th, fp`` (signed long) of every row."""
    def make():
        def one(batch):
            fps = [fingerprint(t, shingle_words) for t in utf8(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                ["doc_id", "th", "fp"])
        return one
    return map_slices(text_rows(docs), make, "doc_id long, th long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ball(bits: list[int], radius: int) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for d in range(radius + 1) for c in combinations(bits, d)]


def segments(n: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(offset, width, radius) per segment for a table of ``n`` fingerprints."""
    m = 3 if n <= 1 << 23 else 2
    base, extra = divmod(64, m)
    out, at = [], 0
    for i in range(m):
        width = base + (i < extra)
        radius = max_bits // m - (i > max_bits % m)
        if radius >= 0:
            out.append((at, width, radius))
        at += width
    return out


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET,
                      segs: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints ``fp`` whose components are
    those of all links at ``max_bits`` or fewer differing bits."""
    segs = segs or segments(fps.count(), max_bits)
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])

    def keyed(with_ball: bool) -> DataFrame:
        sets = []
        for i, (at, width, radius) in enumerate(segs):
            value = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else F.col("fp")
            tag = F.lit(i << 56).cast("long") if len(segs) > 1 else F.lit(0).cast("long")
            key = value.bitwiseOR(tag)
            if with_ball:
                ball = F.explode(longs(_ball(list(range(width)), radius)))
                sets.append(fps.select(key.alias("key"), F.col("fp").alias("a"), ball.alias("m"))
                            .select(F.col("key").bitwiseXOR(F.col("m")).alias("key"), "a"))
            else:
                sets.append(fps.select(key.alias("key"), F.col("fp").alias("b")))
        out = sets[0]
        for s in sets[1:]:
            out = out.unionByName(s)
        return out

    held, asked = keyed(False), keyed(True)
    hot = cut(held.groupBy("key").count().filter(F.col("count") > hot_bucket).select("key"), "hot-buckets")
    some_hot = not hot.isEmpty()
    # no side that grows with the input goes through the driver, however small its files
    cold = held.join(hot.hint("merge"), "key", "left_anti") if some_hot else held
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = asked.join(cold.hint("merge"), "key").filter((F.col("a") < F.col("b")) & near).select("a", "b")

    if not some_hot:
        return pairs.distinct()
    member = asked.join(hot.hint("merge"), "key", "left_semi").select("key", F.col("a").alias("fp")).distinct()
    varies = member.groupBy("key").agg(F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("v"))
    around = longs(_ball(list(range(64)), (max_bits + 1) // 2))
    steps = F.filter(around, lambda m: m.bitwiseAND(F.bitwise_not(F.col("v"))) == 0)
    point = (member.join(varies.hint("merge"), "key")
             .select("fp", F.explode(steps).alias("m"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"), F.bit_count("m").alias("d"))
             .distinct())
    # odd limits: a member at the larger radius may only meet one at the smaller
    inner = point.filter(F.col("d") <= max_bits // 2)
    first = inner.groupBy("point").agg(F.min("fp").alias("root"))
    tied = point.join(first.hint("merge"), "point").filter("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b"))
    return pairs.unionByName(tied).distinct()


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``doc_id, th, fp, root, component_id`` of every row: component_id is the smallest
    doc_id that links of ``max_bits`` or fewer differing bits reach, root the
    component's smallest fingerprint."""
    marked = cut(fingerprints(docs, shingle_words), "simhash")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = link_fingerprints(marked.select("fp").distinct(), max_bits, hot_bucket)
    labels = connected_components(links).withColumnRenamed("node", "fp")
    rooted = fps.join(labels.hint("merge"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named.hint("merge"), "root").select("fp", "root", "component_id")
    return marked.join(classes.hint("merge"), "fp")


def near_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the
    smallest id (NULL ids last), then text hash; a repeated row stays once."""
    groups = simhash_groups(docs, shingle_words, max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th"))
    best = cut(groups.groupBy("root").agg(F.min(rank).alias("w")).select("w.doc_id", "w.th"), "simhash-kept")
    # plain equality on keys without NULL, so that the window has the join's partitioning
    # and the texts are shuffled once
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    keys = [fresh(k, docs.columns) for k in ("_id", "_null", "_th")]
    at = fresh("_at", docs.columns)
    best = best.select(doc_id.alias(keys[0]), F.col("doc_id").isNull().alias(keys[1]), F.col("th").alias(keys[2]))
    keyed = docs.select("*", doc_id.alias(keys[0]), F.col("doc_id").isNull().alias(keys[1]), F.xxhash64(F.col("text").cast("string")).alias(keys[2]))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[2]))
    return keyed.join(best.hint("merge"), keys, "left_semi").withColumn(at, first).filter(F.col(at) == 1).select(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
