"""Ranked lexical search by pipelined term partitioning (operator 13).

Documents lie in blocks of similar length, items in bundles. Terms are dealt to owners,
rare ones first, so that every owner holds about as many postings. A bundle visits the
owners in turn: at each one its sparse document accumulators (one packed row per bundle
and block) are cogrouped with that owner's posting lists, which add their integer
contributions, and go on to the next owner. What is left after the last one is ranked.

Nothing is approximate. After the first owner the ten best of each item are scored to the
end; their tenth score is one that the result must reach. From then on an accumulator
goes only if its score and the greatest contributions of all terms still ahead stay below
that, and an owner opens new accumulators for an item only while what it and the later
owners can add reaches it.

Defined results: every row of ``documents`` is a document (repeated rows rank one by
one), NULL and empty texts hold no term, rows of ``benchmark`` with equal id and text are
one item, items with equal id and different texts are ranked apart; among equal scores a
NULL doc_id comes last. Items or documents without terms have no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import cut, map_slices, table, utf8

TOP = 10
OWNERS = 4                   # stages that a bundle passes
BUNDLE_ITEMS = 256
BLOCK_DOCS = 8192            # documents per block ...
BLOCK_POSTINGS = 1 << 19     # ... and postings, about
BROADCAST_ROWS = 200_000     # (item, term) rows up to which the items' side of a join is sent to all tasks
FILTER_BITS = 1 << 22        # of the filter that leaves most other terms out
SALTS = 512

#: bytes that belong to no term become blanks, A-Z become a-z
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def bit_of(term: bytes) -> int:
    return zlib.crc32(term) & (FILTER_BITS - 1)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, bundle, place, term`` of every distinct item, a row per term."""
    text = F.col("text").cast("string")
    kinds = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).distinct()

    def make():
        def one(batch):
            lists = [sorted(set(terms_of(t))) for t in utf8(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([[t.decode() for t in ts] for ts in lists], pa.list_(pa.string())),
                 pa.array([[bit_of(t) for t in ts] for ts in lists], pa.list_(pa.int32()))], ["item_id", "terms", "bits"])
        return one
    got = map_slices(kinds, make, "item_id long, terms array<string>, bits array<int>").filter(F.size("terms") > 0)
    got = cut(got.withColumn("item", F.monotonically_increasing_id()), "search-items")   # the write fixes the number
    # numbers have gaps between partitions: a bundle is a partition's run of items
    place = F.pmod("item", F.lit(BUNDLE_ITEMS)).cast("int")
    return got.select("item", "item_id", F.floor(F.col("item") / BUNDLE_ITEMS).alias("bundle"), place.alias("place"),
                      F.explode(F.arrays_zip("terms", "bits")).alias("t")).select(
        "item", "item_id", "bundle", "place", F.col("t.terms").alias("term"), F.col("t.bits").alias("bit"))


def document_terms(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, row, n, terms, tfs``: the length of every document with a term, and the
    terms (with occurrences) that pass the filter of the items' terms."""
    on = np.zeros(FILTER_BITS, np.uint8)
    on[wanted.select("bit").distinct().toArrow().column("bit").to_numpy()] = 1   # at most FILTER_BITS rows
    packed = np.packbits(on)

    def make():
        held = np.unpackbits(packed).tobytes()

        def one(batch):
            n, terms, tfs = [], [], []
            for text in utf8(batch):
                words = terms_of(text)
                found = [(t, k) for t, k in Counter(words).items() if held[bit_of(t)]]
                n.append(len(words))
                terms.append([t.decode() for t, _ in found])
                tfs.append([k for _, k in found])
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])
        return one
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = map_slices(rows, make, "doc_id long, n long, terms array<string>, tfs array<long>").filter("n > 0")
    return cut(got.withColumn("row", F.monotonically_increasing_id()), "search-documents")


def blocks_of(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``block``: documents of similar length, dealt by row."""
    kind = F.floor(F.log2("n") * 2).cast("int")
    sizes = docs.groupBy(kind.alias("kind")).agg(F.count("*").alias("docs"), F.sum(F.size("terms")).alias("postings")).orderBy("kind").collect()
    rows, base = [], 0
    for s in sizes:     # one row per half octave of lengths
        parts = max(1, -(-s["docs"] // BLOCK_DOCS), -(-s["postings"] // BLOCK_POSTINGS))
        rows.append((s["kind"], parts, base))
        base += parts
    where = F.broadcast(docs.sparkSession.createDataFrame(rows, "kind int, parts int, base int"))   # at most 128 rows
    return (docs.withColumn("kind", kind).join(where, "kind")
            .withColumn("block", (F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")).drop("kind", "parts", "base"))


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def posting_lists(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Per block a row for each term (``term, df, top, at, impacts``: packed places and
    impacts) and one with ``term`` NULL, whose ``ids`` are the doc_ids by place; places
    ascend with doc_id, NULL last."""
    def invert(t: pa.Table) -> pa.Table:
        block = t.column("block")[0].as_py()
        ids, rows = t.column("doc_id").combine_chunks(), t.column("row").to_numpy()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((rows, ids.fill_null(0).to_numpy(), null))
        t = t.take(pa.array(order))
        terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
        sizes = terms.value_lengths().to_numpy()
        place = np.repeat(np.arange(len(order), dtype=np.int64), sizes)
        words = terms.flatten().dictionary_encode()
        code = words.indices.to_numpy()
        imp = impact(tfs.flatten().to_numpy(), np.repeat(t.column("n").to_numpy(), sizes), n_docs, n_terms)
        by = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(words.dictionary)))
        out = {k: [v] for k, v in (("term", None), ("df", 0), ("top", 0), ("at", b""), ("impacts", b""), ("ids", t.column("doc_id").to_pylist()))}
        lo = 0
        for term, hi in zip(words.dictionary.to_pylist(), ends.tolist()):
            p = by[lo:hi]
            for k, v in (("term", term), ("df", hi - lo), ("top", int(imp[p].max())), ("at", place[p].astype(np.int32).tobytes()),
                         ("impacts", imp[p].astype(np.int32).tobytes()), ("ids", None)):
                out[k].append(v)
            lo = hi
        out["block"] = [block] * len(out["term"])
        return pa.table(out).select(["block", "term", "df", "top", "at", "impacts", "ids"]).cast(pa.schema(
            [("block", pa.int32()), ("term", pa.string()), ("df", pa.int64()), ("top", pa.int64()), ("at", pa.binary()),
             ("impacts", pa.binary()), ("ids", pa.list_(pa.int64()))]))
    return cut(blocks_of(docs).groupBy("block").applyInArrow(
        invert, "block int, term string, df long, top long, at binary, impacts binary, ids array<long>"), "search-lists")


def owned_terms(lists: DataFrame, wanted: DataFrame, n_docs: int, owners: int = OWNERS) -> DataFrame:
    """``bundle, place, term, w, most, owner`` of the items' terms that occur: weight, the
    greatest contribution, and the owner; rarer terms belong to earlier owners."""
    stats = lists.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"), F.max("top").alias("top"))
    ours = wanted.groupBy("term").agg(F.count("*").alias("n_items")).join(stats, "term")
    size = F.floor(F.log2("df") * 4).cast("int")
    load = {r["size"]: r["load"] for r in ours.groupBy(size.alias("size")).agg(F.sum("df").alias("load")).collect()}   # by quarter octaves
    total, seen, bounds = sum(load.values()), 0, []
    for s in sorted(load):
        seen += load[s]
        if len(bounds) < owners - 1 and seen * owners >= total * (len(bounds) + 1):
            bounds.append(s)
    owner = F.lit(0)
    for b in bounds:
        owner = owner + (size > b).cast("int")
    w = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    known = ours.select("term", w.alias("w"), (w * F.col("top")).alias("most"), owner.alias("owner"))
    return cut(wanted.select("item", "item_id", "bundle", "place", "term").join(known, "term"), "search-terms")


STATE = "bundle long, block int, items binary, at binary, scores binary"


def _state(bundle, block, items, at, scores) -> pa.Table:
    return pa.table({"bundle": pa.array([bundle], pa.int64()), "block": pa.array([block], pa.int32()), "items": [items.astype(np.int16).tobytes()],
                     "at": [at.astype(np.int32).tobytes()], "scores": [scores.astype(np.int64).tobytes()]})


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["items"], np.int16).astype(np.int64), np.frombuffer(row["at"], np.int32).astype(np.int64),
            np.frombuffer(row["scores"], np.int64))


def visit(state: DataFrame, lists: DataFrame, terms: DataFrame, small: bool = False) -> DataFrame:
    """One owner's stage: the accumulators of ``state`` after the posting lists of
    ``terms`` (``bundle, term, w, users``: struct of place and open) have been added.
    ``small``: the terms are few enough to go to the lists, else both are shuffled."""
    brought = lists.join(F.broadcast(terms) if small else terms, "term").select("bundle", "block", "w", "users", "at", "impacts")

    def add(key, held, added):
        bundle, block = key[0].as_py(), key[1].as_py()
        rows = added.to_pylist()
        items, at, scores = _opened(held.to_pylist()[0]) if held.num_rows else (np.zeros(0, np.int64),) * 3
        width = max([0, *(int(np.frombuffer(r["at"], np.int32).max()) for r in rows)] + ([int(at.max())] if len(at) else [])) + 1
        # one item at a time: its row of accumulators, written out sparsely
        by_item: dict[int, list] = {}
        for k, r in enumerate(rows):
            for u in r["users"]:
                by_item.setdefault(u["place"], []).append((k, u["open"]))
        parts = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["impacts"], np.int32).astype(np.int64) * r["w"]) for r in rows]
        order = np.argsort(items, kind="stable")
        starts = np.searchsorted(items[order], np.arange(BUNDLE_ITEMS + 1))
        out = []
        for item in sorted({*by_item, *items.tolist()}):
            mine = order[starts[item]:starts[item + 1]]
            acc, live = np.zeros(width, np.int64), np.zeros(width, bool)
            acc[at[mine]], live[at[mine]] = scores[mine], True
            for k, is_open in by_item.get(item, ()):
                where, gain = parts[k]
                acc[where] += gain
                if is_open:
                    live[where] = True
            kept = np.flatnonzero(live & (acc > 0))
            out.append((np.full(len(kept), item), kept, acc[kept]))
        return _state(bundle, block, *(np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(3)))
    return state.groupBy("bundle", "block").cogroup(brought.groupBy("bundle", "block")).applyInArrow(add, STATE)


def prune(state: DataFrame, limits: DataFrame, small: bool = False) -> DataFrame:
    """The accumulators that can still reach their item's limit (``bundle, places,
    needs``: the score that each must have by now)."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                items, at, scores = _opened(r)
                need = np.zeros(BUNDLE_ITEMS, np.int64)
                if r["places"]:
                    need[r["places"]] = r["needs"]
                keep = scores >= need[items]
                if keep.any():
                    yield from _state(r["bundle"], r["block"], items[keep], at[keep], scores[keep]).to_batches()
    return state.join(F.broadcast(limits) if small else limits, "bundle", "left").mapInArrow(run, STATE)


def leaders(state: DataFrame, lists: DataFrame, top: int = TOP) -> DataFrame:
    """``bundle, place, block, at, doc_id, score``: each item's best documents, equal
    scores by ascending doc_id. Blocks first, then salted groups of blocks, then all."""
    def best(batches):
        for b in batches:
            for r in b.to_pylist():
                items, at, scores = _opened(r)
                order = np.lexsort((at, -scores, items))
                items, at, scores = items[order], at[order], scores[order]
                nth = np.arange(len(items)) - np.searchsorted(items, items)
                k = np.flatnonzero(nth < top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["bundle"]] * len(k), pa.int64()), pa.array(items[k].astype(np.int32)), pa.array([r["block"]] * len(k), pa.int32()),
                     pa.array(at[k].astype(np.int32)), pa.array(scores[k])], ["bundle", "place", "block", "at", "score"])
    found = state.mapInArrow(best, "bundle long, place int, block int, at int, score long")
    ids = lists.filter(F.col("term").isNull()).select("block", "ids")
    found = found.join(ids, "block").select("bundle", "place", "block", "at", F.get("ids", F.col("at")).alias("doc_id"), "score")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "block", "at"]
    item = ["bundle", "place"]
    for keys in ([*item, F.pmod("block", F.lit(SALTS))], item):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return found


def _users(terms: DataFrame, is_open) -> DataFrame:
    return terms.groupBy("bundle", "term", "w").agg(F.collect_list(F.struct("place", is_open.alias("open"))).alias("users"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item."""
    spark = docs.sparkSession
    wanted = item_terms(items)
    held = document_terms(docs, wanted)
    n_docs, n_terms = held.agg(F.count("*"), F.sum("n")).first()
    schema = "item_id long, rank int, doc_id long, score long"
    if not n_docs:
        return spark.createDataFrame([], schema)
    lists = posting_lists(held, n_docs, n_terms)
    terms = owned_terms(lists, wanted, n_docs, owners)
    postings = lists.filter(F.col("term").isNotNull()).select("block", "term", "at", "impacts")
    own = lambda k: terms.filter(F.col("owner") == k)
    small = terms.count() <= BROADCAST_ROWS

    nothing = spark.createDataFrame([], STATE)
    state = cut(visit(nothing, postings, _users(own(0), F.lit(True)), small), "search-state")
    # the leaders so far, scored to the end, give each item a score that its tenth must reach
    ahead = leaders(state, lists, top)
    packed = ahead.groupBy("bundle", "block").agg(F.collect_list(F.struct("place", "at", "score")).alias("a")).select(
        "bundle", "block", "a.place", "a.at", "a.score")

    def pack(batches):
        for b in batches:
            for r in b.to_pylist():
                yield from _state(r["bundle"], r["block"], *(np.array(r[c]) for c in ("place", "at", "score"))).to_batches()
    ended = visit(packed.mapInArrow(pack, STATE), postings, _users(terms.filter("owner > 0"), F.lit(False)), small)
    goal = (leaders(ended, lists, top).filter(F.col("rank") == top).select("bundle", "place", F.col("score").alias("goal")))
    goal = cut(goal, "search-goals")

    for k in range(1, owners):
        rest = (terms.filter(F.col("owner") >= k).groupBy("bundle", "place").agg(F.sum("most").alias("rest"))
                .join(goal, ["bundle", "place"], "full").select("bundle", "place", F.coalesce("goal", F.lit(0)).alias("goal"), F.coalesce("rest", F.lit(0)).alias("rest")))
        limits = rest.groupBy("bundle").agg(F.collect_list(F.struct("place", (F.col("goal") - F.col("rest")).alias("need"))).alias("l")).select(
            "bundle", F.col("l.place").alias("places"), F.col("l.need").alias("needs"))
        mine = own(k).join(rest, ["bundle", "place"])
        state = visit(prune(state, limits, small), postings, _users(mine, F.col("rest") >= F.col("goal")), small)
    names = terms.select("bundle", "place", "item_id").distinct()
    return leaders(state, lists, top).join(names, ["bundle", "place"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{_TERM}') AS ts FROM documents),
h AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, ts FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM h),
i AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all({_LOW}, '{_TERM}')) AS ts
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT i, item_id, unnest(ts) AS t FROM i),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS t FROM h) GROUP BY ALL),
k AS (SELECT p.*, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * count(*) OVER (PARTITION BY t) + 1))) AS BIGINT) AS w,
             100 - 90 + (90 * n * nd) // l AS m
      FROM p, s WHERE t IN (SELECT t FROM q)),
c AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN k USING (t) GROUP BY ALL),
z AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM z WHERE rank <= {TOP}"""
