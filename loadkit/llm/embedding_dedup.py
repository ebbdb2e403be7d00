"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 11).

Unit vectors are turned into the principal axes of a bounded sample (a rotation, so
every product stays what it is) and dealt into tiles of neighbours along the leading
axes. A pair of tiles is left out if the box of its leading coordinates and its largest
tails cannot reach the threshold. Within a pair the leading dimensions are multiplied
first, with the tail norms as one more dimension: the result bounds the cosine from above
(Cauchy-Schwarz on the rest), and only pairs that can still reach the threshold go on to
the next dimensions. The sample shapes the order of the work alone; no link rests on it.

Equal vectors are one vector with a count, so a vector that a third of all rows share is
compared once. A pair of tiles returns a link count and one edge of a spanning forest per
vector, never the links themselves; components come from the forests.

Defined results: a vector that is NULL, empty, zero, or holds a NULL or non-finite
component links with nothing and is its own component; vectors of different lengths do
not link; rows with equal ids are separate vectors, and rows with equal vectors link with
each other; NULL ids do not name a component unless it has no other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm.common import connected_components, cut, table

THRESHOLD = 0.9
TILE_ROWS = 4096            # vectors per tile at most about so many ...
TILE_BYTES = 16 << 20       # ... and so many bytes
SAMPLE_ROWS = 16_384        # vectors that the axes and the order of tiles are fitted on
LEAF_SAMPLE = 8             # sampled vectors per leaf of the order, at least
ENERGY = (0.35, 0.6, 0.85)  # shares of the sample's energy at which products are tested
STRIP = 256                 # rows of a tile multiplied at once
TOLD_ROWS = 1 << 21         # linked vectors of pairs of tiles that a task joins before it gives them out
SLACK = 1e-9                # rounding that a bound may be off by


def vectors(emb: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (array of doubles, NULL where it cannot link)."""
    v = F.col("embedding").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = ~F.exists(v, odd) & F.exists(v, lambda x: x != 0)
    return emb.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, v).alias("v"))


class Order:
    """Axes, test points and tile order of a sample; ``leaf`` deals vectors out."""

    def __init__(self, sample: np.ndarray, n_tiles: int):
        values, axes = np.linalg.eigh(sample.T @ sample / max(1, len(sample)))
        self.axes = np.ascontiguousarray(axes[:, ::-1])
        dim = len(values)
        share = np.cumsum(np.maximum(values[::-1], 0))
        share /= max(share[-1], 1e-300)
        self.cuts = sorted({int(min(dim, np.searchsorted(share, e) + 1)) for e in ENERGY} | {dim})
        depth = max(0, min(int(np.ceil(np.log2(max(1, n_tiles)))), int(np.log2(max(1, len(sample) // LEAF_SAMPLE)))))
        self.depth, self.medians = depth, np.zeros(1 << depth)
        lead, at = sample @ self.axes, np.ones(len(sample), np.int64)
        for level in range(depth):
            column = lead[:, level % dim]
            for node in range(1 << level, 2 << level):
                mine = column[at == node]
                self.medians[node] = np.median(mine) if len(mine) else 0
            at = at * 2 + (column > self.medians[at])

    def leaf(self, units: np.ndarray) -> np.ndarray:
        at = np.ones(len(units), np.int64)
        for level in range(self.depth):
            at = at * 2 + (units @ self.axes[:, level % units.shape[1]] > self.medians[at])
        return at


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def turned(units: np.ndarray, order: Order | None) -> tuple[np.ndarray, list[int]]:
    """Coordinates and test points; vectors of another length than the sample's keep their axes."""
    dim = units.shape[1]
    if order is not None and len(order.axes) == dim:
        return units @ order.axes, order.cuts
    return units, sorted({max(1, dim // 2), dim})


def tails(coords: np.ndarray, k: int) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", coords[:, k:], coords[:, k:]))


def near_pairs(a: np.ndarray, b: np.ndarray, cuts: list[int], threshold: float, same: bool):
    """Yield ``(i, j, product)`` of the rows whose product is at least ``threshold - SLACK``,
    a strip of ``a`` at a time; ``i < j`` if both are the same tile."""
    least, first, dim = threshold - SLACK, cuts[0], a.shape[1]
    ta, tb = {k: tails(a, k) for k in cuts}, {k: tails(b, k) for k in cuts}
    ahead = np.column_stack([b[:, :first], tb[first]]).T.copy()
    for lo in range(0, len(a), STRIP):
        hi = min(lo + STRIP, len(a))
        bound = np.column_stack([a[lo:hi, :first], ta[first][lo:hi]]) @ ahead
        where = np.flatnonzero(bound >= least)
        if len(where) * 4 > bound.size:        # most cells are near: multiply them all
            product = a[lo:hi] @ b.T
            where = np.flatnonzero(product >= least)
            i, j = np.divmod(where, len(b))
            s = product.ravel()[where]
        else:
            i, j = np.divmod(where, len(b))
            s = bound.ravel()[where] - ta[first][i + lo] * tb[first][j]
            k = first
            for nxt in [*cuts[1:], dim] if first < dim else []:
                if nxt == k:
                    continue
                for at in range(0, len(i), 1 << 16):
                    p = slice(at, at + (1 << 16))
                    s[p] += np.einsum("ij,ij->i", a[i[p] + lo, k:nxt], b[j[p], k:nxt])
                keep = s + (ta[nxt][i + lo] * tb[nxt][j] if nxt < dim else 0) >= least
                i, j, s, k = i[keep], j[keep], s[keep], nxt
            keep = s >= least
            i, j, s = i[keep], j[keep], s[keep]
        if same:
            up = j > i + lo
            i, j, s = i[up], j[up], s[up]
        if len(i):
            yield i + lo, j, s


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows as given, scaled so that no square overflows."""
    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
    dot = lambda p, q: np.einsum("ij,ij->i", p, q)
    return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of ``i`` and ``j`` in ``label`` (each entry's smallest member)."""
    while True:
        p, q = label[i], label[j]
        apart = p != q
        if not apart.any():
            return
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while True:
            flat = label[label]
            if (flat == label).all():
                break
            label[:] = flat


def tile_links(one: dict, two: dict | None, order: Order | None, threshold: float):
    """``node, links, root`` of the linked vectors of two tiles (or within one)."""
    same, other = two is None, two or one
    a, cuts = turned(unit(one["x"]), order)
    b = a if same else turned(unit(other["x"]), order)[0]
    n = len(a)
    shift = 0 if same else n
    nodes = one["node"] if same else np.concatenate([one["node"], two["node"]])
    links, label = np.zeros(len(nodes)), np.arange(len(nodes))
    for i, j, s in near_pairs(a, b, cuts, threshold, same):
        edge = np.abs(s - threshold) <= SLACK
        if edge.any():
            s[edge] = exact(one["x"][i[edge]], other["x"][j[edge]])
            keep = s >= threshold
            i, j = i[keep], j[keep]
        links += np.bincount(i, other["copies"][j], len(links)) + np.bincount(j + shift, one["copies"][i], len(links))
        merge(label, i, j + shift)
    hit = np.flatnonzero(links)
    return nodes[hit], links[hit].astype(np.int64), nodes[label[hit]]


TILE = "tile int, dim int, node binary, copies binary, x binary, lo array<double>, hi array<double>, tail double"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of one length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unpack(row: dict) -> dict:
    return {"node": np.frombuffer(row["node"], np.int64), "copies": np.frombuffer(row["copies"], np.int64).astype(float),
            "x": np.frombuffer(row["x"]).reshape(-1, row["dim"])}


def fit_order(found: DataFrame, dim: int, n: int, tile_rows: int, sample_rows: int) -> Order:
    """Order of the most common length, from about ``sample_rows`` of its vectors."""
    some = found.filter(F.size("v") == dim)
    step = max(1, n // sample_rows)
    got = some.filter(F.pmod(F.xxhash64("node"), F.lit(step)) == 0).select("v").toArrow()
    sample = unit(matrix(got.column("v"))) if got.num_rows else np.zeros((0, dim))
    return Order(sample, -(-n // tile_rows))


def tiles_of(found: DataFrame, order: Order, tile_rows: int) -> DataFrame:
    """One row per tile: its vectors packed, and the box around their leading coordinates."""
    dim = len(order.axes)

    def place(batches):
        for b in batches:
            leaf = np.zeros(b.num_rows, np.int64)
            sizes = b.column("dim").to_numpy()
            mine = np.flatnonzero(sizes == dim)
            if len(mine):
                leaf[mine] = order.leaf(unit(matrix(b.column("v").take(pa.array(mine)))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])
    placed = found.withColumn("dim", F.size("v")).mapInArrow(
        place, "node long, v array<double>, copies long, dim int, leaf long")
    placed = cut(placed, "vector-leaves")
    # a leaf larger than a tile (many near copies) is dealt out by hash
    leaves = placed.groupBy("dim", "leaf").agg(F.count("*").alias("n")).toPandas().sort_values(["dim", "leaf"])
    rows = np.minimum(tile_rows, np.maximum(256, TILE_BYTES // (8 * leaves["dim"])))
    leaves["parts"] = np.ceil(leaves["n"] / rows).astype(int)
    leaves["base"] = leaves["parts"].cumsum() - leaves["parts"]
    where = found.sparkSession.createDataFrame(
        [tuple(int(v) for v in r) for r in leaves[["dim", "leaf", "parts", "base"]].to_numpy()], "dim int, leaf long, parts int, base int")
    # few rows (at most a leaf per LEAF_SAMPLE sampled vectors, and one per other length): the vectors stay where they are
    dealt = placed.join(F.broadcast(where) if len(leaves) <= SAMPLE_ROWS else where, ["dim", "leaf"]).select(
        (F.col("base") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int").alias("tile"), "dim", "node", "copies", "v")

    def pack(t: pa.Table) -> pa.Table:
        x = np.ascontiguousarray(matrix(t.column("v")))
        coords, cuts = turned(unit(x), order)
        lead = coords[:, :cuts[0]]
        row = {"tile": t.column("tile")[0].as_py(), "dim": x.shape[1], "node": t.column("node").to_numpy().tobytes(),
               "copies": t.column("copies").to_numpy().tobytes(), "x": x.tobytes(), "lo": lead.min(axis=0), "hi": lead.max(axis=0),
               "tail": float(tails(coords, cuts[0]).max())}
        return pa.table({k: [v] for k, v in row.items()}).cast(pa.schema(
            [("tile", pa.int32()), ("dim", pa.int32()), ("node", pa.binary()), ("copies", pa.binary()), ("x", pa.binary()),
             ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("tail", pa.float64())]))
    return cut(dealt.groupBy("tile").applyInArrow(pack, TILE), "vector-tiles")


def can_link(threshold: float) -> Column:
    """Whether the boxes of tiles ``a`` and ``b`` can hold a link."""
    sides = [F.arrays_zip(F.col(f"lo_{s}").alias("lo"), F.col(f"hi_{s}").alias("hi")) for s in "ab"]
    corner = F.zip_with(*sides, lambda x, y: F.greatest(*[p * q for p in (x["lo"], x["hi"]) for q in (y["lo"], y["hi"])]))
    most = F.aggregate(corner, F.lit(0.0), lambda t, x: t + x) + F.col("tail_a") * F.col("tail_b")
    return most >= threshold - SLACK


def joined(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per node: its links summed, and one root for all that the rows connect."""
    names, at = np.unique(np.concatenate([node, root]), return_inverse=True)
    label = np.arange(len(names))
    merge(label, at[:len(node)], at[len(node):])
    total = np.zeros(len(names), np.int64)
    np.add.at(total, at[:len(node)], links)
    mine = np.unique(at[:len(node)])     # every root is a linked node, so no connection is lost
    return names[mine], total[mine], names[label[mine]]


def compare_tiles(tiles: DataFrame, order: Order, threshold: float) -> DataFrame:
    """``node, links, root`` of every pair of tiles that can hold a link. The written tiles
    are read once more for each part of them, not shuffled: every tile meets every other one,
    so shuffled copies would grow with the square of the input. A task tells each node once
    for about ``TOLD_ROWS`` rows."""
    a, b = (tiles.select(*[F.col(c).alias(f"{c}_{s}") for c in tiles.columns]) for s in "ab")
    same = F.col("dim_a") == F.col("dim_b")
    met = a.join(b.hint("shuffle_replicate_nl"), same & (F.col("tile_a") <= F.col("tile_b")) & can_link(threshold))
    own = ["tile", "dim", "node", "copies", "x"]

    def link(batches):
        told, n = [], 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in joined(*map(np.concatenate, zip(*told)))], ["node", "links", "root"])
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = ({c: batch.column(f"{c}_{s}")[k].as_py() for c in own} for s in "ab")
                same = one["tile"] == two["tile"]
                told.append(tile_links(_unpack(one), None if same else _unpack(two), order, threshold))
                n += len(told[-1][0])
                if n > TOLD_ROWS:
                    yield rows()
                    told, n = [], 0
        if n:
            yield rows()
    met = met.select(*[f"{c}_{s}" for s in "ab" for c in own])
    return cut(met.mapInArrow(link, "node long, links long, root long"), "vector-links")


def embedding_groups(emb: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS,
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``emb``."""
    rows = vectors(emb)
    # the node ids are fixed by the write
    found = cut(rows.filter(F.col("v").isNotNull()).groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
                .withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = found.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    alone = rows.filter(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if sizes:
        order = fit_order(found, sizes[0]["dim"], sizes[0]["n"], tile_rows, sample_rows)
        tiles = tiles_of(found.select("node", "v", "copies"), order, tile_rows)
        links = compare_tiles(tiles, order, threshold)
        roots = connected_components(links.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        counts = links.groupBy("node").agg(F.sum("links").alias("links"))
        rooted = (found.join(counts, "node", "left").join(roots, "node", "left")
                  .select("v", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
        named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        answer = rooted.join(named, "root").select("v", "n_links", "component_id")
        alone = alone.unionByName(rows.filter(F.col("v").isNotNull()).join(answer, "v").select("vec_id", "n_links", "component_id"))
    return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT * FROM r WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                        AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.i AS a, b.i AS b FROM v a JOIN v b ON a.i < b.i
      WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= {THRESHOLD} ELSE false END),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT i, i AS j FROM r UNION SELECT reach.i, l.b FROM reach JOIN l ON reach.j = l.a),
c AS (SELECT reach.i, min(r.vec_id) AS component_id FROM reach JOIN r ON r.i = reach.j GROUP BY reach.i)
SELECT r.vec_id, (SELECT count(*) FROM l WHERE l.a = r.i) AS n_links, c.component_id,
       r.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM r JOIN c ON r.i = c.i"""
