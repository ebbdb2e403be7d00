"""Classify source rows as new / changed / unchanged against a target.

The target is projected to ``keys + fingerprint`` before the join, so the
shuffle carries only what the comparison needs, and it is never broadcast:

* ``exact``       the data columns themselves, compared with ``<=>`` (null-safe,
                  type-aware; no false matches)
* ``digest``      SHA-256 of an unambiguous JSON encoding (32 bytes per row on the
                  wire; for wide targets)
* ``legacy_hash`` SHA-512 of ``concat_ws('-')``, reproducing the old behaviour
                  including its collisions (NULL positions, ``-`` inside values)

Rows with a NULL key are never matched; they get status ``null_key`` and stay in
the output so nothing is dropped silently. They are salted across partitions in
the same pass, so many NULL keys do not pile up in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.contracts import ContractError
from loadkit.functions.exprs import any_null, resolve_columns

NEW, CHANGED, UNCHANGED, NULL_KEY = "new", "changed", "unchanged", "null_key"
NULL_SALTS = 4096   # spread of NULL-key rows over shuffle partitions


def fingerprint(cols: Sequence[str], compare: str, casts: dict[str, Column] | None = None,
                names: Sequence[str] | None = None) -> Column:
    """Comparison value of the data columns; ``casts`` overrides single columns and
    ``names`` gives the field names (so both sides encode identically)."""
    casts = casts or {}
    names = list(names or cols)
    if not cols:
        return F.lit(0)   # no data columns: nothing can change
    exprs = [casts.get(c, F.col(c)).alias(n) for c, n in zip(cols, names)]
    if compare == "exact":
        return F.struct(*exprs)
    if compare == "digest":
        return F.sha2(F.to_json(F.struct(*exprs)), 256)
    if compare == "legacy_hash":
        return F.sha2(F.concat_ws("-", *[e.cast("string") for e in exprs]), 512)
    raise ContractError(f"unknown compare mode {compare!r}")


def differs(a: Column, b: Column, compare: str) -> Column:
    """True when fingerprints differ. Legacy mode keeps plain ``!=`` like the original."""
    if compare == "legacy_hash":
        return a != b
    return ~a.eqNullSafe(b)


def _casts_to(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Source columns whose type differs from the target's, cast to the target type."""
    ttypes = {f.name.lower(): f.dataType for f in tgt.schema.fields}
    stypes = {f.name: f.dataType for f in src.schema.fields}
    return {c: F.col(c).try_cast(ttypes[c.lower()]) for c in cols if stypes[c] != ttypes[c.lower()]}


def classify_changes(src: DataFrame, tgt: DataFrame, keys: Sequence[str],
                     data_cols: Sequence[str] | None = None, compare: str = "exact",
                     status_col: str = "record_status", key_exprs: dict[str, str] | None = None) -> DataFrame:
    """Source rows plus ``status_col`` in {new, changed, unchanged, null_key}.
    ``key_exprs`` as in ``upsert_frame``: the values that a match is decided on."""
    keys = resolve_columns(src, keys)
    tkeys = resolve_columns(tgt, keys)
    if key_exprs:
        from loadkit.operators.upsert import with_match_keys
        tl = {c.lower() for c in tgt.columns} - {k.lower() for k in keys}
        data_cols = [c for c in src.columns if c.lower() in tl] if data_cols is None else data_cols
        own = src.columns
        match = [f"_k_{i}" for i in range(len(keys))]
        return classify_changes(with_match_keys(src, keys, key_exprs), with_match_keys(tgt, tkeys, key_exprs), match, data_cols, compare,
                                status_col).select(*[F.col(f"`{c}`") for c in own], status_col)
    if data_cols is None:
        tl = {c.lower() for c in tgt.columns}
        data_cols = [c for c in src.columns if c not in keys and c.lower() in tl]
    data_cols = resolve_columns(src, data_cols)
    tdata = resolve_columns(tgt, data_cols)
    casts = _casts_to(src, tgt, data_cols) if compare == "exact" else {}

    # NULL keys never match. Left as they are, every NULL-key row would hash to
    # the same shuffle partition; a deterministic salt (hash of the row) joined
    # as an extra key spreads them in the same single pass, and they come back
    # unmatched with status null_key.
    def salt(key_cols, row_cols):
        # the same row expression on both sides: a literal -1 on one side would be
        # folded into a join filter and drop the salt from the hash key
        return (F.when(any_null(key_cols), F.pmod(F.xxhash64(*[F.col(c) for c in row_cols]), F.lit(NULL_SALTS)))
                 .otherwise(F.lit(-1)).cast("int"))
    t = (tgt.filter(~any_null(tkeys))
            .select(*[F.col(tk).alias(k) for tk, k in zip(tkeys, keys)], salt(tkeys, tkeys).alias("_salt"),
                    fingerprint(tdata, compare, names=data_cols).alias("_t_fp"), F.lit(True).alias("_in_t")))
    # a target key held twice would multiply source rows (D3): counted in a window that is
    # partitioned and sorted as the join is, so it costs no shuffle of its own
    told = F.concat(F.lit("target has duplicate key "), F.to_json(F.struct(*[F.col(k) for k in keys])))
    t = (t.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_salt")))
          .filter(F.when(F.col("_n") > 1, F.raise_error(told).cast("boolean")).otherwise(F.lit(True))).drop("_n"))
    s = src.withColumn("_salt", salt(keys, src.columns)).withColumn("_s_fp", fingerprint(data_cols, compare, casts))
    # the window leaves t as a sort-merge join takes it; a broadcast planned from file sizes
    # would send the fingerprints through the driver, and they do not compress as files do
    j = s.join(t.hint("merge"), on=[*keys, "_salt"], how="left")
    changed = differs(F.col("_s_fp"), F.col("_t_fp"), compare) if data_cols else F.lit(False)
    status = (F.when(F.col("_salt") >= 0, F.lit(NULL_KEY))
               .when(F.col("_in_t").isNull(), F.lit(NEW))
               .when(changed, F.lit(CHANGED))
               .otherwise(F.lit(UNCHANGED)))
    return j.select(*[F.col(c) for c in src.columns], status.alias(status_col))


def status_counts(classified: DataFrame, status_col: str = "record_status") -> DataFrame:
    """A1: rows per status (partial aggregation; a handful of output rows)."""
    return classified.groupBy(status_col).agg(F.count(F.lit(1)).alias("n_rows"))


def load_totals(classified: DataFrame, status_col: str = "record_status") -> DataFrame:
    """A2: one row with new, changed, unchanged, null-key and incremental totals."""
    s = F.col(status_col)
    cnt = lambda v: F.sum(F.when(s == v, 1).otherwise(0)).cast("long")
    return classified.agg(cnt(NEW).alias("n_new"), cnt(CHANGED).alias("n_changed"),
                          cnt(UNCHANGED).alias("n_unchanged"), cnt(NULL_KEY).alias("n_null_key"),
                          F.sum(F.when(s.isin(NEW, CHANGED), 1).otherwise(0)).cast("long").alias("n_incremental"),
                          F.count(F.lit(1)).alias("n_total"))
