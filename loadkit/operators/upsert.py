"""Keyed upsert with audit columns and soft delete; append with audit.

Plain Parquet tables take no MERGE, so the upsert is a pure function
``target x source -> new target``: one full-outer equi-join on the keys (each
side shuffled once, AQE picks broadcast when a side turns out small), then one
projection decides every column. The result is written as a new snapshot by
``plans.snapshots``; on a catalog with MERGE support ``plans.runner`` can hand
the same classified source to ``DataFrame.mergeInto`` instead.

Keys must be unique and non-NULL on both sides for the rewrite to be exact.
``key_violations`` checks that with a narrow aggregate (key columns only, map-side
combine), so a hot duplicated key cannot pile up in one task.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import AuditColumns, ContractError
from loadkit.functions.exprs import any_null, ntz_literal, resolve_columns
from loadkit.operators.changes import differs, fingerprint
from loadkit.operators.conform import conform, data_columns

INSERT, UPDATE, DELETE, RESTORE, KEEP = "insert", "update", "delete", "restore", "keep"
NULL_SALTS = 4096


def null_key_salt(keys: Sequence[str], row_cols: Sequence[str]) -> Column:
    """-1 for rows with complete keys; a hash of the row in [0, NULL_SALTS) otherwise."""
    return (F.when(any_null(keys), F.pmod(F.xxhash64(*[F.col(c) for c in row_cols]), F.lit(NULL_SALTS)))
             .otherwise(F.lit(-1)).cast("int"))


ACTION_COL = "change_action"


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(violation, keys..., n_rows)`` for NULL keys and duplicated keys."""
    keys = resolve_columns(df, keys)
    k = df.select(*keys)
    nulls = (k.filter(any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("violation", F.lit("null_key")))
    dups = (k.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
             .filter(F.col("n_rows") > 1).withColumn("violation", F.lit("duplicate_key")))
    return nulls.unionByName(dups).select("violation", *keys, "n_rows")


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str, sample: int = 20) -> None:
    """Raise with up to ``sample`` offending keys if any key is duplicated (D3)."""
    keys = resolve_columns(df, keys)
    bad = (df.select(*keys).filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).limit(sample).collect())
    if bad:
        raise ContractError(f"{what} has duplicate keys", [str(r.asDict()) for r in bad])


def _ts_literal(run_ts: _dt.datetime | str, dtype: T.DataType) -> Column:
    return ntz_literal(run_ts).cast(dtype)


def upsert_frame(tgt: DataFrame, src: DataFrame, keys: Sequence[str], audit: AuditColumns,
                 load_id: str, run_ts: _dt.datetime | str, delete_flag_col: str | None = None,
                 detect_deletes: bool = False, compare: str = "exact", on_reappear: str = "restore",
                 check_keys: bool | str = "inline", key_exprs: dict[str, str] | None = None,
                 delete_scope: Column | None = None) -> DataFrame:
    """New target rows (target column order) plus ``change_action``.

    ====================  ==============  ==============  ===============  ============
    case                  data            insert audit    update audit     flag
    ====================  ==============  ==============  ===============  ============
    new key               source          run, load id    NULL             'N'
    changed               source          kept            run, load id     kept / 'N'
    unchanged             kept            kept            kept             kept
    back after delete     kept/source     kept            run, load id     'N' (restore)
    gone, detecting       kept            kept            run (on flip)    'Y'
    gone, not detecting   kept            kept            kept             kept
    ====================  ==============  ==============  ===============  ============

    Source rows with a NULL key are not applied (report them with ``key_violations``).

    ``key_exprs`` (JN6) gives key columns an expression, evaluated on both sides of the
    join (``nvl(<<tname>>.k, 'NA')`` lets a NULL meet ``'NA'``); a matched row keeps the
    target's key value, a new one brings the source's. ``delete_scope`` is a condition on
    target columns: only rows that satisfy it can be found missing.

    ``check_keys``: ``"inline"`` (default) counts rows per key in a window placed
    right before the join, so it reuses the join's hash partitioning and sort (no
    extra scan or shuffle) and fails the job on the first duplicate key;
    ``"separate"`` (or True) runs a key-only partial aggregate first and reports up
    to 20 offenders before anything runs; False trusts the source.
    """
    if detect_deletes and not delete_flag_col:
        raise ContractError("delete detection needs a flag column")
    if on_reappear not in ("restore", "keep"):
        raise ContractError(f"unknown on_reappear {on_reappear!r}")
    tcols = tgt.columns
    tkeys = resolve_columns(tgt, keys)
    aud = resolve_columns(tgt, audit.names())
    ins_ts, ins_by, upd_ts, upd_by = aud
    flag = resolve_columns(tgt, [delete_flag_col])[0] if (detect_deletes and delete_flag_col) else None
    data = data_columns(tcols, tkeys, aud, flag)

    # Conform the source to the target's names and types (strict column sets).
    s = conform(src, tgt.schema, exclude=aud + ([flag] if flag else []), order="target")
    match = tkeys if not key_exprs else [f"_k_{i}" for i in range(len(tkeys))]
    if key_exprs:
        s, tgt = with_match_keys(s, tkeys, key_exprs), with_match_keys(tgt, tkeys, key_exprs)
    if check_keys is True or check_keys == "separate":
        assert_unique_keys(s, match, "source")
    # NULL keys never match: such rows are split off before the shuffle (they would
    # all hash to one task); source ones are not applied, target ones are kept.
    s = s.filter(~any_null(match))
    join_keys = [*match, "_salt"]
    # the same salt expression as the target's (constant -1 here, as no source key is
    # NULL): a literal would be folded into a join filter and drop the salt from the
    # hash key
    s = s.withColumn("_salt", null_key_salt(match, s.columns))
    if check_keys == "inline":
        # The guard must stay in the plan: a boolean that is false exactly on
        # duplicates, raising there; the filter keeps every other row. Partitioned
        # like the join, so the join reuses its shuffle and sort.
        dup = F.count(F.lit(1)).over(Window.partitionBy(*join_keys))
        msg = F.concat(F.lit("source has duplicate key "), F.to_json(F.struct(*[F.col(k) for k in match])))
        s = s.withColumn("_dup_n", dup).filter(
            F.when(F.col("_dup_n") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))).drop("_dup_n")
    s = s.select(*join_keys, *[F.col(c).alias(f"_s_{c}") for c in [*data, *(tkeys if key_exprs else [])]], F.lit(True).alias("_in_s"))
    # one pass: NULL-key target rows get a salt (hash of the row) as an extra join
    # key, so they spread over partitions, never match, and are kept
    t = tgt.withColumn("_in_t", F.lit(True)).withColumn("_salt", null_key_salt(match, tcols))
    if delete_scope is not None:
        t = t.withColumn("_in_scope", F.coalesce(delete_scope, F.lit(False)))
    j = t.join(s, on=join_keys, how="full_outer")
    t_is_null_key = F.col("_salt") >= 0

    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    t_fp = fingerprint(data, compare)
    s_fp = fingerprint([f"_s_{c}" for c in data], compare, names=data)
    changed = differs(s_fp, t_fp, compare) if data else F.lit(False)
    was_deleted = (F.col(flag) == F.lit("Y")) if flag else F.lit(False)
    was_deleted = F.coalesce(was_deleted, F.lit(False))
    restore = F.lit(on_reappear == "restore")

    action = (F.when(in_s & ~in_t, F.lit(INSERT))
               .when(in_s & in_t & changed, F.lit(UPDATE))
               .when(in_s & in_t & was_deleted & restore, F.lit(RESTORE))
               .when(~in_s & in_t & F.lit(bool(flag)) & ~was_deleted & ~t_is_null_key
                     & (F.lit(True) if delete_scope is None else F.col("_in_scope")), F.lit(DELETE))
               .otherwise(F.lit(KEEP)))
    j = j.withColumn(ACTION_COL, action)
    a = F.col(ACTION_COL)
    take_src = a.isin(INSERT, UPDATE)
    ttypes = {f.name: f.dataType for f in tgt.schema.fields}
    now_ts = {c: _ts_literal(run_ts, ttypes[c]) for c in (ins_ts, upd_ts)}
    lid = lambda c: F.lit(load_id).cast(ttypes[c])

    out = {}
    for c in tkeys:
        out[c] = F.when(in_t, F.col(c)).otherwise(F.col(f"_s_{c}")) if key_exprs else F.col(c)
    for c in data:
        out[c] = F.when(take_src, F.col(f"_s_{c}")).otherwise(F.col(c))
    out[ins_ts] = F.when(a == INSERT, now_ts[ins_ts]).otherwise(F.col(ins_ts))
    out[ins_by] = F.when(a == INSERT, lid(ins_by)).otherwise(F.col(ins_by))
    stamp = a.isin(UPDATE, DELETE, RESTORE)
    out[upd_ts] = (F.when(a == INSERT, F.lit(None).cast(ttypes[upd_ts]))
                    .when(stamp, now_ts[upd_ts]).otherwise(F.col(upd_ts)))
    out[upd_by] = (F.when(a == INSERT, F.lit(None).cast(ttypes[upd_by]))
                    .when(stamp, lid(upd_by)).otherwise(F.col(upd_by)))
    if flag:
        reopen = restore & was_deleted & in_s
        out[flag] = (F.when(a == INSERT, F.lit("N"))
                      .when(a == DELETE, F.lit("Y"))
                      .when(reopen, F.lit("N"))
                      .otherwise(F.col(flag)).cast(ttypes[flag]))
    merged = j.select(*[out[c].alias(c) for c in tcols], a.alias(ACTION_COL))
    return merged


def upsert(tgt: DataFrame, src: DataFrame, keys: Sequence[str], audit: AuditColumns, load_id: str,
           run_ts, **kw) -> DataFrame:
    """New target content without the action column."""
    return upsert_frame(tgt, src, keys, audit, load_id, run_ts, **kw).drop(ACTION_COL)


def append_rows(tgt_schema: T.StructType, src: DataFrame, audit: AuditColumns, load_id: str,
                run_ts) -> DataFrame:
    """Rows to append: source conformed to target minus the four audit columns,
    insert audit = run time and load id, update audit NULL."""
    names = [f.name for f in tgt_schema.fields]
    aud = []
    low = {n.lower(): n for n in names}
    for a in audit.names():
        if a.lower() not in low:
            raise ContractError(f"target lacks audit column {a}")
        aud.append(low[a.lower()])
    if len(src.columns) != len(names) - 4:
        raise ContractError("source must hold every target column except the four audit columns",
                            [f"source has {len(src.columns)}, target has {len(names)}"])
    s = conform(src, tgt_schema, exclude=aud, order="target")
    ttypes = {f.name: f.dataType for f in tgt_schema.fields}
    extra = {
        aud[0]: _ts_literal(run_ts, ttypes[aud[0]]),
        aud[1]: F.lit(load_id).cast(ttypes[aud[1]]),
        aud[2]: F.lit(None).cast(ttypes[aud[2]]),
        aud[3]: F.lit(None).cast(ttypes[aud[3]]),
    }
    return s.select(*[extra[n].alias(n) if n in extra else F.col(n) for n in names])


def with_key_expressions(df: DataFrame, key_exprs: dict[str, str], alias: str = "src") -> DataFrame:
    """JN6: evaluate key expressions (``<<tname>>`` = the frame alias) into the key columns.

    ``{"languagekey": "nvl(<<tname>>.languagekey, 'NA')"}`` makes a NULL language
    match the literal ``'NA'`` on both sides of the join.
    """
    from loadkit.functions.exprs import key_expression
    d = df.alias(alias)
    cols = {name: F.expr(key_expression(tmpl, alias)) for name, tmpl in key_exprs.items()}
    resolved = dict(zip(resolve_columns(df, list(cols)), cols.values()))
    return d.select(*[resolved[c].alias(c) if c in resolved else F.col(f"{alias}.`{c}`") for c in df.columns])


def match_values(keys: Sequence[str], key_exprs: dict[str, str] | None, alias: str) -> list[Column]:
    """The value of each key that a match is decided on, for the frame or table ``alias``."""
    from loadkit.functions.exprs import key_expression
    low = {k.lower(): e for k, e in (key_exprs or {}).items()}
    unknown = sorted(set(low) - {k.lower() for k in keys})
    if unknown:
        raise ContractError("expressions of columns that are no keys", unknown)
    return [F.expr(key_expression(low[k.lower()], alias)) if k.lower() in low else F.col(f"{alias}.`{k}`") for k in keys]


def with_match_keys(df: DataFrame, keys: Sequence[str], key_exprs: dict[str, str]) -> DataFrame:
    """``df`` with ``_k_0, _k_1, ...``: the value of each key that a match is decided on."""
    d = df.alias("keyed")
    return d.select("*", *[v.alias(f"_k_{i}") for i, v in enumerate(match_values(keys, key_exprs, "keyed"))])


def merge_into(src: DataFrame, target: str, tgt_schema, keys: Sequence[str], audit: AuditColumns, load_id: str, run_ts,
               delete_flag_col: str | None = None, detect_deletes: bool = False, on_reappear: str = "restore",
               key_exprs: dict[str, str] | None = None):
    """K5/K6 for a catalog table whose source supports row-level changes: the upsert as
    one ``MERGE`` (call ``merge()`` on the result). Same rules as :func:`upsert_frame`:
    unmatched source rows are inserted, matched ones updated only if a data column
    differs or a deleted row comes back, unmatched target rows flagged once. A source row
    without a complete key is not applied; a key held twice fails the statement."""
    if on_reappear not in ("restore", "keep"):
        raise ContractError(f"unknown on_reappear {on_reappear!r}")
    names = {f.name.lower(): f.name for f in tgt_schema.fields}
    types = {f.name: f.dataType for f in tgt_schema.fields}
    own = lambda c: names[c.lower()]
    tkeys, aud = [own(k) for k in keys], [own(c) for c in audit.names()]
    flag = own(delete_flag_col) if detect_deletes and delete_flag_col else None
    data = data_columns([f.name for f in tgt_schema.fields], tkeys, aud, flag)
    s = conform(src, tgt_schema, exclude=aud + ([flag] if flag else []), order="target").alias("s")
    for v in match_values(tkeys, key_exprs, "s"):
        s = s.filter(v.isNotNull())
    here, there = (lambda c: F.col(f"s.`{c}`")), (lambda c: F.col(f"{target}.`{c}`"))
    ins_ts, ins_by, upd_ts, upd_by = aud
    stamp = {upd_ts: _ts_literal(run_ts, types[upd_ts]), upd_by: F.lit(load_id).cast(types[upd_by])}
    on, changed = F.lit(True), F.lit(False)
    for there_k, here_k in zip(match_values(tkeys, key_exprs, target), match_values(tkeys, key_exprs, "s")):
        on = on & (there_k == here_k)
    for c in data:
        changed = changed | ~there(c).eqNullSafe(here(c))
    update = {c: here(c) for c in data} | stamp
    insert = {c: here(c) for c in [*tkeys, *data]} | {ins_ts: _ts_literal(run_ts, types[ins_ts]), ins_by: F.lit(load_id).cast(types[ins_by]),
                                                      upd_ts: F.lit(None).cast(types[upd_ts]), upd_by: F.lit(None).cast(types[upd_by])}
    if flag:
        insert[flag] = F.lit("N")
        if on_reappear == "restore":
            changed = changed | there(flag).eqNullSafe(F.lit("Y"))
            update[flag] = F.lit("N")
    w = s.mergeInto(target, on).whenMatched(changed).update(update).whenNotMatched().insert(insert)
    if flag:
        w = w.whenNotMatchedBySource(~there(flag).eqNullSafe(F.lit("Y"))).update({flag: F.lit("Y")} | stamp)
    return w
