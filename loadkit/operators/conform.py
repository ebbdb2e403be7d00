"""Conform a frame to a target schema (rename, re-type, column-set checks).

One projection of ``try_cast`` per column: Catalyst keeps it in whole-stage
codegen and prunes nothing the target needs. Failed casts (a non-NULL value that
becomes NULL) can be reported per row in ``error_col``.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import ContractError, FeedContract


def _lower_map(names: Iterable[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    for n in names:
        if n.lower() in out:
            raise ContractError(f"columns differ only by case: {out[n.lower()]}, {n}")
        out[n.lower()] = n
    return out


def cast_to(c: Column, src_type: T.DataType, dst_type: T.DataType) -> Column:
    if src_type == dst_type:
        return c
    return c.try_cast(dst_type)


def column_set_violations(source_cols: Sequence[str], target_cols: Sequence[str]) -> list[str]:
    s, t = _lower_map(source_cols), _lower_map(target_cols)
    out = [f"source lacks {t[k]}" for k in t if k not in s]
    out += [f"target lacks {s[k]}" for k in s if k not in t]
    return out


def conform(df: DataFrame, target_schema: T.StructType, exclude: Iterable[str] = (),
            order: str = "target", strict: bool = True, error_col: str | None = None) -> DataFrame:
    """Rename/re-type ``df`` to ``target_schema`` minus ``exclude``.

    Names resolve case-insensitively. ``strict`` requires equal column sets;
    otherwise missing target columns become typed NULLs and extra source columns
    are dropped. ``order`` is ``"target"`` or ``"source"``.
    """
    excl = {e.lower() for e in exclude}
    tfields = [f for f in target_schema.fields if f.name.lower() not in excl]
    tmap = {f.name.lower(): f for f in tfields}
    smap = _lower_map(df.columns)
    if strict:
        bad = column_set_violations(df.columns, [f.name for f in tfields])
        if bad:
            raise ContractError("source and target column sets differ", bad)
    stypes = {f.name: f.dataType for f in df.schema.fields}
    if order == "source":
        names = [tmap[smap[k].lower()].name for k in smap if k in tmap]
        names += [f.name for f in tfields if f.name.lower() not in smap]
    else:
        names = [f.name for f in tfields]
    exprs, failed = [], []
    for name in names:
        f = tmap[name.lower()]
        src = smap.get(name.lower())
        if src is None:
            exprs.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        e = cast_to(F.col(f"`{src}`"), stypes[src], f.dataType)
        exprs.append(e.alias(f.name))
        if error_col and stypes[src] != f.dataType:
            failed.append(F.when(F.col(f"`{src}`").isNotNull() & e.isNull(), F.lit(f.name)))
    out = df.select(*exprs)
    if error_col:
        arr = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else F.array().cast("array<string>")
        out = df.select(*exprs, arr.alias(error_col))
    return out


def apply_mapping(df: DataFrame, contract: FeedContract) -> DataFrame:
    """``source AS target`` in mapping order (positional labels to target names)."""
    return df.select(*[F.col(f"`{c.source}`").alias(c.target) for c in contract.columns])


def data_columns(target_cols: Sequence[str], keys: Sequence[str], audit: Sequence[str] = (),
                 flag: str | None = None) -> list[str]:
    """P5: data columns = all - keys - audit - flag (case-insensitive)."""
    drop = {c.lower() for c in [*keys, *audit, *([flag] if flag else [])]}
    return [c for c in target_cols if c.lower() not in drop]
