"""Column expressions used across operators. All JVM-side built-ins."""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.contracts import ContractError, check_identifier


# ---------------------------------------------------------------- path helpers
def basename(path: Column) -> Column:
    """Last segment of a slash path."""
    return F.substring_index(path, "/", -1)


def literal_prefix(pattern: str) -> str:
    """Part of a wildcard pattern before its first ``*`` (whole pattern when none)."""
    i = pattern.find("*")
    return pattern if i < 0 else pattern[:i]


# ---------------------------------------------------------------- time helpers
def instance_key(ts: Column, system: Column, name: Column) -> Column:
    """File-instance natural key: ``yyyyMMdd.HHmmss.SSSSSS`` + system + file name."""
    return F.concat_ws(".", F.date_format(ts, "yyyyMMdd.HHmmss.SSSSSS"), system, name)


def padded_run_id(system_id: Column, entity_id: Column, inst_no: Column) -> Column:
    """Repeatable run id ``%05d.%05d.%010d`` of system, entity and instance numbers."""
    return F.format_string("%05d.%05d.%010d", system_id.cast("int"), entity_id.cast("int"),
                           inst_no.cast("long"))


def nonempty_row(cols: Iterable[str]) -> Column:
    """True when at least one column is non-NULL and not the empty string."""
    conds = [F.col(c).isNotNull() & (F.col(c).cast("string") != F.lit("")) for c in cols]
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def any_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))


# ---------------------------------------------------------------- SQL text helpers
_PLACEHOLDER = re.compile(r"<<([A-Za-z_][A-Za-z0-9_]*)>>")


def substitute(sql: str, names: dict[str, str]) -> str:
    """Replace ``<<source>>``-style placeholders with validated identifiers."""
    def rep(m: re.Match) -> str:
        key = m.group(1)
        if key not in names:
            raise ContractError(f"unknown placeholder <<{key}>>")
        return check_identifier(names[key])
    return _PLACEHOLDER.sub(rep, sql)


def key_expression(template: str, alias: str) -> str:
    """Key expression with ``<<tname>>`` standing for the frame alias (e.g. null-safe keys)."""
    return template.replace("<<tname>>", check_identifier(alias))


# ---------------------------------------------------------------- name resolution
def resolve_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Map requested names onto the frame's columns case-insensitively."""
    lower = {}
    for c in df.columns:
        if c.lower() in lower:
            raise ContractError(f"frame has columns differing only by case: {c}")
        lower[c.lower()] = c
    out, missing = [], []
    for n in names:
        if n.lower() in lower:
            out.append(lower[n.lower()])
        else:
            missing.append(n)
    if missing:
        raise ContractError("columns not found", missing)
    return out


def ntz_literal(value) -> Column:
    """A zone-free timestamp literal. ``F.lit(datetime)`` would pass through the
    Python process zone and the session zone; text cast to NTZ does not."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")
