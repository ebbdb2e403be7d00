"""Create tables from JSON column definitions.

DDL text is generated from validated identifiers and parsed types; each table
is created only if absent. Failures are collected and raised together instead
of being swallowed.
"""

from __future__ import annotations

import json
from typing import Iterable

from pyspark.sql import SparkSession

from loadkit.contracts import ENVIRONMENTS, ContractError, TableDef, check_identifier, parse_type


FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


def merge_properties(default: dict[str, str], specific: dict[str, str]) -> dict[str, str]:
    """Table-specific properties win over environment defaults."""
    out = dict(default or {})
    out.update(specific or {})
    return out


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(t: TableDef, defaults: dict[str, str] | None = None) -> str:
    """K8: ``CREATE [EXTERNAL] TABLE IF NOT EXISTS`` statement for one definition."""
    check_identifier(t.qualified())
    cols = []
    for c in t.columns:
        check_identifier(c.name)
        parse_type(c.type)
        col = f"`{c.name}` {c.type}"
        if not c.nullable:
            col += " NOT NULL"
        if c.description:
            col += f" COMMENT {_quote(c.description)}"
        cols.append(col)
    if t.external and not t.location and t.format in FILE_FORMATS:
        raise ContractError(f"external table {t.qualified()} needs a location")
    props = merge_properties(defaults or {}, t.properties)
    ddl = (f"CREATE {'EXTERNAL ' if t.external else ''}TABLE IF NOT EXISTS {t.qualified()} "
           f"({', '.join(cols)}) USING {check_identifier(t.format)}")
    if t.location:
        ddl += f" LOCATION {_quote(t.location)}"
    if props:
        ddl += " TBLPROPERTIES (" + ", ".join(f"{_quote(k)} = {_quote(str(v))}" for k, v in props.items()) + ")"
    return ddl


def environment_properties(config: dict, env: str) -> dict[str, str]:
    """Default properties of an environment from a ``{environment: {...}}`` document."""
    if env not in ENVIRONMENTS:
        raise ContractError(f"environment must be one of {ENVIRONMENTS}, got {env!r}")
    if env not in config:
        raise ContractError(f"no default properties for {env}")
    return dict(config[env])


def create_tables(spark: SparkSession, defs: Iterable[TableDef | dict], defaults: dict | None = None,
                  create_databases: bool = True) -> list[str]:
    """K9: create every table; raise one error listing every failure."""
    created, failures = [], []
    for d in defs:
        try:
            t = d if isinstance(d, TableDef) else TableDef.from_json(d)
            if create_databases:
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {check_identifier(t.database)}")
            spark.sql(table_ddl(t, defaults))
            created.append(t.qualified())
        except Exception as e:  # noqa: BLE001 - collected and re-raised below
            name = d.qualified() if isinstance(d, TableDef) else f"{d.get('DatabaseName')}.{d.get('TableName')}"
            failures.append(f"{name}: {e}")
    if failures:
        raise ContractError("table creation failed", failures)
    return created


def read_json(spark: SparkSession, path: str):
    """A small JSON document from any file system that Spark reads."""
    rows = spark.read.option("wholetext", "true").text(path).collect()
    if len(rows) != 1:
        raise ContractError(f"{path} holds {len(rows)} documents, expected one")
    return json.loads(rows[0]["value"])


def load_table_defs(spark: SparkSession, path: str) -> list[dict]:
    """Table definitions from a JSON file (one object or a list)."""
    doc = read_json(spark, path)
    return doc if isinstance(doc, list) else [doc]


def load_table_list(spark: SparkSession, path: str, folder: str) -> list[dict]:
    """Definitions of a ``TableList`` document: the scripts it names, below ``folder``."""
    doc = read_json(spark, path)
    entries = doc.get("TableList") if isinstance(doc, dict) else None
    if not isinstance(entries, list) or not entries:
        raise ContractError(f"{path} has no TableList")
    bad = [f"entry {i} lacks ScriptFileName" for i, e in enumerate(entries) if not isinstance(e, dict) or not e.get("ScriptFileName")]
    if bad:
        raise ContractError(f"{path} is invalid", bad)
    return [d for e in entries for d in load_table_defs(spark, f"{folder.rstrip('/')}/{e['ScriptFileName']}")]
