"""Declarative contracts: delimited feeds, XML record sets, load specs, table defs.

Contracts are small driver-side configuration objects (a few KB of JSON); they
compile into Spark schemas, reader options and column expressions. Nothing here
touches data.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any, Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class ContractError(ValueError):
    """A contract, load spec or frame does not satisfy its rules."""

    def __init__(self, message: str, violations: Iterable[str] = ()):
        self.violations = list(violations)
        super().__init__(message + ("" if not self.violations else ": " + "; ".join(self.violations)))


# ---------------------------------------------------------------------------
# Keys of the delimited mapping JSON format (must match the
# existing mapping files so they load unchanged).
MAPPING_REQUIRED_KEYS = (
    "MappingName", "SourceFileName", "SourceSystemID", "SourceFileID",
    "SourceFilePattern", "SourceFileType", "SourceExtractType", "HasHeaderRecord",
    "RecordDelimiter", "TargetTableName", "TargetDatabaseName", "TargetLoadType",
    "LoadAllIncrementalFiles", "LoadLatestFile", "TextQualifier", "Multiline",
    "EscapeChar", "DateFormat", "TimestampFormat", "SourceToTargetMapping",
)
MAPPING_COLUMN_KEYS = (
    "SourceColumnName", "SourceColumnID", "SourceDataType", "SourceDataFormat",
    "TargetColumnName", "TargetDataType",
)
# Keys of the load configuration row and of its audit-column JSON.
LOAD_SPEC_KEYS = (
    "load_id", "load_name", "src_type", "src_db_name", "src_tbl_name", "src_qry_text",
    "aud_cols_json", "key_cols_json", "tgt_db_name", "tgt_tbl_name", "tgt_upd_strategy",
    "tgt_del_flag_col_name", "identify_src_delete", "pre_tgt_load_sql", "post_tgt_load_sql",
)
AUDIT_KEYS = ("RecordInsertDate", "RecordInsertBy", "RecordUpdateDate", "RecordUpdateBy")
# Table definition keys and column keys.
TABLE_DEF_KEYS = ("TableName", "DatabaseName", "Columns")
TABLE_COLUMN_KEYS = ("ColumnID", "ColumnName", "FormattedDataType", "IsNull")
ENVIRONMENTS = ("Development", "Validation", "Production")
# ---------------------------------------------------------------------------

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _yes(v: Any) -> bool:
    return isinstance(v, str) and v.strip().lower() == "yes" or v is True


def _blank(v: Any) -> bool:
    return v is None or (isinstance(v, str) and v == "")


def parse_type(type_text: str) -> T.DataType:
    """Spark DDL type text (``decimal(15,2)``, ``date``, ``bigint``) to a DataType."""
    return T._parse_datatype_string(type_text.strip())


# ---------------------------------------------------------------------------
# Delimited feeds
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class ColumnMap:
    source: str
    target: str
    target_type: str = "string"
    source_type: str | None = None      # documentation only
    source_format: str | None = None    # documentation only


@dataclass(frozen=True)
class FeedContract:
    """A delimited feed: positional columns, reader options, load policy."""

    name: str
    columns: tuple[ColumnMap, ...]
    header: bool = False
    sep: str = ","
    quote: str | None = None
    escape: str | None = None
    multiline: bool = False                # quoted newlines declared
    date_format: str | None = None
    timestamp_format: str | None = None
    trim_leading: bool = False
    trim_trailing: bool = False
    extract_type: str = "full"             # full | incremental
    load_type: str = "overwrite"           # overwrite | append
    load_all_incremental: bool = False
    reject_bad_files: bool = False         # a file with a bad row fails whole (default: rows stay, counted)
    file_pattern: str | None = None
    system_id: str | None = None
    file_id: str | None = None
    target_db: str | None = None
    target_table: str | None = None

    @classmethod
    def from_mapping(cls, m: dict) -> "FeedContract":
        bad = validate_mapping(m)
        if bad:
            raise ContractError(f"mapping {m.get('MappingName')!r} is invalid", bad)
        cols = tuple(
            ColumnMap(source=c["SourceColumnName"], target=c["TargetColumnName"],
                      target_type=c.get("TargetDataType") or "string",
                      source_type=c.get("SourceDataType"), source_format=c.get("SourceDataFormat"))
            for c in m["SourceToTargetMapping"])
        return cls(
            name=m["MappingName"], columns=cols,
            header=_yes(m.get("HasHeaderRecord")),
            sep=m.get("RecordDelimiter") or ",",
            quote=None if _blank(m.get("TextQualifier")) else m["TextQualifier"],
            escape=None if _blank(m.get("EscapeChar")) else m["EscapeChar"],
            multiline=_yes(m.get("Multiline")),
            date_format=None if _blank(m.get("DateFormat")) else m["DateFormat"],
            timestamp_format=None if _blank(m.get("TimestampFormat")) else m["TimestampFormat"],
            trim_leading=_yes(m.get("IgnoreLeadingWhiteSpace")),
            trim_trailing=_yes(m.get("IgnoreTrailingWhiteSpace")),
            extract_type=(m.get("SourceExtractType") or "full").lower(),
            load_type=(m.get("TargetLoadType") or "overwrite").lower(),
            load_all_incremental=_yes(m.get("LoadAllIncrementalFiles")),
            file_pattern=m.get("SourceFilePattern"), system_id=m.get("SourceSystemID"),
            file_id=m.get("SourceFileID"), target_db=m.get("TargetDatabaseName"),
            target_table=m.get("TargetTableName"))

    @classmethod
    def from_json_file(cls, path: str) -> "FeedContract":
        with open(path) as fh:
            return cls.from_mapping(json.load(fh))

    def read_schema(self) -> T.StructType:
        """Positional read schema: source labels with *target* types."""
        return T.StructType([T.StructField(c.source, parse_type(c.target_type), True)
                             for c in self.columns])

    def target_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.target, parse_type(c.target_type), True)
                             for c in self.columns])

    def reader_options(self) -> dict[str, str]:
        """Options set only when the contract gives a value; quote keeps Spark's default."""
        o: dict[str, str] = {"sep": self.sep or ",", "mode": "PERMISSIVE"}
        if self.header:
            o["header"] = "true"
            o["enforceSchema"] = "false"   # headered feeds: names must match (D7)
        if self.quote:
            o["quote"] = self.quote
        if self.escape:
            o["escape"] = self.escape
        if self.multiline is True:
            o["multiLine"] = "true"
        if self.date_format:
            o["dateFormat"] = self.date_format
        if self.timestamp_format:
            o["timestampFormat"] = self.timestamp_format
        if self.trim_leading:
            o["ignoreLeadingWhiteSpace"] = "true"
        if self.trim_trailing:
            o["ignoreTrailingWhiteSpace"] = "true"
        return o

    def warnings(self) -> list[str]:
        w = []
        if self.extract_type == "incremental" and self.load_type == "overwrite" and not self.load_all_incremental:
            w.append("incremental extract with overwrite load and one file per run keeps only one file")
        return w


def validate_mapping(m: Any) -> list[str]:
    """Rules of the delimited mapping JSON; empty list means valid."""
    if not isinstance(m, dict):
        return ["mapping must be an object"]
    out = [f"missing key {k}" for k in MAPPING_REQUIRED_KEYS if k not in m]
    if out:
        return out
    stm = m["SourceToTargetMapping"]
    if not isinstance(stm, list) or not stm:
        return ["SourceToTargetMapping must be a non-empty list"]
    for i, c in enumerate(stm):
        if not isinstance(c, dict):
            out.append(f"column {i} must be an object")
            continue
        miss = [k for k in MAPPING_COLUMN_KEYS if k not in c]
        if miss:
            out.append(f"column {i} lacks {', '.join(miss)}")
            continue
        try:
            parse_type(c.get("TargetDataType") or "string")
        except Exception:
            out.append(f"column {i} has unknown type {c.get('TargetDataType')!r}")
    names = [str(c.get("TargetColumnName", "")).lower() for c in stm if isinstance(c, dict)]
    if len(names) != len(set(names)):
        out.append("duplicate target column names")
    if str(m.get("SourceExtractType", "")).lower() not in ("full", "incremental"):
        out.append(f"unknown extract type {m.get('SourceExtractType')!r}")
    return out


# ---------------------------------------------------------------------------
# XML record sets
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class XmlColumn:
    name: str
    path: str                      # slash path below the document element
    reset_on_record_out: bool = True


@dataclass(frozen=True)
class XmlRecordSet:
    name: str
    record_path: str               # slash path of the repeating record element
    columns: tuple[XmlColumn, ...]
    target_table: str | None = None
    key_columns: dict[str, str] = field(default_factory=dict)   # name -> expression with <<tname>>


@dataclass(frozen=True)
class XmlContract:
    name: str
    document_tag: str              # rowTag: one row per document element
    record_sets: tuple[XmlRecordSet, ...]
    documents_end_with: str | None = None   # "\n" or the closing tag, if that ends every document and stands nowhere else

    @classmethod
    def from_mapping(cls, m: dict, document_tag: str | None = None, documents_end_with: str | None = None) -> "XmlContract":
        bad = validate_xml_mapping(m)
        if bad:
            raise ContractError(f"XML mapping {m.get('MappingName') if isinstance(m, dict) else m!r} is invalid", bad)
        sets = []
        for rs in m["RecordSets"]:
            cols = tuple(XmlColumn(name=c["ColumnName"], path=c["ColumnXPath"],
                                   reset_on_record_out=_yes(c.get("ResetOnRecordOut", "yes")))
                         for c in rs["Columns"])
            sets.append(XmlRecordSet(name=rs.get("RecordSetName", rs["RecordXPath"]),
                                     record_path=rs["RecordXPath"], columns=cols,
                                     target_table=rs.get("TargetTableName"),
                                     key_columns=dict(rs.get("KeyColumns") or {})))
        # The document element is the first step shared by every record path.
        doc = document_tag or sets[0].record_path.split("/")[0]
        strip = lambda p: p.split("/", 1)[1] if p.split("/")[0] == doc else p
        sets = [XmlRecordSet(s.name, strip(s.record_path),
                             tuple(XmlColumn(c.name, strip(c.path), c.reset_on_record_out) for c in s.columns),
                             s.target_table, s.key_columns) for s in sets]
        return cls(name=m.get("MappingName", doc), document_tag=doc, record_sets=tuple(sets),
                   documents_end_with=documents_end_with)


# ---------------------------------------------------------------------------
# Target loads
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class AuditColumns:
    insert_ts: str
    insert_by: str
    update_ts: str
    update_by: str

    def names(self) -> list[str]:
        return [self.insert_ts, self.insert_by, self.update_ts, self.update_by]

    @classmethod
    def from_json(cls, j: str | dict) -> "AuditColumns":
        d = json.loads(j) if isinstance(j, str) else j
        miss = [k for k in AUDIT_KEYS if k not in d]
        if miss:
            raise ContractError("audit column JSON incomplete", [f"missing {k}" for k in miss])
        return cls(d["RecordInsertDate"], d["RecordInsertBy"], d["RecordUpdateDate"], d["RecordUpdateBy"])


Source = str | Callable[[SparkSession], DataFrame] | DataFrame


@dataclass(frozen=True)
class LoadSpec:
    """One target load: source, keys, audit columns, strategy, hooks."""

    load_id: str
    target: str                         # catalog name or snapshot-table path
    source: Source                      # SQL text, table name or callable
    source_type: str = "query"          # query | table | callable
    keys: tuple[str, ...] = ()
    audit: AuditColumns | None = None
    strategy: str = "merge"             # merge | insert
    delete_flag_col: str | None = None
    detect_deletes: bool = False
    pre_sql: str | None = None
    post_sql: str | None = None
    compare: str = "exact"              # exact | digest | legacy_hash
    on_reappear: str = "restore"        # restore | keep
    load_name: str | None = None
    native_merge: bool = False          # catalog target whose source supports MERGE
    quarantine: str | None = None       # snapshot-table path for source rows without a complete key
    key_exprs: dict[str, str] = field(default_factory=dict)   # key column -> expression with <<tname>>, on both sides
    rejects: str | None = None          # snapshot-table path for source rows with a value that does not cast
    partition_by: tuple[str, ...] = ()  # path target partitioned by these columns: only touched partitions are rewritten
    delete_scope: str = "table"         # table | partitions: where a row missing from the source counts as deleted
    delete_where: str | None = None     # predicate on target rows that leave with this load's commit
    delete_keys: Source | None = None   # frame (or its query) of keys whose target rows leave with this load's commit

    @classmethod
    def for_record_set(cls, rs: XmlRecordSet, target: str, source: Source, audit: AuditColumns, load_id: str, **kw) -> "LoadSpec":
        """Load of an XML record set: its key columns, each matched by its expression."""
        plain = {k: e for k, e in rs.key_columns.items() if e.replace(" ", "").lower() != f"<<tname>>.{k}".lower()}
        return cls(load_id=load_id, target=target, source=source, source_type=kw.pop("source_type", "callable" if callable(source) else "table"),
                   keys=tuple(rs.key_columns), key_exprs=plain, audit=audit, **kw)

    @classmethod
    def from_row(cls, r: dict, target: str | None = None) -> "LoadSpec":
        bad = validate_load_row(r)
        if bad:
            raise ContractError(f"load configuration {r.get('load_id')!r} is invalid", bad)
        keys = tuple(json.loads(r["key_cols_json"]).values())
        src_type = r["src_type"].lower()
        source = r["src_qry_text"] if src_type == "query" else f"{r['src_db_name']}.{r['src_tbl_name']}"
        return cls(load_id=str(r["load_id"]), load_name=r.get("load_name"),
                   target=target or f"{r['tgt_db_name']}.{r['tgt_tbl_name']}",
                   source=source, source_type=src_type, keys=keys,
                   audit=AuditColumns.from_json(r["aud_cols_json"]),
                   strategy=r["tgt_upd_strategy"].lower(),
                   delete_flag_col=r.get("tgt_del_flag_col_name") or None,
                   detect_deletes=_yes(r.get("identify_src_delete")),
                   pre_sql=r.get("pre_tgt_load_sql") or None,
                   post_sql=r.get("post_tgt_load_sql") or None)

    def removes_rows(self) -> bool:
        return self.delete_where is not None or self.delete_keys is not None

    def validate(self) -> list[str]:
        out = []
        if self.source_type not in ("query", "table", "callable"):
            out.append(f"unknown source type {self.source_type!r}")
        if self.strategy not in ("merge", "insert"):
            out.append(f"unknown update strategy {self.strategy!r}")
        if self.strategy == "merge" and not self.keys:
            out.append("merge needs key columns")
        if self.audit is None:
            out.append("audit columns missing")
        if self.detect_deletes and not self.delete_flag_col:
            out.append("delete detection needs a flag column")
        if self.compare not in ("exact", "digest", "legacy_hash"):
            out.append(f"unknown compare mode {self.compare!r}")
        if self.on_reappear not in ("restore", "keep"):
            out.append(f"unknown on_reappear {self.on_reappear!r}")
        if self.partition_by and (self.strategy != "merge" or "/" not in self.target):
            out.append("a partitioned target is a path loaded by merge")
        if self.removes_rows() and (self.strategy != "merge" or "/" not in self.target or self.partition_by):
            out.append("rows are removed with the commit of a merge into a snapshot table only")
        if self.delete_scope not in ("table", "partitions"):
            out.append(f"unknown delete scope {self.delete_scope!r}")
        if self.delete_scope == "partitions" and not self.partition_by:
            out.append("delete scope partitions needs a partitioned target")
        out += [f"expression of {k}, which is no key" for k in self.key_exprs if k.lower() not in {c.lower() for c in self.keys}]
        return out


def validate_load_row(r: dict) -> list[str]:
    """Consistency rules of a load configuration row (catalog checks excluded)."""
    out = [f"missing key {k}" for k in LOAD_SPEC_KEYS if k not in r]
    if out:
        return out
    st = (r["src_type"] or "").lower()
    if st not in ("query", "table"):
        out.append(f"source type must be query or table, got {r['src_type']!r}")
    if st == "query" and _blank(r["src_qry_text"]):
        out.append("query source without query text")
    if st == "table" and (_blank(r["src_db_name"]) or _blank(r["src_tbl_name"])):
        out.append("table source without database and table")
    for k in ("aud_cols_json", "key_cols_json", "tgt_upd_strategy", "identify_src_delete",
              "tgt_db_name", "tgt_tbl_name"):
        if _blank(r[k]):
            out.append(f"{k} is empty")
    if not _blank(r["aud_cols_json"]):
        try:
            AuditColumns.from_json(r["aud_cols_json"])
        except Exception as e:  # noqa: BLE001
            out.append(f"aud_cols_json: {e}")
    if not _blank(r["key_cols_json"]):
        try:
            if not json.loads(r["key_cols_json"]):
                out.append("key_cols_json has no columns")
        except Exception:
            out.append("key_cols_json is not JSON")
    if _yes(r["identify_src_delete"]) and _blank(r["tgt_del_flag_col_name"]):
        out.append("delete detection needs tgt_del_flag_col_name")
    if (r["tgt_upd_strategy"] or "").lower() not in ("merge", "insert"):
        out.append(f"unknown update strategy {r['tgt_upd_strategy']!r}")
    return out


def validate_target_columns(target_cols: Iterable[str], spec: LoadSpec) -> list[str]:
    """Target must hold every audit, key and flag column (case-insensitive)."""
    have = {c.lower() for c in target_cols}
    need = list(spec.keys) + (spec.audit.names() if spec.audit else [])
    if spec.detect_deletes and spec.delete_flag_col:
        need.append(spec.delete_flag_col)
    return [f"target lacks column {c}" for c in need if c.lower() not in have]


# ---------------------------------------------------------------------------
# Table definitions
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class TableColumn:
    name: str
    type: str
    nullable: bool = True
    description: str | None = None


@dataclass(frozen=True)
class TableDef:
    database: str
    table: str
    columns: tuple[TableColumn, ...]
    external: bool = False
    location: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    format: str = "parquet"

    @classmethod
    def from_json(cls, d: dict) -> "TableDef":
        """From a definition script; beside its keys ``Location`` and ``Format`` (default
        parquet) may be given."""
        bad = validate_table_def(d)
        if bad:
            raise ContractError(f"table definition {d.get('TableName')!r} is invalid", bad)
        cols = tuple(TableColumn(c["ColumnName"], c["FormattedDataType"], _flag(c["IsNull"]), c.get("Description") or None)
                     for c in d["Columns"])
        return cls(database=d["DatabaseName"], table=d["TableName"], columns=cols, external=_flag(d.get("IsExternal", False)),
                   location=d.get("Location"), properties=dict(d.get("TableProperties") or {}), format=d.get("Format", "parquet"))

    def qualified(self) -> str:
        return f"{self.database}.{self.table}"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, parse_type(c.type), c.nullable) for c in self.columns])


def _flag(v: Any) -> bool:
    return v.strip().lower() in ("yes", "true") if isinstance(v, str) else bool(v)


def validate_table_def(d: Any) -> list[str]:
    if not isinstance(d, dict):
        return ["table definition must be an object"]
    out = [f"missing key {k}" for k in TABLE_DEF_KEYS if k not in d]
    if out:
        return out
    if not isinstance(d["Columns"], list) or not d["Columns"]:
        return ["Columns must be a non-empty list"]
    for i, c in enumerate(d["Columns"]):
        miss = [k for k in TABLE_COLUMN_KEYS if not isinstance(c, dict) or k not in c]
        if miss:
            out.append(f"column {i} lacks {', '.join(miss)}")
            continue
        try:
            parse_type(c["FormattedDataType"])
        except Exception:
            out.append(f"column {i} has unknown type {c['FormattedDataType']!r}")
    for k in ("DatabaseName", "TableName"):
        if not isinstance(d[k], str) or not _IDENT.match(d[k]):
            out.append(f"{k} must be an identifier")
    return out


def validate_xml_mapping(m: Any) -> list[str]:
    """Rules of the XML mapping JSON; empty list means valid."""
    if not isinstance(m, dict) or not isinstance(m.get("RecordSets"), list) or not m.get("RecordSets"):
        return ["RecordSets must be a non-empty list"]
    out = []
    for i, rs in enumerate(m["RecordSets"]):
        if not isinstance(rs, dict) or not rs.get("RecordXPath"):
            out.append(f"record set {i} lacks RecordXPath")
            continue
        cols = rs.get("Columns")
        if not isinstance(cols, list) or not cols:
            out.append(f"record set {i} has no Columns")
            continue
        out += [f"record set {i} column {j} lacks {k}" for j, c in enumerate(cols) for k in ("ColumnName", "ColumnXPath") if not isinstance(c, dict) or not c.get(k)]
        names = [str(c.get("ColumnName")).lower() for c in cols if isinstance(c, dict)]
        if len(names) != len(set(names)):
            out.append(f"record set {i} has duplicate column names")
    return out


def check_identifier(name: str) -> str:
    """Validate a (possibly qualified) identifier before it is placed in SQL text."""
    parts = name.split(".")
    if not parts or not all(_IDENT.match(p) for p in parts):
        raise ContractError(f"not an identifier: {name!r}")
    return name
