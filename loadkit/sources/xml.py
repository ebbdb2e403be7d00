"""XML documents flattened into record sets.

One scan with Spark's ``xml`` source (``rowTag`` = document element) reads every
document of every file, one semantics whatever the number of files or cores:
namespace prefixes, comments, CDATA and spaced closing tags are the parser's
business. The schema is compiled from the contract's column paths, so no inference
pass runs. A document that does not parse keeps its text in ``_corrupt_record`` and is
counted per file (`document_outcomes`); a file in which no document is found has no
row there.

A record set is the document row exploded down its record path. Before each explode
only the values still needed and the one array to explode are kept, so no ancestor
travels with its records and the work is linear in them. A parent field placed after
its children is still seen, text split by entities or newlines arrives whole, and
nothing carries over between documents or files. The source reads a file in one task.

A contract can declare ``documents_end_with``, a text that ends every document and stands
nowhere else: a newline (one document a line) or the closing tag as it is written. Such
files are read by the text source, split anywhere, and each piece is parsed by
``from_xml`` with the same schema and rules, so one large file is as parallel as many
small ones. A piece that breaks the declaration (two documents, an end without a
beginning, a file cut off in its last document) counts as unparsable.

Paths are slash-separated below the document element; a path segment that is
(a prefix of) some record path is a repeating element (array), others are
single elements, leaves are strings.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import ContractError, XmlContract, XmlRecordSet
from loadkit.functions.exprs import nonempty_row
from loadkit.session import scratch_path

SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"


def _split(path: str) -> list[str]:
    return [p for p in path.strip("/").split("/") if p]


def contract_schema(contract: XmlContract) -> T.StructType:
    """Nested read schema covering every column path of every record set."""
    repeating = set()
    for rs in contract.record_sets:
        segs = _split(rs.record_path)
        for i in range(1, len(segs) + 1):
            repeating.add(tuple(segs[:i]))
    tree: dict = {}
    for rs in contract.record_sets:
        for seg_path in [_split(c.path) for c in rs.columns] + [_split(rs.record_path)]:
            node = tree
            for s in seg_path:
                node = node.setdefault(s, {})

    def build(node: dict, prefix: tuple) -> T.StructType:
        fields = []
        for name, child in node.items():
            p = prefix + (name,)
            if child:
                dt: T.DataType = build(child, p)
            else:
                dt = T.StringType()
            if p in repeating:
                if not isinstance(dt, T.StructType):
                    dt = T.StructType([])
                dt = T.ArrayType(dt)
            fields.append(T.StructField(name, dt, True))
        return T.StructType(fields)

    return build(tree, ())


def _split_documents(spark: SparkSession, paths: list[str], contract: XmlContract, schema: T.StructType) -> DataFrame:
    """The documents of files whose documents all end with one declared text."""
    end, by_line = contract.documents_end_with, contract.documents_end_with in ("\n", "\r\n")
    tag = r"(?:[\w.-]+:)?" + re.escape(contract.document_tag) + r"[\s/>]"
    raw = spark.read.option("lineSep", end).text(paths)
    text = F.col("value") if by_line else F.concat("value", F.lit(end))
    # comments and CDATA may hold anything, also a tag
    bare = F.regexp_replace("value", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    n_begins = F.regexp_count(bare, F.lit("<" + tag))
    ahead = rf"(?s)^(?:[^<]++|<!--.*?-->|<\?.*?\?>|<!(?!--)[^>]*+>|<(?!{tag}|!|\?)[^>]*+>)*+"
    doc = F.regexp_replace(text, ahead, "")
    parsed = F.from_xml(F.when(n_begins == 1, doc), schema.simpleString(),
                        {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kind = F.when(n_begins == 0, "none").when(n_begins == 1, "one").otherwise("many")
    rows = raw.select(parsed.alias("d"), kind.alias("_kind"), "value", (F.octet_length("value") + len(end.encode())).alias("_bytes"),
                      F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_size").alias("_file_size"))
    if by_line:
        rows = rows.filter("_kind <> 'none'")      # declarations, wrappers, blank lines
    own = [F.col(f"d.`{f.name}`").alias(f.name) for f in schema.fields if f.name != CORRUPT]
    corrupt = F.when(F.col("_kind") == "many", F.col("value")).otherwise(F.col(f"d.{CORRUPT}"))
    return rows.select(*own, corrupt.alias(CORRUPT), SOURCE_FILE, *([] if by_line else ["_kind", "_bytes", "_file_size"]))


def read_documents(spark: SparkSession, paths: str | Sequence[str], contract: XmlContract,
                   with_source_file: bool = False) -> DataFrame:
    """One row per document element, with the text of one that does not parse in
    ``_corrupt_record``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = T.StructType(contract_schema(contract).fields + [T.StructField(CORRUPT, T.StringType())])
    if contract.documents_end_with:
        docs = _split_documents(spark, paths, contract, schema)
        return docs if with_source_file else docs.drop(SOURCE_FILE)
    df = (spark.read.format("xml").option("rowTag", contract.document_tag)
               .option("ignoreNamespace", "true").option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).load(paths))
    if with_source_file:
        df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return df


def document_outcomes(docs: DataFrame) -> DataFrame:
    """Documents and unparsable documents per source file."""
    corrupt = F.sum(F.when(F.col(CORRUPT).isNotNull(), 1).otherwise(0)).cast("long")
    if "_kind" not in docs.columns:
        return docs.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n_documents"), corrupt.alias("n_rejects"))
    # pieces that end with the closing tag: one without a document may follow the last,
    # and the last may not itself lack the tag
    got = docs.groupBy(SOURCE_FILE).agg(
        F.sum(F.when(F.col("_kind") != "none", 1).otherwise(0)).cast("long").alias("n_documents"), corrupt.alias("_corrupt"),
        F.sum(F.when(F.col("_kind") == "none", 1).otherwise(0)).cast("long").alias("_rest"), (F.sum("_bytes") > F.max("_file_size")).alias("_open"))
    cut_off = F.when(F.col("_open") & (F.col("_rest") == 0), 1).otherwise(0)
    stray = F.greatest(F.lit(0), F.col("_rest") - F.col("_open").cast("int"))
    return got.select(SOURCE_FILE, "n_documents", (F.col("_corrupt") + cut_off + stray).cast("long").alias("n_rejects"))


def flatten_record_set(docs: DataFrame, rs: XmlRecordSet, keep: Sequence[str] = ()) -> DataFrame:
    """Explode ``docs`` down ``rs.record_path``; each column is taken at its nearest
    exploded ancestor and carried from there. All-empty records are dropped (P10)."""
    segs = _split(rs.record_path)
    if not segs:
        raise ContractError(f"record set {rs.name} has an empty record path")
    taken: dict[int, list] = {}
    for c in rs.columns:
        p = _split(c.path)
        k = 0
        while k < len(p) and k < len(segs) and p[k] == segs[k]:
            k += 1
        taken.setdefault(k, []).append((c.name, p[:k], p[k:]))

    def values(level: int, base: Column | None) -> list[Column]:
        return [_value(base, rest, docs.schema, prefix).alias(name) for name, prefix, rest in taken.get(level, [])]

    good = docs.filter(F.col(CORRUPT).isNull()) if CORRUPT in docs.columns else docs
    carried = [F.col(k) for k in keep]
    cur = good.select(*carried, *values(0, None), F.col(f"`{segs[0]}`").alias("_next"))
    carried += [F.col(f"`{name}`") for name, _, _ in taken.get(0, [])]
    for i in range(1, len(segs) + 1):
        cur = cur.select(*carried, F.explode("_next").alias("_at"))
        step = [F.col("_at").getField(segs[i]).alias("_next")] if i < len(segs) else []
        cur = cur.select(*carried, *values(i, F.col("_at")), *step)
        carried += [F.col(f"`{name}`") for name, _, _ in taken.get(i, [])]
    res = cur.select(*[F.col(f"`{c.name}`") for c in rs.columns], *[F.col(k) for k in keep])
    return res.filter(nonempty_row([c.name for c in rs.columns]))


def _value(base: Column | None, rest: Sequence[str], schema: T.StructType, prefix: Sequence[str]) -> Column:
    """Walk ``rest`` from ``base``; arrays met on the way (non-ancestor repeats) yield
    their last element, matching "last value seen" for such paths."""
    dt: T.DataType = schema
    for s in prefix:
        dt = _child_type(dt, s)
        if isinstance(dt, T.ArrayType):
            dt = dt.elementType
    expr = base
    for s in rest:
        dt = _child_type(dt, s)
        expr = F.col(f"`{s}`") if expr is None else expr.getField(s)
        if isinstance(dt, T.ArrayType):
            expr = F.element_at(expr, -1)
            dt = dt.elementType
    if not isinstance(dt, T.StringType):
        expr = expr.cast("string")
    return expr


def _child_type(dt: T.DataType, name: str) -> T.DataType:
    if isinstance(dt, T.ArrayType):
        dt = dt.elementType
    if not isinstance(dt, T.StructType) or name not in dt.names:
        raise ContractError(f"path step {name!r} not in schema")
    return dt[name].dataType


def load_xml_recordsets(spark: SparkSession, paths: str | Sequence[str], contract: XmlContract,
                        with_source_file: bool = False, materialize: bool | None = None,
                        documents: bool = False) -> dict[str, DataFrame]:
    """``{record set name: all-string DataFrame}``; ``documents`` adds the parsed
    documents under the name ``""``.

    Documents are parsed once: with several record sets (``materialize`` default) the
    parsed documents are written as Parquet to the shared work folder, and every record
    set reads only the columns it needs of them.
    """
    docs = read_documents(spark, paths, contract, with_source_file or documents)
    if materialize if materialize is not None else len(contract.record_sets) > 1 or documents:
        path = scratch_path(spark, "xml_documents")
        docs.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    keep = [SOURCE_FILE] if with_source_file else []
    sets = {rs.name: flatten_record_set(docs, rs, keep) for rs in contract.record_sets}
    return {**sets, "": docs} if documents else sets
