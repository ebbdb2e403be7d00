"""Recurring lines by a log-template tree (operator 4).

A line falls down a tree of fixed depth: by its number of tokens, then by its first
``DEPTH`` tokens, where a token with a digit counts as a variable field. In a leaf
that enough documents reach, a position's token is fixed if at least ``min_docs``
documents have it there, else it is a variable field too; lines with the same fixed
tokens share a template, provided that at least ``FIXED_SHARE`` of their tokens are
fixed (a line with less keeps to itself).

A template recurs if at least ``min_docs`` unrelated documents hold it, counted in two
ways. A document is known by its two longest other lines (their leaves); it is unrelated
to the template's first document if they have none of these in common, and documents
known by the same lines are one. That alone says nothing of documents whose long lines
all recur (a notice and a licence in each of them). So documents are told apart by their
rare lines too, those in leaves that fewer than ``min_docs`` documents reach: documents
whose rare lines are ``OWN_SHARE`` of their lines or of their characters count by their
longest rare leaf and by that of least hash, whichever gives fewer. So copies of a document, exact or with
an edited line, do not make its own sentences recur; they are left to near-duplicate
removal. Recurring templates' lines are dropped wherever they stand. Lines of fewer than
``DEPTH`` tokens stay.

Everything is grouping and equi-joins on hashes of leaves, lines and templates; a
leaf's lines are never in one task.

Defined results: NULL stays NULL; a text whose lines all go becomes empty; blank
lines stay; repeated rows are one document, and all of them lose the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm.common import cut, fresh, table, text_rows

DEPTH = 3
MIN_DOCS = 10
FIXED_SHARE = 0.6
OWN_SHARE = 0.25
FIELD = "<*>"


def n_tokens(plain: Column) -> Column:
    return F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1


def is_deep(plain: Column) -> Column:
    """``DEPTH`` tokens or more."""
    return F.substring_index(plain, " ", DEPTH - 1) != plain


def leaf(plain: Column) -> Column:
    first = F.substring_index(plain, " ", DEPTH)
    fields = F.when(first.rlike("[0-9]"), F.regexp_replace(first, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(first)
    return F.xxhash64(n_tokens(plain), F.split(fields, " "))


def line_rows(rows: DataFrame) -> DataFrame:
    """``doc_id, th, line, plain, leaf, known_by`` of every non-blank line: as it is; its
    tokens with one space between; its leaf; leaves of the (up to two) longest lines of
    its document with another leaf, in order."""
    spaced = lambda x: F.when(x.rlike(r"[\x09\x0B-\x0D]"), F.regexp_replace(x, r"[\x09\x0B-\x0D]", " ")).otherwise(x)
    found = rows.select("doc_id", "th", F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("line"), F.trim(spaced(x)).alias("plain"))).alias("lines"))
    found = found.select("doc_id", "th", F.filter("lines", lambda x: x["plain"] != "").alias("lines"))
    single = lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x)
    found = found.select("doc_id", "th", F.transform("lines", lambda x: F.struct(x["line"].alias("line"), single(x["plain"]).alias("plain"))).alias("lines"))
    found = found.select("doc_id", "th", "lines", F.transform("lines", lambda x: leaf(x["plain"])).alias("leaves"))
    sized = F.transform("lines", lambda x, i: F.struct((-F.length(x["line"])).alias("n"), i.alias("i"), F.get("leaves", i).alias("leaf")))
    found = found.select("doc_id", "th", "lines", "leaves", F.array_distinct(F.transform(F.array_sort(sized), lambda x: x["leaf"])).alias("longest"))
    # outer: else Spark parses every text once more to leave out those without lines
    at = found.select("doc_id", "th", "leaves", F.slice("longest", 1, 3).alias("longest"), F.posexplode_outer("lines").alias("i", "x")).filter("i IS NOT NULL")
    at = at.select("doc_id", "th", "x.line", "x.plain", F.get("leaves", F.col("i")).alias("leaf"), "longest")
    return at.select("doc_id", "th", "line", "plain", "leaf", F.slice(F.array_remove("longest", F.col("leaf")), 1, 2).alias("known_by"))


def own_lines(lines: DataFrame, crowded: DataFrame) -> DataFrame:
    """``th, longest, least`` of the texts whose rare lines are ``OWN_SHARE`` of their lines
    or of their characters: their longest rare leaf, and the one of least hash."""
    rare = F.col("common").isNull()
    return (lines.join(crowded.select("leaf", F.lit(True).alias("common")), "leaf", "left").groupBy("th")
            .agg(F.sum("size").alias("size"), F.sum(F.when(rare, F.col("size"))).alias("rare"),
                 F.count("*").alias("n"), F.count(F.when(rare, 1)).alias("n_rare"),
                 F.max(F.when(rare, F.struct("size", "leaf"))).alias("longest"), F.min(F.when(rare, F.xxhash64("leaf"))).alias("least"))
            .filter((F.col("rare") >= F.col("size") * OWN_SHARE) | (F.col("n_rare") >= F.col("n") * OWN_SHARE)).select("th", F.col("longest.leaf").alias("longest"), "least"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``h``: hashes of the lines whose template recurs."""
    rows = text_rows(docs)
    every = line_rows(rows).withColumn("deep", is_deep(F.col("plain")))
    deep = every.filter("deep")
    every = cut(every.select("th", F.xxhash64("line").alias("h"), "leaf", "known_by", "doc_id", "deep", F.length("line").alias("size")), "lines")
    lines = every.filter("deep")
    crowded = (every.select("leaf", "th").distinct().groupBy("leaf").count()
               .filter(F.col("count") >= min_docs).select("leaf"))
    crowded = cut(crowded, "crowded-leaves")
    places = cut(lines.join(crowded, "leaf", "left_semi"), "crowded-lines")
    docs_of = places.select("h", "th").distinct().groupBy("h").agg(F.count("*").alias("n"))

    texts = (deep.join(crowded, "leaf", "left_semi").select("leaf", "plain", F.xxhash64("line").alias("h"))
             .groupBy("leaf", "h").agg(F.first("plain").alias("plain")))
    parsed = cut(texts.join(docs_of, "h").select("h", "leaf", "n", F.posexplode(F.split("plain", " ")).alias("i", "token")), "line-tokens")
    fixed = (parsed.filter(~F.col("token").rlike("[0-9]")).groupBy("leaf", "i", "token").agg(F.sum("n").alias("docs"))
             .filter(F.col("docs") >= min_docs).select("leaf", "i", "token", F.lit(True).alias("fixed")))
    shape = (parsed.join(fixed, ["leaf", "i", "token"], "left")
             .groupBy("leaf", "h").agg(F.sort_array(F.collect_list(F.struct("i", F.when(F.col("fixed"), F.col("token")).otherwise(FIELD).alias("t")))).alias("s"),
                                       F.avg(F.when(F.col("fixed"), 1.0).otherwise(0.0)).alias("share")))
    template = shape.select("h", F.when(F.col("share") >= FIXED_SHARE, F.xxhash64("leaf", "s.t")).otherwise(F.xxhash64(F.lit("line"), F.col("h"))).alias("template"))
    template = cut(template, "templates")

    held = (places.join(template, "h").groupBy("template", "known_by")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")).alias("first")))
    held = cut(held, "template-places")
    origin = held.groupBy("template").agg(F.min_by("known_by", "first").alias("o"))
    often = (held.join(origin, "template").filter((F.size("known_by") > 0) & ~F.arrays_overlap("known_by", "o"))
             .groupBy("template").count().filter(F.col("count") >= min_docs - 1).select("template"))
    own = own_lines(every, crowded)
    apart = (places.select("h", "th").distinct().join(own, "th").join(template, "h").groupBy("template")
             .agg(F.least(F.count_distinct("longest"), F.count_distinct("least")).alias("n")).filter(F.col("n") >= min_docs).select("template"))
    return template.join(often.unionByName(apart), "template", "left_semi").select("h")


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, counted: bool = False) -> DataFrame:
    """``docs`` without the lines of recurring templates (``n_chars``, if there, follows
    the text); ``counted`` adds the numbers of non-blank lines and of dropped ones."""
    gone = cut(recurring_lines(docs, min_docs), "recurring-lines")
    rows = text_rows(docs)
    own = (rows.select("doc_id", "th", F.explode_outer(F.split("text", "\n", -1)).alias("line"))
           .filter("line IS NOT NULL").select("doc_id", "th", F.xxhash64("line").alias("h")).join(gone, "h", "left_semi")
           .groupBy("doc_id", "th").agg(F.collect_set("h").alias("gone"))
           .select(F.col("doc_id").alias("_own_id"), F.col("th").alias("_own_th"), F.col("gone").alias("_own_gone")))
    own = cut(own, "own-recurring-lines")
    th = fresh("_th", docs.columns)
    text = F.col("text").cast("string")
    joined = docs.withColumn(th, F.xxhash64(text)).join(
        own.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("_own_id")) & (F.col(th) == F.col("_own_th")), "left")
    lines = F.split(text, "\n", -1)
    left = F.filter(lines, lambda x: ~F.array_contains("_own_gone", F.xxhash64(x)))
    new = F.when(F.col("_own_gone").isNotNull(), F.array_join(left, "\n")).otherwise(text)
    solid = lambda a: F.size(F.filter(a, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    counts = [F.coalesce(F.when(text.isNotNull(), solid(lines)), F.lit(0)).alias("n_lines"),
              F.coalesce(F.when(F.col("_own_gone").isNotNull(), solid(lines) - solid(left)), F.lit(0)).alias("n_dropped")] if counted else []
    new_name = fresh("_new", docs.columns)
    out = joined.select(*docs.columns, *counts, new.alias(new_name))
    cols = [F.col(new_name).alias(c) if c == "text"
            else F.coalesce(F.length(new_name), F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols, *(["n_lines", "n_dropped"] if counted else []))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"), counted=True)
    return got.select("doc_id", "n_lines", "n_dropped", "text")


SOLID_SQL = r"regexp_matches(line, '[^\x20\x09-\x0D]')"
OP4_SQL = rf"""
WITH every AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
solid AS (
  SELECT doc_id, text, line, i, string_split(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS t FROM every WHERE {SOLID_SQL}),
lines AS (
  SELECT *, concat_ws(' ', len(t), array_to_string(list_transform(t[1:{DEPTH}], lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END), ' ')) AS leaf
  FROM solid),
ranked AS (SELECT doc_id, leaf, row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, i) AS n FROM lines),
longest AS (SELECT doc_id, leaf, min(n) AS n FROM ranked GROUP BY doc_id, leaf
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(n)) <= 3),
known AS (SELECT doc_id, list(leaf ORDER BY n) AS l FROM longest GROUP BY doc_id),
deep AS (SELECT lines.*, list_filter(known.l, lambda x: x <> leaf)[1:2] AS known_by FROM lines JOIN known USING (doc_id) WHERE len(t) >= {DEPTH}),
crowded AS (SELECT leaf FROM deep GROUP BY leaf HAVING count(DISTINCT text) >= {MIN_DOCS}),
places AS (SELECT deep.* FROM deep JOIN crowded USING (leaf)),
parsed AS (SELECT leaf, line, any_value(t) AS t, count(DISTINCT text) AS n FROM places GROUP BY leaf, line),
words AS (SELECT leaf, line, n, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM parsed),
fixed AS (SELECT leaf, i, token FROM words WHERE NOT regexp_matches(token, '[0-9]') GROUP BY leaf, i, token HAVING sum(n) >= {MIN_DOCS}),
shape AS (
  SELECT w.leaf, w.line, string_agg(CASE WHEN f.token IS NULL THEN '{FIELD}' ELSE w.token END, ' ' ORDER BY w.i) AS s,
         avg(CASE WHEN f.token IS NULL THEN 0.0 ELSE 1.0 END) AS share
  FROM words w LEFT JOIN fixed f ON w.leaf = f.leaf AND w.i = f.i AND w.token = f.token GROUP BY w.leaf, w.line),
template AS (SELECT line, CASE WHEN share >= {FIXED_SHARE} THEN 'template ' || leaf || ' ' || s ELSE 'line ' || line END AS template FROM shape),
held AS (SELECT template, known_by, min(doc_id) AS first FROM places JOIN template USING (line) GROUP BY template, known_by),
origin AS (SELECT template, arg_min(known_by, first) AS o FROM held GROUP BY template),
often AS (SELECT template FROM held JOIN origin USING (template) WHERE len(known_by) > 0 AND NOT list_has_any(known_by, o)
          GROUP BY template HAVING count(*) >= {MIN_DOCS} - 1),
gone AS (SELECT DISTINCT line FROM template JOIN often USING (template))
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER ({SOLID_SQL}) AS n_lines, count(*) FILTER (line IN (SELECT line FROM gone)) AS n_dropped,
         string_agg(line, chr(10) ORDER BY i) FILTER (line NOT IN (SELECT line FROM gone)) AS kept
  FROM every GROUP BY doc_id) USING (doc_id)"""
