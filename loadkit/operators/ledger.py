"""File ledger: discover (C1), stage (C2), select (C3), status write-back.

The ledger is a Spark table, one row per file instance. Every step is a
set-based DataFrame job: no per-file queries, no driver loops over files.

* ``discover_files`` matches a listing against entity wildcards. The entity's
  literal prefix folder is an ancestor of every file it can match, so each file
  is exploded into its ancestor folders (bounded by path depth) and equi-joined
  with the entities on ``(system, folder)``; the wildcard is checked after the
  join. Entity tables are definitions (a row per feed) and are broadcast, so that
  neither the exploded listing is shuffled nor a hot folder falls to one task.
* ``stage_new_files`` anti-joins the ledger on the instance key and numbers the
  new files per entity after the entity's highest number so far, with the
  skew-safe ``number_within``.
* ``select_files`` turns the queue (status staged/failed) into load / skip /
  wait actions per entity policy; newest/oldest per entity come from a partial
  aggregate, not from a window over the whole entity.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import ContractError
from loadkit.functions.exprs import basename, instance_key, ntz_literal, padded_run_id
from loadkit.functions.numbering import number_within

STAGED, FAILED, SUCCESS, SKIPPED = "staged", "failed", "success", "skipped"
LOAD, SKIP, WAIT = "load", "skip", "wait"

LEDGER_SCHEMA = T.StructType([
    T.StructField("src_entity_inst_key", T.StringType(), False),
    T.StructField("src_sys_key", T.StringType()),
    T.StructField("src_entity_key", T.StringType()),
    T.StructField("src_entity_inst_no", T.LongType()),
    T.StructField("src_entity_path", T.StringType()),
    T.StructField("src_entity_name", T.StringType()),
    T.StructField("src_entity_timestamp", T.TimestampNTZType()),
    T.StructField("src_entity_size", T.LongType()),
    T.StructField("src_entity_staged_time", T.TimestampNTZType()),
    T.StructField("src_entity_load_status", T.StringType()),
    T.StructField("src_entity_load_mesg", T.StringType()),
    T.StructField("src_entity_load_run_id", T.StringType()),
])
LEDGER_COLS = [f.name for f in LEDGER_SCHEMA.fields]
LEDGER_KEY = ["src_entity_inst_key", "src_sys_key", "src_entity_key"]


def _utc_ntz(df: DataFrame, col: str) -> Column:
    """Timestamp column as a zone-free UTC wall-clock value."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(col)
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.to_utc_timestamp(F.col(col), tz).cast("timestamp_ntz")


def _ancestors(col: str) -> Column:
    """All proper ancestor folders of a slash path, e.g. a/b/c.txt -> [a, a/b]."""
    c = f"`{col}`"
    return F.expr(f"transform(sequence(1, greatest(size(split({c}, '/')) - 1, 1)), "
                  f"i -> substring_index({c}, '/', i))")


def entity_rules(systems: DataFrame, entities: DataFrame, only_active: bool = True) -> DataFrame:
    """One row per active (system, entity) with its match regex and prefix folder.

    ``systems``: src_sys_key, src_sys_id, src_entity_path (root), src_sys_status.
    ``entities``: src_sys_key, src_entity_key, src_entity_id, src_entity_pattern,
    src_entity_status [, src_entity_extract_type].
    """
    s, e = systems, entities
    if only_active:
        s = s.filter(F.lower(F.col("src_sys_status")) == "active")
        e = e.filter(F.lower(F.col("src_entity_status")) == "active")
    j = e.join(s.select("src_sys_key", "src_sys_id", F.col("src_entity_path").alias("_root")), "src_sys_key")
    root = F.regexp_replace(F.col("_root"), "/+$", "")
    pattern = F.concat(root, F.lit("/"), F.col("src_entity_pattern"))
    prefix = F.regexp_extract(pattern, r"^[^*?\[]*", 0)
    folder = F.regexp_replace(prefix, "/[^/]*$", "")
    return j.select("src_sys_key", "src_sys_id", "src_entity_key", "src_entity_id",
                    *([c for c in ["src_entity_extract_type"] if c in e.columns]),
                    pattern.alias("_pattern"), glob_regex_col(pattern).alias("_regex"), folder.alias("_folder"))


def glob_regex_col(pattern: Column) -> Column:
    """Wildcards ``*``, ``?``, ``[...]`` and ``[!...]`` as a regular expression; a bracket
    without its partner is a plain character."""
    r = F.regexp_replace(pattern, r"([\\.{}()+^$|&])", r"\\$1")
    r = F.regexp_replace(r, r"\[(!?[^\]]+)\]", "\u0001$1\u0002")      # classes, marked
    r = F.regexp_replace(r, r"([\[\]])", r"\\$1")
    r = F.regexp_replace(F.regexp_replace(r, "\\*(?![^\u0001]*\u0002)", ".*"), "\\?(?![^\u0001]*\u0002)", ".")
    r = F.replace(F.replace(r, F.lit("\u0001!"), F.lit("[^")), F.lit("\u0001"), F.lit("["))
    return F.concat(F.lit("^"), F.replace(r, F.lit("\u0002"), F.lit("]")), F.lit("$"))


def discover_files(listing: DataFrame, rules: DataFrame) -> DataFrame:
    """Files of ``listing`` (path, modificationTime, length, src_sys_key) matching an entity.

    A file matching several entities appears once per entity, as each entity is
    staged on its own. Output: instance key, system/entity keys and ids, full path
    (D23), file name, UTC time, size.
    """
    files = listing.select("src_sys_key", "path", _utc_ntz(listing, "modificationTime").alias("_ts"),
                           F.col("length").cast("long").alias("_size"))
    exploded = files.withColumn("_folder", F.explode(_ancestors("path")))
    j = exploded.join(F.broadcast(rules), ["src_sys_key", "_folder"])
    j = j.filter(F.regexp_like(F.col("path"), F.col("_regex")))
    name = basename(F.col("path"))
    return j.select(
        instance_key(F.col("_ts"), F.col("src_sys_key"), name).alias("src_entity_inst_key"),
        "src_sys_key", "src_sys_id", "src_entity_key", "src_entity_id",
        *([c for c in ["src_entity_extract_type"] if c in rules.columns]),
        F.col("path").alias("src_entity_path"), name.alias("src_entity_name"),
        F.col("_ts").alias("src_entity_timestamp"), F.col("_size").alias("src_entity_size"))


def stage_new_files(discovered: DataFrame, ledger: DataFrame, run_ts: _dt.datetime,
                    skew_safe: bool = True) -> DataFrame:
    """Ledger rows to append for files not yet in the ledger under their entity (a
    file that matches two entities is a row of each).

    Numbering per entity continues after the entity's highest number (or 0), in
    instance-key order; run id is ``system(5).entity(5).instance(10)``.
    """
    new = discovered.join(ledger.select(*LEDGER_KEY).filter(F.col("src_entity_inst_key").isNotNull()), LEDGER_KEY, "left_anti")
    last = ledger.groupBy("src_sys_key", "src_entity_key").agg(
        F.max("src_entity_inst_no").alias("_last"))
    numbered = number_within(new, ["src_sys_key", "src_entity_key"], ["src_entity_inst_key"], out="_rn",
                             skew_safe=skew_safe)
    numbered = numbered.join(last, ["src_sys_key", "src_entity_key"], "left")
    inst_no = (F.coalesce(F.col("_last"), F.lit(0)) + F.col("_rn")).cast("long")
    return numbered.select(
        "src_entity_inst_key", "src_sys_key", "src_entity_key", inst_no.alias("src_entity_inst_no"),
        "src_entity_path", "src_entity_name", "src_entity_timestamp", "src_entity_size",
        ntz_literal(run_ts).alias("src_entity_staged_time"),
        F.lit(STAGED).alias("src_entity_load_status"), F.lit("Staged").alias("src_entity_load_mesg"),
        padded_run_id(F.col("src_sys_id"), F.col("src_entity_id"), inst_no).alias("src_entity_load_run_id"))


POLICIES = ("full", "incremental_all", "incremental_one", "xml")


def select_files(ledger: DataFrame, policy: str | Column, skew_safe: bool = True) -> DataFrame:
    """Queue rows (staged/failed) with ``action`` and ``load_seq``.

    ===================  ==============================  ===========================
    policy               load                            others
    ===================  ==============================  ===========================
    full                 newest file                     skip (after a good load)
    incremental_all/xml  all, oldest first (load_seq)    --
    incremental_one      oldest file                     wait
    ===================  ==============================  ===========================
    """
    if isinstance(policy, str):
        if policy not in POLICIES:
            raise ContractError(f"unknown load policy {policy!r}")
        pol = F.lit(policy)
    else:
        pol = policy
    q = ledger.filter(F.col("src_entity_load_status").isin(STAGED, FAILED)).withColumn("_policy", pol)
    ends = q.groupBy("src_sys_key", "src_entity_key").agg(
        F.max("src_entity_inst_key").alias("_newest"), F.min("src_entity_inst_key").alias("_oldest"))
    q = q.join(ends, ["src_sys_key", "src_entity_key"])
    p, key = F.col("_policy"), F.col("src_entity_inst_key")
    action = (F.when(p == "full", F.when(key == F.col("_newest"), LOAD).otherwise(SKIP))
               .when(p.isin("incremental_all", "xml"), F.lit(LOAD))
               .when(p == "incremental_one", F.when(key == F.col("_oldest"), LOAD).otherwise(WAIT))
               .otherwise(F.lit("error")))
    q = q.withColumn("action", action)
    bulk_policies = ("incremental_all", "xml")

    def numbered(df):
        return number_within(df, ["src_sys_key", "src_entity_key"], ["src_entity_inst_key"], out="load_seq",
                             skew_safe=skew_safe)

    def single(df):
        return df.withColumn("load_seq", F.when(F.col("action") == LOAD, F.lit(1).cast("long")))

    if isinstance(policy, str):   # one policy for all: only one branch can hold rows
        out = numbered(q) if policy in bulk_policies else single(q)
    else:
        out = numbered(q.filter(p.isin(*bulk_policies))).unionByName(
            single(q.filter(~p.isin(*bulk_policies) | p.isNull())))
    return out.drop("_newest", "_oldest", "_policy")


def assert_single_system(systems: DataFrame, sys_key: str) -> None:
    """Exactly one definition row must exist for a system key."""
    n = systems.filter(F.col("src_sys_key") == sys_key).limit(2).count()
    if n != 1:
        raise ContractError(f"system {sys_key!r} has {n} definition rows, expected exactly one")


def system_definitions(systems: DataFrame, keys: DataFrame) -> DataFrame:
    """A9 for many systems at once: definition rows of every key of ``keys`` and whether
    there is exactly one."""
    n = systems.groupBy("src_sys_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.join(n, "src_sys_key", "left").select(
        "src_sys_key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(F.col("n") == 1, F.lit(False)).alias("ok"))


def queue_order(queue: DataFrame, extract_type: str) -> DataFrame:
    """O1/O2: staged queue in load order: oldest first for incremental feeds,
    newest first for full extracts (by file time, then name)."""
    if extract_type == "incremental":
        return queue.orderBy(F.col("src_entity_timestamp").asc(), F.col("src_entity_name").asc())
    if extract_type == "full":
        return queue.orderBy(F.col("src_entity_timestamp").desc(), F.col("src_entity_name").desc())
    raise ContractError(f"unknown extract type {extract_type!r}")


def apply_status(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """New ledger content with ``updates`` (status, message, run id) applied to
    the rows of the same instance key and, as far as ``updates`` names them, the same
    system and entity."""
    keys = [c for c in LEDGER_KEY if c in updates.columns]
    u = updates.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.lit(True).alias("_hit"),
                       F.col("src_entity_load_status").alias("_st"),
                       F.col("src_entity_load_mesg").alias("_msg"),
                       F.col("src_entity_load_run_id").alias("_run"))
    on = None
    for c in keys:
        same = ledger[c] == u[f"_k_{c}"]
        on = same if on is None else on & same
    j = ledger.join(u, on, "left")
    hit = F.col("_hit").isNotNull()
    return j.select(*[
        (F.when(hit, F.col("_st")).otherwise(F.col(c)).alias(c) if c == "src_entity_load_status" else
         F.when(hit, F.col("_msg")).otherwise(F.col(c)).alias(c) if c == "src_entity_load_mesg" else
         F.when(hit, F.coalesce(F.col("_run"), F.col(c))).otherwise(F.col(c)).alias(c)
         if c == "src_entity_load_run_id" else F.col(c))
        for c in ledger.columns])


def skip_others(selected: DataFrame, run_id: str) -> DataFrame:
    """Status updates that mark every ``skip`` row as skipped."""
    return selected.filter(F.col("action") == SKIP).select(
        *LEDGER_KEY, F.lit(SKIPPED).alias("src_entity_load_status"),
        F.lit("Skipped: newer file loaded").alias("src_entity_load_mesg"),
        F.lit(run_id).alias("src_entity_load_run_id"))


__all__ = ["LEDGER_SCHEMA", "LEDGER_COLS", "entity_rules", "discover_files", "stage_new_files",
           "select_files", "apply_status", "skip_others",
           "assert_single_system", "system_definitions", "queue_order"]
