"""Reports over job metrics, table and flow metadata, owners, secrets and scripts in use."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.schema import columns_json
from quayside.session import saved

# Kinds of metric rows and job states.
CDC, MERGE, INCREMENTAL, EXPORT, FAILED = "CDC", "MERGE", "INCREMENTAL", "EXPORT", "FAILED"
# Columns of the job report, in order.
JOB_REPORT = [
    "workflow_id", "workflow_run_id", "job_id", "entity_type", "job_type", "job_start_time", "job_end_time",
    "job_created_by", "cluster_id", "cluster_name", "databricks_job_id", "job_status", "job_table_status",
    "source_name", "source_file_names", "source_schema_name", "source_database_name", "table_group_name",
    "source_table_name", "table_name", "starting_watermark_value", "ending_watermark_value",
    "target_schema_name", "target_table_name", "pre_target_count", "fetch_records_count",
    "target_records_count", "job_link",
]
# Node types of a flow that write a table.
TARGET_NODES = ["TARGET", "BIGQUERY_TARGET", "SNOWFLAKE_TARGET", "CUSTOM_TARGET"]
DELETED_USER = "deleted_user"
# Usage rows of a task, on average; buckets of items by which they are counted; strands of repeated rows.
TASK_ROWS = 250_000
BUCKETS = 65_536
STRANDS = 16

_FROM_CDC = ["fetch_records_count", "source_schema_name", "source_database_name"]
_FROM_MERGE = [
    "job_status", "target_records_count", "first_merged_watermark", "last_merged_watermark",
    "workflow_id", "workflow_run_id",
]


def pre_target_count(status="job_status", target="target_records_count", moved="fetch_records_count") -> Column:
    """Rows in the target before the job: unknown without a target count, unchanged by a failure."""
    target = F.col(target)
    return F.when(F.col(status) == FAILED, target).otherwise(target - F.col(moved))


def job_metrics_fact(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per job and table.

    Of several rows the capture row gives the fetched rows and the merge row the target's state,
    and the job counts as incremental; a single row stands for itself, as does the first of several
    that are neither of the two. Rows of one kind are
    ordered by ``order`` and the first is used. One aggregate with map-side combining.
    """
    def first_of(kind, columns):
        row = F.struct(*order, *[F.col(c).alias(f"_{c}") for c in columns])
        return F.min(row if kind is None else F.when(F.col("job_type") == kind, row))

    every = ["job_type", *_FROM_CDC, *_FROM_MERGE]
    facts = metrics.groupBy("job_id", "table_id").agg(
        F.count(F.lit(1)).alias("_n"),
        first_of(None, every).alias("_one"),
        first_of(CDC, _FROM_CDC).alias("_cdc"),
        first_of(MERGE, _FROM_MERGE).alias("_merge"),
    )
    several = (F.col("_n") > 1) & (F.col("_cdc").isNotNull() | F.col("_merge").isNotNull())
    chosen = {c: F.when(several, F.col(f"_cdc._{c}")).otherwise(F.col(f"_one._{c}")) for c in _FROM_CDC}
    chosen |= {c: F.when(several, F.col(f"_merge._{c}")).otherwise(F.col(f"_one._{c}")) for c in _FROM_MERGE}
    single = F.when(F.col("_one._job_type") == CDC, INCREMENTAL).otherwise(F.col("_one._job_type"))
    return (
        facts.withColumns({"job_type": F.when(several, INCREMENTAL).otherwise(single), **chosen})
        .withColumn("pre_target_count", pre_target_count())
        .select("job_id", "table_id", "job_type", *_FROM_CDC, *_FROM_MERGE, "pre_target_count")
    )


def with_fallback(jobs: DataFrame, facts: DataFrame, tables: DataFrame) -> DataFrame:
    """Job tables with their facts; without any, the table's own row count and sync type.

    ``jobs``: job_id, table_id, job_kind; ``tables``: table_id, row_count, sync_type.
    """
    known = facts.withColumn("_known", F.lit(True))
    joined = jobs.join(known, ["job_id", "table_id"], "left").join(tables, "table_id", "left")
    missing = F.col("_known").isNull()
    own_type = F.when(F.lower("job_kind") == "export_data", EXPORT).otherwise(F.upper("sync_type"))
    return joined.select(
        "job_id", "table_id",
        F.when(missing, own_type).otherwise(F.col("job_type")).alias("job_type"),
        F.coalesce("fetch_records_count", F.lit(0)).alias("fetch_records_count"),
        *[F.when(missing, F.col("row_count")).otherwise(F.col(c)).alias(c)
          for c in ("pre_target_count", "target_records_count")],
    )


def job_report(*kinds: DataFrame) -> DataFrame:
    """Rows of every kind of job under one header; what a kind lacks is null."""
    header = [F.col(c) for c in JOB_REPORT]
    known = set(JOB_REPORT)
    parts = [df.select([c for c in df.columns if c in known]) for df in kinds]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = {c: F.lit(None).cast("string") for c in JOB_REPORT if c not in united.columns}
    return united.withColumns(absent).select(header)


def recent_jobs(jobs: DataFrame, now, minutes: int, types: Sequence[str] = (), statuses: Sequence[str] = ()) -> DataFrame:
    """Jobs updated in the last minutes before ``now``, of some types and states."""
    since = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(minutes))
    kept = jobs.where((F.col("updated_at") >= since) & (F.col("updated_at") <= F.lit(now).cast("timestamp_ntz")))
    if types:
        kept = kept.where(F.col("job_type").isin(*types))
    return kept.where(F.col("job_status").isin(*statuses)) if statuses else kept


def with_creator(jobs: DataFrame, users: DataFrame) -> DataFrame:
    """Name and mail of the user who created a job; ``users`` has id and a profile struct."""
    flat = users.select(
        F.col("id").alias("created_by"), F.col("profile.name").alias("creator_name"),
        F.col("profile.email").alias("creator_email"))
    return jobs.join(flat, "created_by", "left")


def job_link(protocol: str, host: str, port: int, job_id="job_id") -> Column:
    return F.when(F.col(job_id).isNotNull(), F.format_string(
        f"{protocol}://{host}:{port}/job/logs?jobId=%s", F.col(job_id).cast("string")))


def target_name(kind="target_type") -> Column:
    """Project and dataset for BigQuery targets, schema and database for the others."""
    def dotted(a, b):
        return F.concat_ws(".", F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))

    return F.when(F.upper(kind) == "BIGQUERY", dotted("project_id", "dataset_name")).otherwise(
        dotted("schema_name", "database_name"))


def usage_pairs(items: DataFrame, usage: DataFrame, users: DataFrame) -> DataFrame:
    """Who uses what: one row per item and user, once; an item without users keeps one row.

    ``items``: item_id, item_name; ``usage``: item_id, user_id; ``users``: user_id, user_name.
    The users of an item stay rows: a set in one cell could not hold those of a popular item. Usage is
    counted first, by buckets of items: tasks are as many as leave each ``TASK_ROWS`` rows, since bytes of
    a shuffle, well packed, say little of what a task holds. Rows of an item with more are cut by user
    into parts of about as many, each of which meets the item; repeats of a pair are first taken out
    of ``STRANDS`` strands, so not even those all pass one task.
    """
    usage = usage.select("item_id", "user_id").where("item_id IS NOT NULL")
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(BUCKETS))
    counted = saved(usage.groupBy(bucket.alias("bucket")).count(), "usage-buckets")
    tasks = max(1, -(-(counted.agg(F.sum("count")).first()[0] or 0) // TASK_ROWS))
    full = counted.where(F.col("count") > TASK_ROWS)
    popular = (
        usage.join(F.broadcast(full), bucket == F.col("bucket"), "left_semi").groupBy("item_id").count()
        .where(F.col("count") > TASK_ROWS).select("item_id", F.ceil(F.col("count") / TASK_ROWS).alias("_parts"))
    )
    popular = F.broadcast(saved(popular, "popular-items"))  # at most a row per task

    strand = F.pmod(F.spark_partition_id(), F.lit(STRANDS)).alias("_strand")
    once = usage.select("item_id", "user_id", strand).repartition(tasks, "item_id", "user_id", "_strand").distinct()
    part = F.pmod(F.xxhash64("user_id"), F.coalesce("_parts", F.lit(1)))
    pairs = once.join(popular, "item_id", "left").select("item_id", "user_id", part.alias("_part"))
    pairs = pairs.repartition(tasks, "item_id", "_part").distinct().withColumn("_used", F.lit(True))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))
    places = items.join(popular, "item_id", "left").select("item_id", "item_name", "_parts", parts.alias("_part"))
    met = places.repartition(tasks, "item_id", "_part").join(pairs.hint("merge"), ["item_id", "_part"], "left")
    # a part of a popular item may have no rows; the item has
    met = saved(met.where(F.col("_used") | F.col("_parts").isNull()), "usage-pairs")
    used = met.where("_used").join(users, "user_id", "left").select(
        "item_id", "item_name", F.coalesce("user_name", F.lit(DELETED_USER)).alias("user_name"))
    unused = met.where("_used IS NULL").select("item_id", "item_name", F.lit(None).cast("string").alias("user_name"))
    return used.unionByName(unused).withColumn("item_name", F.coalesce("item_name", F.col("item_id").cast("string")))


def json_values(json_text, key: str) -> Column:
    """Every text or number stored under ``key`` at any depth of a JSON text, alone or in a list.

    The text is read by tokens, so brackets inside quoted texts are no lists, and lists may lie in
    lists. A value is decoded by the JSON reader, escapes included; null, true, false and objects
    give nothing, a key inside such an object does.
    """
    token = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?+|-?[0-9][0-9.eE+-]*|[\[\]{}]'
    tokens = F.regexp_extract_all(F.col(json_text), F.lit(token), F.lit(0))
    start = F.struct(F.lit("").alias("open"), F.lit(False).alias("hit"), F.array().cast("array<string>").alias("found"))

    def step(s, t):
        # open: what is open, innermost first: K a list under the key, L another list, O an object
        wanted = s["hit"] | F.startswith(s["open"], F.lit("K"))

        def state(open_, hit=F.lit(False), found=s["found"]):
            return F.struct(open_.alias("open"), hit.alias("hit"), found.alias("found"))

        return (F.when(F.endswith(t, F.lit(":")), state(s["open"], F.rlike(t, F.lit(rf'^"{re.escape(key)}"\s*:$'))))
                .when(t == "[", state(F.concat(F.when(wanted, "K").otherwise("L"), s["open"])))
                .when(t == "{", state(F.concat(F.lit("O"), s["open"])))
                .when(t.isin("]", "}"), state(F.substr(s["open"], F.lit(2))))
                .when(wanted, state(s["open"], found=F.concat(s["found"], F.array(t))))
                .otherwise(state(s["open"])))

    found = F.aggregate(tokens, start, step, lambda s: s["found"])
    read = F.flatten(F.transform(found, lambda v: F.coalesce(
        F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>"), F.array().cast("array<string>"))))
    return F.array_distinct(F.array_compact(read))


def secret_usage(sources: DataFrame, key: str = "secret_id") -> DataFrame:
    """Rows of domain, secret and source. ``sources``: source_name, domains (array), connection (JSON)."""
    found = sources.select(
        "source_name", F.explode(json_values("connection", key)).alias("secret"), "domains")
    return found.select(F.explode("domains").alias("domain"), "secret", "source_name").distinct()


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run of each workflow."""
    newest = F.max(F.struct("created_at", "run_id")).alias("last")
    return runs.groupBy("workflow_id").agg(newest).select("workflow_id", "last.run_id", "last.created_at")


def references(commands: DataFrame, text: str, pattern: str, owner: str) -> DataFrame:
    """Paths found in command texts, turned round: one row per path and owner."""
    paths = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return commands.select(F.explode(F.array_distinct(paths)).alias("path"), owner).distinct()


def table_report(tables: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Table rows with their column dictionaries, and the tables that could not be described.

    ``tables``: table_id, source and target names, export fields, file patterns; ``columns``:
    table_id, original_name, target_name, source_code, target_code, position, is_audit.
    """
    described = columns.groupBy("table_id").agg(
        columns_json("target_name", "target_code", "position").alias("target_columns_and_datatypes"),
        columns_json("original_name", "source_code", "position", where=~F.coalesce("is_audit", F.lit(False)))
        .alias("source_columns_and_datatypes"))
    exported = F.coalesce(F.col("export_type"), F.lit("")) != ""
    pattern = F.when(
        F.col("include_regex").isNotNull() | F.col("exclude_regex").isNotNull(),
        F.format_string("Include Regex: %s, Exclude Regex: %s",
                        F.coalesce("include_regex", F.lit("None")), F.coalesce("exclude_regex", F.lit("None"))))
    joined = tables.join(described, "table_id", "left")
    broken = F.col("target_columns_and_datatypes").isNull()
    good = joined.where(~broken).select(
        "table_id", "source_schema_name", "source_table_name", pattern.alias("source_file_pattern"),
        F.when(exported, F.upper("export_type"))
        .otherwise(F.concat(F.upper("environment_type"), F.lit(" (INGESTION)"))).alias("target_type"),
        F.when(exported, F.col("export_database")).otherwise(F.lit("")).alias("target_database_name"),
        F.when(exported, F.col("export_schema")).otherwise(F.col("target_schema_name")).alias("target_schema_name"),
        F.when(exported, F.col("export_table")).otherwise(F.col("target_table_name")).alias("target_table_name"),
        "target_columns_and_datatypes", "source_columns_and_datatypes")
    bad = joined.where(broken).select("table_id", "source_table_name", F.lit("no columns").alias("error_message"))
    return good, bad


def flow_targets(flows: DataFrame, audit_prefix: str = "audit_") -> DataFrame:
    """One row per writing node of a flow.

    ``flows``: flow_id and ``nodes``, a map of node name to struct(type, properties map,
    natural_keys array, output_columns array of struct(name, data_type)).
    """
    node = flows.select("flow_id", F.explode("nodes").alias("node", "spec"))
    kept = node.where(F.upper("spec.type").isin(*TARGET_NODES))
    props = F.col("spec.properties")

    def prop(*names):
        return F.coalesce(*[F.try_element_at(props, F.lit(n)) for n in names], F.lit(""))

    database = F.when(F.upper("spec.type") == "BIGQUERY_TARGET", prop("dataset_name")).otherwise(prop("database_name"))
    own = F.filter("spec.output_columns", lambda c: ~F.startswith(F.lower(c["name"]), F.lit(audit_prefix)))
    return kept.select(
        "flow_id", "node", F.upper("spec.type").alias("target_type"),
        prop("target_schema_name", "schema_name").alias("target_schema_name"),
        database.alias("target_database_name"),
        prop("target_table_name", "table_name").alias("target_table_name"),
        F.array_join("spec.natural_keys", ",").alias("natural_keys"),
        prop("sync_type", "build_mode").alias("build_mode"),
        F.array_join(F.transform(own, lambda c: F.concat(c["name"], F.lit(":"), c["data_type"])), ",").alias("columns"),
    )


def united_metrics(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def artifact_owners(users: DataFrame, artifacts: Mapping[str, DataFrame]) -> DataFrame:
    """Every kind of artifact in one list with the names of its creator and last editor."""
    labelled = [df.withColumn("artifact_type", F.lit(kind)) for kind, df in artifacts.items()]
    listed = united_metrics(labelled)

    def named(column, out, df):
        lookup = users.select(F.col("user_id").alias(column), F.col("user_name").alias(out))
        return df.join(lookup, column, "left").withColumn(out, F.coalesce(out, F.lit(DELETED_USER)))

    return named("modified_by", "modified_by_name", named("created_by", "created_by_name", listed))
