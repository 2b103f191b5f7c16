"""Writers: month replacement, corrections, appends, full rebuilds and views."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.hashing import record_hash
from folioforge.functions.temporal import ts
from folioforge.operators.bronze import align
from folioforge.operators.facts import affected_months, changed_versions, kept_rows
from folioforge.operators.keys import latest_per_key
from folioforge.operators.quality import schema_violations
from folioforge.session import materialize


def replace_months(df: DataFrame, path: str, month: str) -> None:
    """Replace exactly the month partitions present in ``df``; an empty batch changes nothing.

    The rebalance hint gives each month few files and splits a month that is much larger than the rest.
    """
    (
        df.hint("rebalance", month)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )


def upsert_months(
    batch: DataFrame, path: str, month: str, keys: Sequence[str], latest_by: Sequence[str]
) -> None:
    """Correct rows of the affected months and keep all others.

    Of rows that share a key within the batch the latest one is taken. The batch is read once. Old
    rows that stay are staged first, because a table cannot be overwritten while it is read; the batch is staged already.
    """
    spark = batch.sparkSession
    existing = spark.read.schema(batch.schema).parquet(path)
    arrived = materialize(latest_per_key(batch, list(keys), list(latest_by)), "arrived")
    kept = materialize(kept_rows(existing, arrived, keys, month), "upsert")
    replace_months(arrived.unionByName(kept), path, month)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_first(df: DataFrame, table: str) -> None:
    """Create the table if it does not exist yet; otherwise leave it alone."""
    df.write.mode("ignore").saveAsTable(table)


def check_schema(df: DataFrame, table: str) -> None:
    """Refuse a frame whose columns or types differ from the existing table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return
    problems = schema_violations(df.schema, spark.table(table).schema)
    if problems:
        text = "; ".join(f"{p.column}: {p.problem}" for p in problems)
        raise ValueError(f"schema of {table} does not match: {text}")


@contextmanager
def _only_touched_partitions(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` follows the session setting alone; a writer option would be ignored."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def save_months(df: DataFrame, table: str, month: str) -> None:
    """Catalog-table form of :func:`replace_months`."""
    spark = df.sparkSession
    ordered = df.select(*[c for c in df.columns if c != month], month)
    if not spark.catalog.tableExists(table):
        ordered.hint("rebalance", month).write.partitionBy(month).saveAsTable(table)
        return
    check_schema(ordered, table)
    target = spark.table(table).columns
    with _only_touched_partitions(spark):
        ordered.select(*target).hint("rebalance", month).write.insertInto(table, overwrite=True)


def save_raw(df: DataFrame, table: str, batch: str) -> None:
    """Replace one batch of a raw table, which accepts new columns; those it misses become null."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        known = set(spark.table(table).columns)
        added = [(f.name, f.dataType.simpleString(), "") for f in df.schema if f.name not in known]
        if added:
            add_columns(spark, table, added)
        df = align(df, spark.table(table).schema)
    save_months(df, table, batch)


def save_corrections(
    batch: DataFrame, table: str, month: str, keys: Sequence[str], latest_by: Sequence[str]
) -> None:
    """Catalog-table form of :func:`upsert_months`; the default way to load facts.

    The first batch follows the same rule: of rows that share a key the latest one is taken.
    """
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        save_months(latest_per_key(batch, list(keys), list(latest_by)), table, month)
        return
    check_schema(batch, table)
    arrived = materialize(latest_per_key(batch, list(keys), list(latest_by)), "arrived")
    kept = materialize(kept_rows(spark.table(table), arrived, keys, month), "corrections")
    save_months(arrived.unionByName(kept), table, month)


#: Columns that say when a fact was recorded, not what it says.
_RECORDING = (
    "source_yyyymm", "system_from_ts", "system_to_ts", "is_current_valid", "is_current_system", "record_version",
    "change_type",
)


def save_versions(
    batch: DataFrame, table: str, month: str, keys: Sequence[str], latest_by: Sequence[str], recorded_at: str,
    replace: bool = False,
) -> None:
    """Append what a batch changes to the log of a fact, so that no earlier answer is lost.

    A load is known by ``recorded_at``, the ``system_from_ts`` of its rows: loading it again replaces its own rows and
    leaves those of other loads. ``replace`` takes the batch as all there is in the months it touches.
    """
    spark = batch.sparkSession
    content = [c for c in batch.columns if c not in _RECORDING]
    arrived = latest_per_key(batch, list(keys), list(latest_by)).withColumns(
        {"content_hash": record_hash(content), "is_deleted": F.lit(False)}
    )
    if not spark.catalog.tableExists(table):
        save_months(arrived, table, month)
        return
    check_schema(arrived, table)
    # One row per month.
    months = F.broadcast(affected_months(batch, month))
    log = spark.table(table).join(months, month, "left_semi")
    added = materialize(changed_versions(log, arrived, keys, recorded_at, replace), "versions")
    others = F.col("system_from_ts") != ts(recorded_at)
    if log.where(~others).isEmpty():
        save_append(added, table)
    else:
        save_months(materialize(log.where(others).unionByName(added), "versions"), table, month)


def compact_months(spark: SparkSession, table: str, month: str, months: Sequence[str]) -> None:
    """Rewrite months of a log that many appends have left in many files; its rows stay as they are."""
    rows = spark.table(table).where(F.col(month).isin(*months))
    save_months(materialize(rows, "compacted"), table, month)


def save_run(df: DataFrame, table: str, month: str, run: str) -> None:
    """Results of one run beside those of earlier runs; a run that is repeated replaces its own results."""
    spark = df.sparkSession
    ordered = df.withColumn("run", F.lit(run)).select(*[c for c in df.columns if c != month], month, "run")
    if not spark.catalog.tableExists(table):
        ordered.hint("rebalance", month).write.partitionBy(month, "run").saveAsTable(table)
        return
    check_schema(ordered, table)
    with _only_touched_partitions(spark):
        ordered.select(*spark.table(table).columns).hint("rebalance", month).write.insertInto(table, overwrite=True)


def save_append(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    check_schema(df, table)
    df.select(*spark.table(table).columns).write.insertInto(table)


def save_rebuild(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def add_columns(spark: SparkSession, table: str, columns: Sequence[tuple[str, str, str]]) -> None:
    """Explicit evolution: (name, type, comment) for each new column."""
    listed = ", ".join(f"`{name}` {kind} COMMENT '{comment}'" for name, kind, comment in columns)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")


def comment_column(spark: SparkSession, table: str, column: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {table} CHANGE COLUMN `{column}` COMMENT '{comment}'")


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    listed = ", ".join(f"'{name}' = '{value}'" for name, value in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def copy_without(spark: SparkSession, table: str, new_table: str, removed: Sequence[str]) -> None:
    """Removing a column makes a new table; the old one stays until its readers have moved."""
    spark.table(table).drop(*removed).write.saveAsTable(new_table)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
