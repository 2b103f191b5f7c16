"""Raw-layer queries. The order lines and orders are landed as CSV first, then ingested from the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators import bronze, quality
from folioforge.plans.inputs import AS_OF, PARAMS
from folioforge.plans.model_sql import CASHFLOWS
from folioforge.plans.registry import day, moment, present, query, rounded
from folioforge.schemas import CORRUPT, LANDED
from folioforge.session import materialize, work_path
from folioforge.sinks import tables as sinks
from folioforge.sources import model
from folioforge.sources.landing import land, read_landed
from folioforge.streaming.ingest import ingest_stream, read_ingested

_DATASET = "cashflows"
_DECLARED = LANDED[_DATASET]
# From this batch on, the sender adds a channel and leaves out the currency.
_NEW_LAYOUT_FROM = "199901"


def _outgoing(spark: SparkSession, folder: str) -> DataFrame:
    """Cashflows as the sender writes them. Amounts of pending orders are marked and so are no numbers."""
    amount = F.col("cashflow_amount").cast("decimal(18,2)").cast("string")
    pending = F.col("cashflow_type") == "DIVIDEND"
    return model.cashflows(spark, folder).select(
        "cashflow_id",
        "portfolio_id",
        "instrument_id",
        F.date_format("cashflow_dt", "yyyy-MM-dd").alias("cashflow_dt"),
        "cashflow_type",
        F.when(pending, F.concat(amount, F.lit("?"))).otherwise(amount).alias("cashflow_amount"),
        "currency_code",
        F.col("source_yyyymm").alias("as_of_month"),
        "source_yyyymm",
    )


def _landed(spark: SparkSession, folder: str) -> str:
    """Folder of landed files, one layout throughout."""
    path = work_path(spark, "landing")
    land(_outgoing(spark, folder), path, "source_yyyymm")
    return path


def _layouts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The feed before and after its column list changes."""
    outgoing = _outgoing(spark, folder)
    later = F.col("source_yyyymm") >= _NEW_LAYOUT_FROM
    changed = outgoing.where(later).withColumn("channel", F.lower("cashflow_type"))
    order = ["channel", "cashflow_id", "portfolio_id", "cashflow_dt", "cashflow_amount",
             "cashflow_type", "instrument_id", "as_of_month", "source_yyyymm"]
    return outgoing.where(~later), changed.select(*order)


def _landed_with_drift(spark: SparkSession, folder: str) -> list[str]:
    """The same feed with a changed column list in the later batches."""
    paths = []
    for part in _layouts(spark, folder):
        paths.append(work_path(spark, "landing"))
        land(part, paths[-1], "source_yyyymm")
    return paths


def _ingest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    landed = read_landed(spark, paths, _DECLARED)
    return bronze.with_control_columns(landed, "cashflow", PARAMS.load_id, AS_OF)


_ROW = f"""cashflow_id, portfolio_id, {day('cashflow_dt')} AS cashflow_dt, cashflow_type,
    {rounded("CASE WHEN cashflow_type <> 'DIVIDEND' THEN cashflow_amount END")} AS cashflow_amount"""
_CONTROL = f"""source_yyyymm, source_yyyymm AS as_of_month, '{PARAMS.load_id}' AS load_id,
    'cashflow' AS expected_grain, 1 AS record_version, 'INSERT' AS change_type, true AS is_current_system,
    cashflow_type = 'DIVIDEND' AS is_corrupt_record, {moment(f"TIMESTAMP '{AS_OF}'")} AS ingestion_ts,
    {moment(f"TIMESTAMP '{AS_OF}'")} AS system_from_ts,
    {moment("TIMESTAMP '9999-12-31 23:59:59'")} AS system_to_ts"""
_SHOWN = (
    "cashflow_id", "portfolio_id", "cashflow_dt", "cashflow_type", "cashflow_amount", "source_yyyymm",
    "as_of_month", "load_id", "expected_grain", "record_version", "change_type", "is_current_system",
    "is_corrupt_record", "ingestion_ts", "system_from_ts", "system_to_ts",
)


@query(
    "bronze_ingest",
    f"WITH {CASHFLOWS} SELECT {_ROW}, currency_code, {_CONTROL} FROM cashflows",
)
def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return present(_ingest(spark, _landed(spark, folder)).select(*_SHOWN, "currency_code"))


@query(
    "bronze_lineage",
    f"""WITH {CASHFLOWS} SELECT source_yyyymm, 'source_yyyymm=' || source_yyyymm AS source_folder,
    true AS is_csv, count(*) AS record_count FROM cashflows GROUP BY source_yyyymm""",
)
def bronze_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per folder, from the lineage columns."""
    raw = _ingest(spark, _landed(spark, folder))
    parent = F.element_at(F.split("source_file_path", "/"), -2)
    return raw.groupBy(
        "source_yyyymm",
        parent.alias("source_folder"),
        F.endswith("source_file_name", F.lit(".csv")).alias("is_csv"),
    ).agg(F.count("*").alias("record_count"))


@query(
    "bronze_corrupt_split",
    f"""WITH {CASHFLOWS} SELECT CASE cashflow_type WHEN 'DIVIDEND' THEN 'corrupt' ELSE 'clean' END AS part,
    source_yyyymm, count(*) AS record_count,
    {rounded("sum(CASE WHEN cashflow_type <> 'DIVIDEND' THEN cashflow_amount END)", 2)} AS cashflow_amount
    FROM cashflows GROUP BY 1, 2""",
)
def bronze_corrupt_split(spark: SparkSession, folder: str) -> DataFrame:
    # Recorded first: both parts are made from it.
    raw = materialize(_ingest(spark, _landed(spark, folder)), "bronze")
    clean, corrupt = bronze.split_corrupt(raw)
    parts = clean.withColumn("part", F.lit("clean")).unionByName(
        corrupt.withColumn("part", F.lit("corrupt"))
    )
    return present(
        parts.groupBy("part", "source_yyyymm").agg(
            F.count("*").alias("record_count"), F.sum("cashflow_amount").alias("cashflow_amount")
        ),
        2,
    )


@query(
    "bronze_month_replace",
    f"WITH {CASHFLOWS} SELECT {_ROW}, {_CONTROL} FROM cashflows",
)
def bronze_month_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Batches are kept side by side; loading the later ones again replaces them and adds nothing."""
    landed = _landed(spark, folder)
    table = work_path(spark, "cashflows-raw")
    raw = _ingest(spark, landed)
    sinks.replace_months(raw, table, "source_yyyymm")
    sinks.replace_months(raw.where(F.col("source_yyyymm") >= _NEW_LAYOUT_FROM), table, "source_yyyymm")
    return present(spark.read.schema(raw.schema).parquet(table).select(*_SHOWN))


@query(
    "bronze_stream_ingest",
    f"WITH {CASHFLOWS} SELECT {_ROW}, currency_code, {_CONTROL} FROM cashflows",
)
def bronze_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The same files picked up by a stream; the second run finds nothing new."""
    landed = _landed(spark, folder)
    table, progress = work_path(spark, "cashflows-stream"), work_path(spark, "stream-progress")
    for _ in range(2):
        ingest_stream(
            spark, landed, _DECLARED, table, progress, "cashflow", PARAMS.load_id, AS_OF
        ).awaitTermination()
    return present(read_ingested(spark, table).select(*_SHOWN, "currency_code"))


_LAYOUT = f"""CASE WHEN source_yyyymm < '{_NEW_LAYOUT_FROM}'
    THEN 'as_of_month,cashflow_amount,cashflow_dt,cashflow_id,cashflow_type,currency_code,instrument_id,portfolio_id'
    ELSE 'as_of_month,cashflow_amount,cashflow_dt,cashflow_id,cashflow_type,channel,instrument_id,portfolio_id' END"""


@query(
    "bronze_stream_drift",
    f"""WITH {CASHFLOWS} SELECT {_ROW}, source_yyyymm, {_LAYOUT} AS source_column_list,
    CASE WHEN source_yyyymm >= '{_NEW_LAYOUT_FROM}' THEN lower(cashflow_type) END AS channel,
    CASE WHEN source_yyyymm < '{_NEW_LAYOUT_FROM}' THEN currency_code END AS currency_code,
    source_yyyymm < '{_NEW_LAYOUT_FROM}' AS first_run FROM cashflows""",
)
def bronze_stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    """The sender changes its columns between two runs of the stream; a third run finds nothing new."""
    landing, table = work_path(spark, "landing"), work_path(spark, "cashflows-stream")
    progress = work_path(spark, "stream-progress")
    old, new = _layouts(spark, folder)

    def run(load_id: str) -> None:
        ingest_stream(spark, landing, _DECLARED, table, progress, "cashflow", load_id, AS_OF).awaitTermination()

    land(old, f"{landing}/first", "source_yyyymm")
    run("first")
    land(new, f"{landing}/second", "source_yyyymm")
    run("second")
    run("third")
    raw = read_ingested(spark, table)
    return present(
        raw.select(
            "cashflow_id", "portfolio_id", "cashflow_dt", "cashflow_type", "cashflow_amount", "source_yyyymm",
            F.array_join("source_column_list", ",").alias("source_column_list"), "channel", "currency_code",
            (F.col("load_id") == "first").alias("first_run"),
        )
    )


@query(
    "source_column_list",
    f"""WITH {CASHFLOWS} SELECT source_yyyymm, {_LAYOUT} AS source_column_list, count(*) AS record_count
    FROM cashflows GROUP BY 1, 2""",
)
def source_column_list(spark: SparkSession, folder: str) -> DataFrame:
    raw = _ingest(spark, _landed_with_drift(spark, folder))
    return raw.groupBy("source_yyyymm", F.array_join("source_column_list", ",").alias("source_column_list")).agg(
        F.count("*").alias("record_count")
    )


@query(
    "schema_drift_report",
    f"""WITH {CASHFLOWS} SELECT source_yyyymm, {_LAYOUT} AS source_column_list, count(*) AS row_count,
    CASE WHEN source_yyyymm < '{_NEW_LAYOUT_FROM}' THEN '' ELSE 'channel' END AS new_columns,
    CASE WHEN source_yyyymm < '{_NEW_LAYOUT_FROM}' THEN '' ELSE 'currency_code' END AS missing_columns
    FROM cashflows GROUP BY ALL""",
)
def schema_drift_report(spark: SparkSession, folder: str) -> DataFrame:
    raw = _ingest(spark, _landed_with_drift(spark, folder))
    report = bronze.drift_report(raw, [f.name for f in _DECLARED])
    listed = ("source_column_list", "new_columns", "missing_columns")
    return report.select(
        "source_yyyymm", "row_count", *(F.array_join(c, ",").alias(c) for c in listed)
    )


@query(
    "schema_align",
    f"""WITH {CASHFLOWS} SELECT {_ROW}, source_yyyymm,
    CASE WHEN source_yyyymm >= '{_NEW_LAYOUT_FROM}' THEN lower(cashflow_type) END AS channel,
    CASE WHEN source_yyyymm < '{_NEW_LAYOUT_FROM}' THEN currency_code END AS currency_code FROM cashflows""",
)
def schema_align(spark: SparkSession, folder: str) -> DataFrame:
    """Both layouts under one schema: missing columns are null, new ones stay."""
    raw = bronze.align(_ingest(spark, _landed_with_drift(spark, folder)), _DECLARED)
    return present(
        raw.select(
            "cashflow_id", "portfolio_id", "cashflow_dt", "cashflow_type", "cashflow_amount",
            "source_yyyymm", "channel", "currency_code",
        )
    )


@query(
    "schema_evolve_project",
    f"""WITH {CASHFLOWS} SELECT {_ROW}, CAST(NULL AS VARCHAR) AS broker_id, CAST(NULL AS BIGINT) AS broker_sk
    FROM cashflows""",
)
def schema_evolve_project(spark: SparkSession, folder: str) -> DataFrame:
    """A new table version: two declared columns are added, three are left out."""
    kept = ("cashflow_id", "portfolio_id", "cashflow_dt", "cashflow_type", "cashflow_amount")
    evolved = T.StructType(
        [f for f in _DECLARED if f.name in kept]
        + [T.StructField("broker_id", T.StringType()), T.StructField("broker_sk", T.LongType())]
    )
    raw = _ingest(spark, _landed_with_drift(spark, folder))
    return present(quality.project_to(raw, evolved))


@query(
    "schema_validate",
    f"""WITH {CASHFLOWS}, n AS (SELECT count(*) FILTER (source_yyyymm >= '{_NEW_LAYOUT_FROM}') AS row_count
      FROM cashflows) SELECT 'channel' AS column_name, 'unexpected' AS problem, row_count FROM n
    UNION ALL SELECT 'currency_code', 'missing', row_count FROM n""",
)
def schema_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the declared schema in the later layout, with the rows they concern."""
    later = _landed_with_drift(spark, folder)[1]
    landed = read_landed(spark, later, _DECLARED)
    sent = [c for c in bronze.source_columns(landed)]
    problems = quality.schema_violations(landed.select(*sent).schema, _DECLARED)
    violations = F.array(
        *(F.struct(F.lit(v.column).alias("column_name"), F.lit(v.problem).alias("problem")) for v in problems)
    )
    counted = landed.select(*sent, CORRUPT).agg(F.count("*").alias("row_count"))
    return counted.select(F.inline(violations), "row_count")
