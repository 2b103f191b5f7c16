"""Scans, counts, calendar, hashes and stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.hashing import record_hash, tracking_hash
from folioforge.functions.temporal import stamp
from folioforge.operators import dimensions, keys, reports
from folioforge.plans import inputs
from folioforge.plans.model_sql import CASHFLOWS, LINES, POSITIONS, PRICES, TRANSACTIONS
from folioforge.plans.registry import day, moment, present, query, rounded
from folioforge.session import work_path
from folioforge.sinks import tables as sinks
from folioforge.sources import model
from folioforge.sources.tables import batch_of, load, month_of, within_lookback


@query(
    "batch_month_scan",
    f"""WITH {TRANSACTIONS} SELECT transaction_id, portfolio_id, instrument_id, {day('trade_dt')} AS trade_dt,
    {rounded('gross_amount')} AS gross_amount, source_yyyymm FROM tx WHERE source_yyyymm = '199612'""",
)
def batch_month_scan(spark: SparkSession, folder: str) -> DataFrame:
    """One batch of the raw table, which is kept by batch month."""
    raw = work_path(spark, "transactions-raw")
    sinks.replace_months(model.transactions(spark, folder), raw, "source_yyyymm")
    batch = batch_of(spark, raw, "199612")
    return present(
        batch.select(
            "transaction_id", "portfolio_id", "instrument_id", "trade_dt", "gross_amount", "source_yyyymm"
        )
    )


@query(
    "event_month_scan",
    f"""WITH {POSITIONS} SELECT position_id, portfolio_id, instrument_id, {day('position_dt')} AS position_dt,
    {rounded('market_value')} AS market_value, position_yyyymm FROM positions
    WHERE position_yyyymm = '199612'""",
)
def event_month_scan(spark: SparkSession, folder: str) -> DataFrame:
    held = model.positions(spark, folder, month="199612")
    return present(
        held.select(
            "position_id", "portfolio_id", "instrument_id", "position_dt", "market_value", "position_yyyymm"
        )
    )


@query(
    "price_lookback_filter",
    f"""WITH {LINES}, {PRICES} SELECT price_id, {day('price_dt')} AS price_dt,
    {rounded('return_pct', 6)} AS return_pct FROM prices
    WHERE price_dt > DATE '1998-12-31' AND price_dt <= DATE '2001-12-31'""",
)
def price_lookback_filter(spark: SparkSession, folder: str) -> DataFrame:
    recent = model.prices(spark, folder).where(within_lookback("price_dt", "2001-12-31", 36))
    return present(recent.select("price_id", "price_dt", "return_pct"), 6)


def _facts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    transactions = model.transactions(spark, folder)
    return {
        "fact_transactions": transactions.withColumn("trade_yyyymm", month_of("trade_dt")),
        "fact_positions_daily": model.positions(spark, folder),
        "fact_market_prices_daily": model.prices(spark, folder),
        "fact_cashflows": model.cashflows(spark, folder),
    }


_EVENT_MONTH = {
    "fact_transactions": "trade_yyyymm",
    "fact_positions_daily": "position_yyyymm",
    "fact_market_prices_daily": "price_yyyymm",
    "fact_cashflows": "cashflow_yyyymm",
}
_SOURCES = f"WITH {TRANSACTIONS}, {POSITIONS.replace(LINES + ', ', '')}, {PRICES}, {CASHFLOWS}"


def _count_sql(month_name: str, columns: dict[str, str]) -> str:
    tables = {
        "fact_transactions": "tx",
        "fact_positions_daily": "positions",
        "fact_market_prices_daily": "prices",
        "fact_cashflows": "cashflows",
    }
    parts = (
        f"SELECT '{name}' AS table_name, {columns[name]} AS {month_name}, count(*) AS record_count "
        f"FROM {tables[name]} GROUP BY ALL"
        for name in tables
    )
    return f"{_SOURCES} " + " UNION ALL ".join(parts)


@query("event_month_counts", _count_sql("event_yyyymm", _EVENT_MONTH))
def event_month_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: (df, _EVENT_MONTH[name]) for name, df in _facts(spark, folder).items()}
    return reports.month_counts(tables, "event_yyyymm").orderBy("table_name", "event_yyyymm")


@query(
    "batch_month_counts",
    _count_sql("source_yyyymm", {name: "source_yyyymm" for name in _EVENT_MONTH}),
)
def batch_month_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: (df, "source_yyyymm") for name, df in _facts(spark, folder).items()}
    return reports.month_counts(tables, "source_yyyymm")


_PROFILED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(
    "table_audit_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in _PROFILED
    ),
)
def table_audit_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.row_counts({t: load(spark, folder, t) for t in _PROFILED})


@query(
    "affected_partitions",
    f"WITH {TRANSACTIONS} SELECT DISTINCT source_yyyymm, trade_yyyymm FROM tx",
)
def affected_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Event months touched by each batch."""
    batches = model.transactions(spark, folder).withColumn("trade_yyyymm", month_of("trade_dt"))
    return batches.select("source_yyyymm", "trade_yyyymm").distinct()


_CALENDAR = """calendar AS (
  SELECT CAST(unnest(generate_series(first_dt, last_dt, INTERVAL 1 DAY)) AS DATE) AS calendar_dt FROM (
    SELECT min(d) AS first_dt, max(d) AS last_dt FROM (
      SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
      UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)))"""


@query(
    "dim_date",
    f"""WITH {_CALENDAR} SELECT {day('calendar_dt')} AS calendar_dt,
    CAST(strftime(calendar_dt, '%Y%m%d') AS INTEGER) AS date_sk, CAST(year(calendar_dt) AS INTEGER) AS year_num,
    CAST(quarter(calendar_dt) AS INTEGER) AS quarter_num,
    CAST(month(calendar_dt) AS INTEGER) AS month_num, CAST(day(calendar_dt) AS INTEGER) AS day_num,
    last_day(calendar_dt) = calendar_dt AS is_month_end, isodow(calendar_dt) <= 5 AS is_business_day,
    {moment('calendar_dt')} AS valid_from_ts, {moment("TIMESTAMP '9999-12-31 23:59:59'")} AS valid_to_ts
    FROM calendar""",
)
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    days = dimensions.calendar(inputs.date_bounds(spark, folder), inputs.AS_OF)
    return present(
        days.select(
            "calendar_dt", "date_sk", "year_num", "quarter_num", "month_num", "day_num",
            "is_month_end", "is_business_day", "valid_from_ts", "valid_to_ts",
        )
    )


@query(
    "scalar_calendar",
    f"""SELECT o_orderkey, {day('o_orderdate')} AS order_dt, CAST(year(o_orderdate) AS INTEGER) AS year_num,
    CAST(quarter(o_orderdate) AS INTEGER) AS quarter_num,
    CAST(month(o_orderdate) AS INTEGER) AS month_num, CAST(day(o_orderdate) AS INTEGER) AS day_num,
    {day('last_day(CAST(o_orderdate AS DATE))')} AS month_end_dt,
    isodow(o_orderdate) <= 5 AS is_business_day, strftime(o_orderdate, '%Y%m') AS order_yyyymm,
    {day('CAST(o_orderdate AS DATE) + 1')} AS next_dt,
    date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days,
    {rounded("date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365.25::DOUBLE", 6)} AS age_years
    FROM orders""",
)
def scalar_calendar(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("order_dt")
    age = F.datediff(F.lit("2002-01-01").cast("date"), d)
    orders = load(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_dt")
    )
    return present(
        orders.select(
            "o_orderkey",
            d,
            F.year(d).alias("year_num"),
            F.quarter(d).alias("quarter_num"),
            F.month(d).alias("month_num"),
            F.dayofmonth(d).alias("day_num"),
            F.last_day(d).alias("month_end_dt"),
            F.weekday(d).between(0, 4).alias("is_business_day"),
            month_of(d).alias("order_yyyymm"),
            F.date_add(d, 1).alias("next_dt"),
            age.cast("long").alias("age_days"),
            (age / F.lit(365.25)).alias("age_years"),
        ),
        6,
    )


@query(
    "tracking_hash",
    """SELECT c_custkey, sha256(c_name || '||' || coalesce(nullif(c_mktsegment, 'BUILDING'), '<<NULL>>')
    || '||' || c_nationkey) AS attribute_hash FROM customer""",
)
def attribute_hash(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").withColumn(
        "segment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    return customers.select(
        "c_custkey", tracking_hash(["c_name", "segment", "c_nationkey"]).alias("attribute_hash")
    )


@query(
    "record_hash",
    """SELECT p_partkey, sha256('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"'
    || p_brand || '","p_type":"' || p_type || '","p_size":' || p_size || '}') AS record_hash FROM part""",
)
def part_record_hash(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        "p_partkey",
        record_hash(["p_partkey", "p_name", "p_brand", "p_type", "p_size"]).alias("record_hash"),
    )


_STAMPED = """valid_from_ts valid_to_ts system_from_ts system_to_ts""".split()


@query(
    "bitemporal_stamp",
    f"""WITH {LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {moment('ship_dt')} AS valid_from_ts, {moment('ship_dt + 1')} AS valid_to_ts,
    {moment('arrival_dt')} AS system_from_ts, {moment("TIMESTAMP '9999-12-31 23:59:59'")} AS system_to_ts,
    true AS is_current_valid, true AS is_current_system, 1 AS record_version, 'INSERT' AS change_type
    FROM lines""",
)
def bitemporal_stamp(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem")
    shipped = F.col("l_shipdate").cast("date")
    arrived = F.date_add(shipped, F.col("l_linenumber")).cast("timestamp")
    stamped = stamp(lines, shipped, arrived, valid_days=1)
    return present(
        stamped.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_STAMPED,
            "is_current_valid", "is_current_system", "record_version", "change_type",
        )
    )


@query(
    "dedupe_business_key",
    f"""WITH {TRANSACTIONS} SELECT transaction_id, {day('arrival_dt')} AS arrival_dt, instrument_id,
    counterparty_id, {rounded('gross_amount')} AS gross_amount FROM (
      SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY arrival_dt DESC,
        instrument_id DESC, counterparty_id DESC, gross_amount DESC) AS rn FROM tx) WHERE rn = 1""",
)
def dedupe_business_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.transactions(spark, folder).select(
        "transaction_id", "arrival_dt", "instrument_id", "counterparty_id", "gross_amount"
    )
    latest_by = ["arrival_dt", "instrument_id", "counterparty_id"]
    return present(keys.latest_per_key(rows, ["transaction_id"], latest_by))
