"""Static dimensions, surrogate keys, type-2 history and as-of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.temporal import as_of, known_at, open_end, stamp, valid_at
from folioforge.operators import dimensions, facts, keys
from folioforge.plans import inputs
from folioforge.plans.model_sql import (
    CURRENCY_CODES, PORTFOLIO_LOG, POSITIONS, SECOND_LOAD, TRANSACTIONS,
)
from folioforge.plans.registry import day, moment, present, query, rounded
from folioforge.sources import model

_OPEN = "TIMESTAMP '9999-12-31 23:59:59'"


def _static_sql(table: str, codes: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, code, upper(code[1]) || lower(code[2:]) AS name,
    row_number() OVER (ORDER BY code) AS sk, '2002-01-01' AS effective_from_dt,
    '9999-12-31' AS effective_to_dt, true AS is_current, {moment("TIMESTAMP '2002-01-01'")} AS valid_from_ts,
    {moment(_OPEN)} AS valid_to_ts FROM (SELECT DISTINCT {key} AS code FROM ({codes}))"""


@query(
    "dim_static",
    " UNION ALL ".join(
        (
            _static_sql("dim_currency", CURRENCY_CODES, "currency_code"),
            _static_sql("dim_asset_class", "SELECT p_type FROM part", "p_type"),
            _static_sql("dim_market_data_source", "SELECT l_linestatus FROM lineitem", "l_linestatus"),
        )
    ),
)
def dim_static(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        (inputs.dim_currency, "dim_currency", "currency_code", "currency_name", "currency_sk"),
        (inputs.dim_asset_class, "dim_asset_class", "asset_class_code", "asset_class_name", "asset_class_sk"),
        (inputs.dim_market_data_source, "dim_market_data_source", "source_system_code",
         "source_system_name", "market_data_source_sk"),
    ]
    frames = [
        build(spark, folder).select(
            F.lit(table).alias("table_name"),
            F.col(code).alias("code"),
            F.col(name).alias("name"),
            F.col(sk).alias("sk"),
            "effective_from_dt", "effective_to_dt", "is_current", "valid_from_ts", "valid_to_ts",
        )
        for build, table, code, name, sk in parts
    ]
    return present(frames[0].union(frames[1]).union(frames[2]))


@query(
    "surrogate_key",
    """SELECT instrument_id, row_number() OVER (ORDER BY instrument_id) AS instrument_sk
    FROM (SELECT CAST(p_partkey AS VARCHAR) AS instrument_id FROM part)""",
)
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    parts = model.instruments(spark, folder).select("instrument_id")
    return keys.add_surrogate_key(parts, ["instrument_id"], "instrument_sk")


@query(
    "dim_current_ref",
    f"WITH {PORTFOLIO_LOG} SELECT portfolio_id, portfolio_sk FROM dim_portfolio WHERE is_current",
)
def dim_current_ref(spark: SparkSession, folder: str) -> DataFrame:
    dimension = inputs.dim_portfolio(spark, folder)
    return dimensions.current_reference(dimension, "portfolio_id", "portfolio_sk")


_ATTRIBUTES = "portfolio_id, portfolio_name, portfolio_type, base_currency_code, risk_policy_name, attribute_hash"


@query(
    "scd2_initial",
    f"""WITH {PORTFOLIO_LOG} SELECT portfolio_sk, {_ATTRIBUTES}, record_version, change_type,
    {moment('system_from_ts')} AS system_from_ts FROM first_log""",
)
def scd2_initial(spark: SparkSession, folder: str) -> DataFrame:
    return present(inputs.first_log(spark, folder))


@query(
    "scd2_changes",
    f"WITH {PORTFOLIO_LOG} SELECT {_ATTRIBUTES}, existing_sk, existing_version FROM changes",
)
def scd2_changes(spark: SparkSession, folder: str) -> DataFrame:
    spec = inputs.PORTFOLIO
    current = dimensions.latest_versions(inputs.first_log(spark, folder), spec.business_key)
    snapshot = model.portfolio_snapshot(spark, folder, SECOND_LOAD)
    return dimensions.detect_changes(
        snapshot, current, spec.business_key, spec.surrogate_key, spec.attributes
    )


_INTERVALS = f"""{day('effective_from_dt')} AS effective_from_dt, {day('effective_to_dt')} AS effective_to_dt,
    is_current, {moment('system_from_ts')} AS valid_from_ts, {moment('system_to_ts')} AS valid_to_ts,
    {moment('system_from_ts')} AS system_from_ts, {moment('system_to_ts')} AS system_to_ts,
    is_current AS is_current_valid, is_current AS is_current_system"""


@query(
    "scd2_expire",
    f"""WITH {PORTFOLIO_LOG} SELECT portfolio_sk, portfolio_id, record_version, change_type, {_INTERVALS}
    FROM dim_portfolio WHERE NOT is_current""",
)
def scd2_expire(spark: SparkSession, folder: str) -> DataFrame:
    expired = inputs.dim_portfolio(spark, folder).where(~F.col("is_current"))
    return present(
        expired.drop(
            "portfolio_name", "portfolio_type", "base_currency_code", "risk_policy_name", "attribute_hash"
        )
    )


@query(
    "scd2_merge",
    f"""WITH {PORTFOLIO_LOG} SELECT portfolio_sk, {_ATTRIBUTES}, record_version, change_type, {_INTERVALS}
    FROM dim_portfolio""",
)
def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    return present(inputs.dim_portfolio(spark, folder))


@query(
    "version_intervals",
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, event_type AS attribute,
    {moment('ts')} AS system_from_ts,
    {moment(f'coalesce(lead(ts) OVER w, {_OPEN})')} AS system_to_ts,
    CAST(row_number() OVER w AS INTEGER) AS record_version,
    lead(ts) OVER w IS NULL AS is_current_system FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def version_intervals(spark: SparkSession, folder: str) -> DataFrame:
    log = model.event_log(spark, folder).drop("value")
    chained = keys.version_chain(
        log, ["user_id"], ["system_from_ts", "event_id"], F.date_trunc("day", "system_from_ts")
    )
    return present(
        chained.select(
            "user_id", "event_id", "attribute", "system_from_ts",
            F.coalesce("next_from", open_end()).alias("system_to_ts"),
            F.col("version_no").alias("record_version"),
            F.col("next_from").isNull().alias("is_current_system"),
        )
    )


@query(
    "asof_valid",
    f"""WITH {POSITIONS} SELECT position_id, {day('position_dt')} AS position_dt,
    {rounded('market_value')} AS market_value FROM positions
    WHERE position_dt <= TIMESTAMP '1998-06-15' AND TIMESTAMP '1998-06-15' < position_dt + INTERVAL 1 DAY""",
)
def asof_valid(spark: SparkSession, folder: str) -> DataFrame:
    stamped = stamp(model.positions(spark, folder), "position_dt", inputs.AS_OF, valid_days=1)
    return present(
        valid_at(stamped, "1998-06-15 00:00:00").select("position_id", "position_dt", "market_value")
    )


# Corrections of a transaction arrive under its identifier; each is a version in system time.
_RESTATED = f"""{TRANSACTIONS}, restated AS (
  SELECT *, CAST(arrival_dt AS TIMESTAMP) AS system_from_ts,
    coalesce(CAST(lead(arrival_dt) OVER w AS TIMESTAMP), {_OPEN}) AS system_to_ts,
    lead(arrival_dt) OVER w IS NULL AS is_current_system,
    CAST(row_number() OVER w AS INTEGER) AS record_version
  FROM tx WINDOW w AS (PARTITION BY transaction_id
    ORDER BY arrival_dt, instrument_id, counterparty_id, gross_amount))"""
_RESTATED_COLUMNS = f"""transaction_id, instrument_id, counterparty_id, {day('trade_dt')} AS trade_dt,
    {rounded('gross_amount')} AS gross_amount, {moment('system_from_ts')} AS system_from_ts,
    {moment('system_to_ts')} AS system_to_ts, record_version, is_current_system"""


def _restated(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.transactions(spark, folder).select(
        "transaction_id", "instrument_id", "counterparty_id", "trade_dt", "gross_amount", "arrival_dt"
    )
    return facts.restate(
        facts.system_stamp(rows, "trade_dt", "arrival_dt"),
        ["transaction_id"],
        ["system_from_ts", "instrument_id", "counterparty_id", "gross_amount"],
    )


def _restated_output(df: DataFrame) -> DataFrame:
    return present(
        df.select(
            "transaction_id", "instrument_id", "counterparty_id", "trade_dt", "gross_amount",
            "system_from_ts", "system_to_ts", "record_version", "is_current_system",
        )
    )


@query("restate_fact", f"WITH {_RESTATED} SELECT {_RESTATED_COLUMNS} FROM restated")
def restate_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _restated_output(_restated(spark, folder))


@query(
    "asof_system",
    f"""WITH {_RESTATED} SELECT {_RESTATED_COLUMNS} FROM restated
    WHERE system_from_ts <= TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-01-01' < system_to_ts""",
)
def asof_system(spark: SparkSession, folder: str) -> DataFrame:
    return _restated_output(known_at(_restated(spark, folder), "1999-01-01 00:00:00"))


@query(
    "bitemporal_asof",
    f"""WITH {_RESTATED} SELECT {_RESTATED_COLUMNS} FROM restated
    WHERE system_from_ts <= TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-01-01' < system_to_ts
    AND trade_dt <= TIMESTAMP '1998-06-15'""",
)
def bitemporal_asof(spark: SparkSession, folder: str) -> DataFrame:
    return _restated_output(
        as_of(_restated(spark, folder), "1998-06-15 00:00:00", "1999-01-01 00:00:00")
    )


# A version starts on each day on which the policy of a customer differs from the day before it.
_HISTORY = f"""days AS (
  SELECT CAST(o_custkey AS VARCHAR) AS portfolio_id, o_orderdate AS system_from_ts,
    arg_max(o_orderpriority, o_orderkey) AS risk_policy_name FROM orders GROUP BY 1, 2),
marked AS (
  SELECT *, lag(risk_policy_name) OVER (PARTITION BY portfolio_id ORDER BY system_from_ts) AS earlier
  FROM days),
history AS (
  SELECT portfolio_id, risk_policy_name, system_from_ts,
    coalesce(lead(system_from_ts) OVER w, {_OPEN}) AS system_to_ts,
    CAST(row_number() OVER w AS INTEGER) AS record_version
  FROM marked WHERE earlier IS DISTINCT FROM risk_policy_name
  WINDOW w AS (PARTITION BY portfolio_id ORDER BY system_from_ts))"""


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.history_of_snapshots(
        model.portfolio_history(spark, folder), "portfolio_id", ["risk_policy_name"]
    )


@query(
    "scd2_backfill",
    f"""WITH {_HISTORY} SELECT portfolio_id, risk_policy_name, {moment('system_from_ts')} AS system_from_ts,
    {moment('system_to_ts')} AS system_to_ts, record_version FROM history""",
)
def scd2_backfill(spark: SparkSession, folder: str) -> DataFrame:
    return present(_history(spark, folder).drop("attribute_hash"))


@query(
    "dim_asof_join",
    f"""WITH {TRANSACTIONS}, {_HISTORY} SELECT transaction_id, portfolio_id, instrument_id, counterparty_id,
    {day('trade_dt')} AS trade_dt, {rounded('net_amount')} AS net_amount, h.risk_policy_name, h.record_version
    FROM tx LEFT JOIN history h USING (portfolio_id)
    WHERE h.system_from_ts <= trade_dt AND trade_dt < h.system_to_ts
    UNION ALL SELECT transaction_id, portfolio_id, instrument_id, counterparty_id, {day('trade_dt')},
    {rounded('net_amount')}, NULL, NULL FROM tx WHERE NOT EXISTS (
      SELECT 1 FROM history h WHERE h.portfolio_id = tx.portfolio_id AND h.system_from_ts <= tx.trade_dt)""",
)
def dim_asof_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.transactions(spark, folder).select(
        "transaction_id", "portfolio_id", "instrument_id", "counterparty_id", "trade_dt", "net_amount"
    )
    versions = _history(spark, folder).drop("attribute_hash")
    joined = dimensions.join_as_of(rows, versions, "portfolio_id", F.col("trade_dt").cast("timestamp"))
    return present(
        joined.select(*rows.columns, "version.risk_policy_name", "version.record_version")
    )
