"""The portfolio data model as SQL common table expressions, twin of ``sources.model``."""

LINES = """lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS ship_dt, CAST(l_shipdate AS DATE) + l_linenumber AS arrival_dt
  FROM lineitem)"""

TRANSACTIONS = f"""{LINES}, tx AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS portfolio_id,
    CAST(l_partkey AS VARCHAR) AS instrument_id, CAST(l_suppkey AS VARCHAR) AS counterparty_id,
    l_returnflag AS currency_code, ship_dt AS trade_dt, ship_dt + 2 AS settlement_dt,
    CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS transaction_type,
    l_quantity AS quantity, l_extendedprice / l_quantity AS price, l_extendedprice AS gross_amount,
    l_extendedprice * (l_tax + 0.0) AS fees_amount,
    l_extendedprice - l_extendedprice * (l_tax + 0.0) AS net_amount, arrival_dt,
    strftime(arrival_dt, '%Y%m') AS source_yyyymm, strftime(ship_dt, '%Y%m') AS trade_yyyymm
  FROM lines JOIN orders ON l_orderkey = o_orderkey)"""

_POSITION = """
  SELECT *, portfolio_id || '-' || instrument_id || '-' || strftime(position_dt, '%Y%m%d') AS position_id,
    market_value / quantity AS end_of_day_price, strftime(position_dt, '%Y%m') AS position_yyyymm
  FROM (SELECT {owner} AS portfolio_id, CAST(l_partkey AS VARCHAR) AS instrument_id,
      {day} AS position_dt, sum(l_quantity) AS quantity, sum(l_extendedprice) AS market_value,
      sum(l_extendedprice * (l_discount + 0.0)) AS unrealized_pnl, min(l_returnflag) AS currency_code,
      min(l_linestatus) AS source_system_code, strftime(max(arrival_dt), '%Y%m') AS source_yyyymm
    FROM lines {join} GROUP BY 1, 2, 3)"""

POSITIONS = f"{LINES}, positions AS (" + _POSITION.format(
    owner="CAST(l_suppkey AS VARCHAR)", day="ship_dt", join=""
) + ")"

NATION_POSITIONS = f"{LINES}, positions AS (" + _POSITION.format(
    owner="CAST(s_nationkey AS VARCHAR)",
    day="last_day(ship_dt)",
    join="JOIN supplier ON l_suppkey = s_suppkey",
) + ")"

PRICES = """prices AS (
  SELECT *, instrument_id || '-' || strftime(price_dt, '%Y%m%d') AS price_id,
    abs(return_pct) * 100 AS volatility_proxy, strftime(price_dt, '%Y%m') AS price_yyyymm
  FROM (SELECT CAST(l_partkey AS VARCHAR) AS instrument_id, ship_dt AS price_dt,
      sum(l_extendedprice) / sum(l_quantity) AS close_price,
      avg(l_discount) - CAST(0.05 AS DOUBLE) AS return_pct, min(l_returnflag) AS currency_code,
      min(l_linestatus) AS source_system_code, strftime(max(arrival_dt), '%Y%m') AS source_yyyymm
    FROM lines GROUP BY 1, 2))"""

_CASHFLOW = """cashflows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cashflow_id, {owner} AS portfolio_id,
    o_orderstatus AS currency_code, CAST(o_orderdate AS DATE) AS cashflow_dt,
    CASE o_orderstatus WHEN 'O' THEN 'CAPITAL_CALL' WHEN 'F' THEN 'DISTRIBUTION' ELSE 'DIVIDEND' END
      AS cashflow_type,
    CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS cashflow_amount,
    strftime(CAST(o_orderdate AS DATE) + 2, '%Y%m') AS source_yyyymm,
    strftime(o_orderdate, '%Y%m') AS cashflow_yyyymm
  FROM orders {join}), account_days AS (
  SELECT {owner} AS portfolio_id, CAST(o_orderdate AS DATE) AS position_dt,
    o_totalprice AS market_value, strftime(o_orderdate, '%Y%m') AS position_yyyymm
  FROM orders {join})"""

CASHFLOWS = _CASHFLOW.format(owner="CAST(o_custkey AS VARCHAR)", join="")
NATION_CASHFLOWS = _CASHFLOW.format(
    owner="CAST(c_nationkey AS VARCHAR)", join="JOIN customer ON o_custkey = c_custkey"
)


def snapshot(name: str, before: str) -> str:
    return f"""{name} AS (
  SELECT CAST(c_custkey AS VARCHAR) AS portfolio_id, c_name AS portfolio_name,
    c_mktsegment AS portfolio_type, r_name AS base_currency_code, policy AS risk_policy_name,
    sha256(c_name || '||' || c_mktsegment || '||' || r_name || '||' || policy) AS attribute_hash
  FROM customer
  JOIN (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS policy
        FROM orders WHERE o_orderdate < TIMESTAMP '{before}' GROUP BY 1) ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


FIRST_LOAD, SECOND_LOAD = "1996-01-01", "2002-01-01"

# Version log after two loads; open versions have no successor.
PORTFOLIO_LOG = f"""{snapshot('first_load', FIRST_LOAD)}, {snapshot('second_load', SECOND_LOAD)},
first_log AS (
  SELECT *, row_number() OVER (ORDER BY portfolio_id) AS portfolio_sk, 1 AS record_version,
    'INSERT' AS change_type, TIMESTAMP '{FIRST_LOAD}' AS system_from_ts FROM first_load),
changes AS (
  SELECT s.*, f.portfolio_sk AS existing_sk, f.record_version AS existing_version
  FROM second_load s LEFT JOIN first_log f USING (portfolio_id)
  WHERE f.attribute_hash IS NULL OR f.attribute_hash <> s.attribute_hash),
second_log AS (
  SELECT portfolio_id, portfolio_name, portfolio_type, base_currency_code, risk_policy_name, attribute_hash,
    row_number() OVER (ORDER BY portfolio_id) + (SELECT max(portfolio_sk) FROM first_log) AS portfolio_sk,
    coalesce(existing_version, 0) + 1 AS record_version,
    CASE WHEN existing_sk IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS change_type,
    TIMESTAMP '{SECOND_LOAD}' AS system_from_ts FROM changes),
version_log AS (SELECT * FROM first_log UNION ALL BY NAME SELECT * FROM second_log),
dim_portfolio AS (
  SELECT * EXCLUDE (change_type),
    lead(system_from_ts) OVER (PARTITION BY portfolio_id ORDER BY system_from_ts) AS next_ts,
    next_ts IS NULL AS is_current,
    CASE WHEN next_ts IS NULL THEN change_type ELSE 'EXPIRE' END AS change_type,
    CAST(system_from_ts AS DATE) AS effective_from_dt,
    coalesce(CAST(next_ts AS DATE) - 1, DATE '9999-12-31') AS effective_to_dt,
    coalesce(next_ts, TIMESTAMP '9999-12-31 23:59:59') AS system_to_ts
  FROM version_log)"""


def codes(name: str, select: str, key: str, sk: str) -> str:
    return f"""{name} AS (SELECT {key}, row_number() OVER (ORDER BY {key}) AS {sk}
  FROM (SELECT DISTINCT {key} FROM ({select})))"""


CURRENCY_CODES = "SELECT l_returnflag AS currency_code FROM lineitem UNION SELECT o_orderstatus FROM orders"
DIM_CURRENCY = codes("dim_currency", CURRENCY_CODES, "currency_code", "currency_sk")
DIM_INSTRUMENT = codes(
    "dim_instrument", "SELECT CAST(p_partkey AS VARCHAR) AS instrument_id FROM part",
    "instrument_id", "instrument_sk",
)
DIM_COUNTERPARTY = codes(
    "dim_counterparty", "SELECT CAST(s_suppkey AS VARCHAR) AS counterparty_id FROM supplier",
    "counterparty_id", "counterparty_sk",
)
DIM_SOURCE = codes(
    "dim_market_data_source", "SELECT l_linestatus AS source_system_code FROM lineitem",
    "source_system_code", "market_data_source_sk",
)
