"""Common table expressions used by the check SQL (DuckDB dialect)."""

from __future__ import annotations

TICKS_ALL = """ticks_all AS (
  SELECT 'ALL' AS symbol, ts AS timestamp, value AS bid, value + 0.02 AS ask,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS bid_volume,
         100.0 - CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS ask_volume,
         event_id AS seq, strftime(ts, '%Y-%m') AS month
  FROM events)"""

TICKS_BY_TYPE = TICKS_ALL.replace("ticks_all", "ticks_by_type").replace("'ALL'", "event_type")

TICKS_LONG = """ticks_long AS (
  SELECT 'L' AS symbol,
         l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))
                    + to_minutes(CAST(l_partkey % 60 AS INTEGER)) AS timestamp,
         floor(l_extendedprice / l_quantity * 100) / 100 AS bid,
         floor(l_extendedprice / l_quantity * 100) / 100 AS ask,
         l_quantity AS bid_volume, l_quantity AS ask_volume,
         l_orderkey * 10 + l_linenumber AS seq,
         strftime(l_shipdate, '%Y-%m') AS month
  FROM lineitem)"""

TICKS_MANY = TICKS_LONG.replace("ticks_long", "ticks_many").replace("'L'", "'S' || l_suppkey")


def bars(source: str, name: str, interval: str, min_ticks: int = 5) -> str:
    """Bars as a CTE called ``name`` over the tick CTE ``source``."""
    return f"""{name} AS (
  SELECT symbol, time_bucket(INTERVAL '{interval}', timestamp) AS timestamp,
         first((bid + ask) / 2 ORDER BY timestamp, seq) AS open,
         max((bid + ask) / 2) AS high, min((bid + ask) / 2) AS low,
         last((bid + ask) / 2 ORDER BY timestamp, seq) AS close,
         sum((ask_volume + bid_volume) / 2) AS volume,
         CAST(count(*) AS INTEGER) AS tick_count,
         strftime(time_bucket(INTERVAL '{interval}', timestamp), '%Y-%m') AS month
  FROM {source}
  GROUP BY 1, 2, 9
  HAVING count(*) >= {min_ticks}
     AND last((bid + ask) / 2 ORDER BY timestamp, seq) > 0
     AND first((bid + ask) / 2 ORDER BY timestamp, seq) > 0)"""


BARS_1H = TICKS_ALL + ", " + bars("ticks_all", "b", "1 hour")
BARS_4H = TICKS_BY_TYPE + ", " + bars("ticks_by_type", "b", "4 hours")
BARS_1D = TICKS_LONG + ", " + bars("ticks_long", "b", "1 day")


def _ewm(name: str, source: str, value: str, period: int, alpha: str, start: int, keys: str) -> str:
    """A recursive CTE ``name(keys, i, y)``: seed mean, then one step per row.

    ``source`` needs columns ``keys``, ``i`` (0-based row number) and ``value``.
    """
    cols = [k.strip() for k in keys.split(",")]
    key_sel = ", ".join(f"s.{k}" for k in cols)
    match = " AND ".join(f"s.{k} = r.{k}" for k in cols)
    seed = start + period - 1
    return f"""{name}({keys}, i, y) AS (
  SELECT {keys}, {seed}, avg({value}) FROM {source} s
  WHERE i BETWEEN {start} AND {seed} GROUP BY {keys} HAVING count(*) = {period}
  UNION ALL
  SELECT {key_sel}, s.i, r.y + ({alpha}) * (s.{value} - r.y)
  FROM {name} r JOIN {source} s ON {match} AND s.i = r.i + 1)"""


def numbered(source: str = "b", keys: str = "symbol, month", name: str = "x") -> str:
    """Row number, previous close, gain, loss and true range per group."""
    return f"""{name} AS (
  SELECT *, greatest(close - pc, 0) AS gain, greatest(pc - close, 0) AS loss,
         CASE WHEN pc IS NULL THEN NULL
              ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr
  FROM (SELECT *, CAST(row_number() OVER w - 1 AS BIGINT) AS i, lag(close) OVER w AS pc FROM {source}
        WINDOW w AS (PARTITION BY {keys} ORDER BY timestamp)))"""


def ema_cte(period: int, keys: str = "symbol, month") -> str:
    return _ewm(f"e{period}", "x", "close", period, f"2.0 / ({period} + 1)", 0, keys)


def atr_cte(period: int = 14, keys: str = "symbol, month") -> str:
    return _ewm("atr_s", "x", "tr", period, f"1.0 / {period}", 1, keys)


def rsi_ctes(period: int = 14, keys: str = "symbol, month") -> str:
    return ",\n".join([
        _ewm("rg", "x", "gain", period, f"1.0 / {period}", 1, keys),
        _ewm("rl", "x", "loss", period, f"1.0 / {period}", 1, keys),
    ])


def macd_ctes(fast: int = 12, slow: int = 26, signal: int = 9, keys: str = "symbol, month") -> str:
    return ",\n".join([
        _ewm("mf", "x", "close", fast, f"2.0 / ({fast} + 1)", slow - fast, keys),
        _ewm("ms", "x", "close", slow, f"2.0 / ({slow} + 1)", 0, keys),
        f"ml AS (SELECT {keys}, i, mf.y - ms.y AS v FROM mf JOIN ms USING ({keys}, i))",
        _ewm("mg", "ml", "v", signal, f"2.0 / ({signal} + 1)", slow - 1, keys),
    ])


def labels_cte(source: str, name: str = "lab", keys: str = "symbol, month") -> str:
    """Labels for horizons 5, 10 and 20 over a source with close and atr_14."""
    cases = []
    for h in (5, 10, 20):
        ahead = f"a{h}"
        cases.append(f"""CASE WHEN {ahead} IS NULL OR atr_14 IS NULL THEN NULL
      WHEN {ahead} - close > atr_14 THEN 2 WHEN {ahead} - close > 0.5 * atr_14 THEN 1
      WHEN close - {ahead} > atr_14 THEN -2 WHEN close - {ahead} > 0.5 * atr_14 THEN -1
      ELSE 0 END AS label_{h}""")
    leads = ", ".join(f"lead(close, {h}) OVER w AS a{h}" for h in (5, 10, 20))
    return f"""{name} AS (
  SELECT *, {', '.join(f'a{h} AS close_ahead_{h}' for h in (5, 10, 20))}, {', '.join(cases)}
  FROM (SELECT *, {leads} FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY timestamp)))"""


def with_ctes(*parts: str, recursive: bool = True) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


# Hourly bars with ATR and labels: the common base of the trading queries.
WITH_ATR = [
    BARS_1H, numbered(), atr_cte(),
    "ba AS (SELECT x.*, atr_s.y AS atr_14 FROM x LEFT JOIN atr_s USING (symbol, month, i))",
]
LABELLED_1H = [*WITH_ATR, labels_cte("ba")]

# Weekly bars of all supplier symbols, whole-series groups.
WITH_ATR_1W = [
    TICKS_MANY + ", " + bars("ticks_many", "b", "7 days", 1), numbered(keys="symbol"), atr_cte(keys="symbol"),
    "ba AS (SELECT x.*, atr_s.y AS atr_14 FROM x LEFT JOIN atr_s USING (symbol, i))",
]
LABELLED_1W = [*WITH_ATR_1W, labels_cte("ba", keys="symbol")]
