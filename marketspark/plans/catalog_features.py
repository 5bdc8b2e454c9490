"""Queries over sessions, levels, indicators and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.operators import indicators, labels, levels, sessions
from marketspark.operators.bars import resample
from marketspark.plans import sqlparts as S
from marketspark.plans.common import bars_1d, bars_1h, bars_4h
from marketspark.plans.registry import query, tidy, tidy_sql
from marketspark.plans.stages import feature_table, stage_stats, ticks_to_labels
from marketspark.schema import SESSIONS
from marketspark.session import stage
from marketspark.sources import store, views

KEY = ["symbol", "timestamp"]

# ---------------------------------------------------------------- sessions
_ET = """et AS (SELECT *, (timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS e FROM {src})"""
_SQL_WINDOWS = {
    "asia": "m >= 1200",
    "london": "m >= 120 AND m < 300",
    "nyam": "m >= 570 AND m < 660",
    "nylunch": "m >= 720 AND m < 780",
    "nypm": "m >= 810 AND m < 960",
}
_FLAGS = "fl AS (SELECT *, " + ", ".join(
    f"({cond}) AS in_{s}" for s, cond in _SQL_WINDOWS.items()
) + " FROM (SELECT *, hour(e) * 60 + minute(e) AS m FROM et))"
_OPENED = "op AS (SELECT *, " + ", ".join(
    f"""CASE WHEN row_number() OVER w = 1 THEN NULL
        WHEN in_{s} AND NOT lag(in_{s}) OVER w THEN 1 ELSE 0 END AS o_{s}""" for s in SESSIONS
) + ", row_number() OVER w AS rn, count(*) OVER (PARTITION BY symbol, month) AS cnt FROM fl WINDOW w AS (PARTITION BY symbol, month ORDER BY timestamp))"
_IDS = "sid AS (SELECT *, " + ", ".join(
    f"CAST(sum(o_{s}) OVER (PARTITION BY symbol, month ORDER BY timestamp) AS BIGINT) AS kz_{s}_session_id"
    for s in SESSIONS
) + " FROM op)"
_LEVELS = "lv AS (SELECT *, " + ", ".join(
    f"""max(high) OVER s_{s} AS kz_{s}_high, min(low) OVER s_{s} AS kz_{s}_low""" for s in SESSIONS
) + " FROM sid WINDOW " + ", ".join(
    f"s_{s} AS (PARTITION BY symbol, month, kz_{s}_session_id ORDER BY timestamp)" for s in SESSIONS
) + ")"
_DERIVED = "kz AS (SELECT *, " + ", ".join(
    f"""(kz_{s}_high + kz_{s}_low) / 2 AS kz_{s}_mid, kz_{s}_high - kz_{s}_low AS kz_{s}_range,
    close - kz_{s}_high AS dist_to_{s}_high, close - kz_{s}_low AS dist_to_{s}_low""" for s in SESSIONS
) + " FROM lv)"


def _session_ctes(base: str, src: str = "b") -> list[str]:
    return [base, _ET.format(src=src), _FLAGS, _OPENED, _IDS, _LEVELS, _DERIVED]


def _avg_range_ctes() -> list[str]:
    out = []
    for s in SESSIONS:
        sid = f"kz_{s}_session_id"
        out.append(f"""ar_{s} AS (SELECT symbol, month, {sid},
  avg(sr) OVER (PARTITION BY symbol, month ORDER BY {sid} NULLS FIRST ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
    AS kz_{s}_avg_range
  FROM (SELECT symbol, month, {sid}, max(kz_{s}_range) AS sr FROM kz WHERE in_{s} OR rn = cnt GROUP BY 1, 2, 3))""")
    joins = " ".join(
        f"LEFT JOIN ar_{s} USING (symbol, month, kz_{s}_session_id)" for s in SESSIONS)
    out.append(f"kza AS (SELECT kz.*, {', '.join(f'kz_{s}_avg_range' for s in SESSIONS)} FROM kz {joins})")
    return out


# Hourly bars over seven years of line-item ticks, so both DST changes occur.
_LONG_1H = S.TICKS_LONG + ", " + S.bars("ticks_long", "b", "1 hour", 1)


def _long_1h(spark, sf):
    return resample(views.ticks_long(spark, sf), "1H", min_ticks=1, tie_col="seq")


@query("et_parts", "D1", S.with_ctes(_LONG_1H, _ET.format(src="b")) + """
SELECT symbol, timestamp, CAST(hour(e) AS INT) AS et_hour, CAST(minute(e) AS INT) AS et_minute,
  CAST(isodow(e) AS INT) AS et_weekday, strftime(e, '%Y-%m-%d') AS et_date FROM et""")
def et_parts(spark, sf):
    return tidy(sessions.et_parts(_long_1h(spark, sf)),
                [*KEY, "et_hour", "et_minute", "et_weekday", "et_date"])


_IN = [f"in_{s}" for s in SESSIONS]


@query("session_flags", "D2", S.with_ctes(_LONG_1H, _ET.format(src="b"), _FLAGS)
       + f"SELECT symbol, timestamp, {', '.join(f'{c}::INT AS {c}' for c in _IN)} FROM fl")
def session_flags(spark, sf):
    return tidy(sessions.session_flags(_long_1h(spark, sf)), [*KEY, *_IN])


_SID = [f"kz_{s}_session_id" for s in SESSIONS]


@query("session_ids", "D3", S.with_ctes(*_session_ctes(_LONG_1H)[:5])
       + f"SELECT symbol, timestamp, {', '.join(_SID)} FROM sid")
def session_ids(spark, sf):
    return tidy(sessions.session_ids(sessions.session_flags(_long_1h(spark, sf))), [*KEY, *_SID])


_KZ = [f"{p}{s}{q}" for s in SESSIONS for p, q in (
    ("kz_", "_high"), ("kz_", "_low"), ("kz_", "_mid"), ("kz_", "_range"),
    ("dist_to_", "_high"), ("dist_to_", "_low"))]


@query("killzone_levels", "D4", tidy_sql(
    S.with_ctes(*_session_ctes(_LONG_1H)) + "SELECT * FROM kz", _KZ, KEY))
def killzone_levels(spark, sf):
    df = sessions.session_ids(sessions.session_flags(_long_1h(spark, sf)))
    return tidy(sessions.session_levels(df), [*KEY, *_KZ])


_AVG = [f"kz_{s}_avg_range" for s in SESSIONS]


@query("killzone_avg_range", "D5", tidy_sql(
    S.with_ctes(*_session_ctes(_LONG_1H), *_avg_range_ctes()) + "SELECT * FROM kza", _AVG, KEY))
def killzone_avg_range(spark, sf):
    df = sessions.session_ids(sessions.session_flags(_long_1h(spark, sf)))
    df = sessions.session_average_range(sessions.session_levels(df))
    return tidy(df, [*KEY, *_AVG])


_PERIODS = """pk AS (SELECT *, CAST(e AS DATE) AS kd, year(e) * 100 + weekofyear(e) AS kw,
  year(e) * 100 + month(e) AS km FROM et)"""


def _running_sql(parts: str) -> str:
    cols = ", ".join(
        f"first(open) OVER w{p} AS {p}_open, max(high) OVER w{p} AS {p}_high, min(low) OVER w{p} AS {p}_low"
        for p in "dwm")
    wins = ", ".join(f"w{p} AS (PARTITION BY {parts}, k{p} ORDER BY timestamp)" for p in "dwm")
    return f"SELECT *, {cols} FROM pk WINDOW {wins}"


def _previous_ctes(parts: str) -> list[str]:
    out = [f"""s{p} AS (SELECT {parts}, k{p}, lag(hi) OVER v AS p{p}_high, lag(lo) OVER v AS p{p}_low
  FROM (SELECT {parts}, k{p}, max(high) AS hi, min(low) AS lo FROM pk GROUP BY ALL)
  WINDOW v AS (PARTITION BY {parts} ORDER BY k{p}))""" for p in "dwm"]
    joins = " ".join(f"LEFT JOIN s{p} USING ({parts}, k{p})" for p in "dwm")
    out.append(f"pv AS (SELECT * FROM pk {joins})")
    return out


_RUN = [f"{p}_{c}" for p in "dwm" for c in ("open", "high", "low")]
_PREV = [f"p{p}_{c}" for p in "dwm" for c in ("high", "low")]


@query("dwm_running", "D6", tidy_sql(
    S.with_ctes(_LONG_1H, _ET.format(src="b"), _PERIODS) + _running_sql("symbol, month"), _RUN, KEY))
def dwm_running(spark, sf):
    return tidy(sessions.period_running(_long_1h(spark, sf)), [*KEY, *_RUN])


@query("dwm_previous", "D7", tidy_sql(
    S.with_ctes(_LONG_1H, _ET.format(src="b"), _PERIODS, *_previous_ctes("symbol, month"))
    + "SELECT * FROM pv", _PREV, KEY))
def dwm_previous(spark, sf):
    return tidy(sessions.period_previous(_long_1h(spark, sf)), [*KEY, *_PREV])


# ---------------------------------------------------------------- levels
_PAT = list(levels.PATTERNS)


def _pattern_ctes(src: str, name: str = "pt") -> list[str]:
    return [f"""pl AS (SELECT *, lag(high, 2) OVER w AS h2, lag(low, 2) OVER w AS l2,
  lag(high, 3) OVER w AS h3, lag(low, 3) OVER w AS l3, lag(high, 4) OVER w AS h4, lag(low, 4) OVER w AS l4,
  lag(close) OVER w AS c1, lag(open) OVER w AS o1, lag(open, 2) OVER w AS o2
  FROM {src} WINDOW w AS (PARTITION BY symbol, month ORDER BY timestamp))""",
    """pr AS (SELECT *, high < l2 - (h2 - l2) AND abs(c1 - o1) > 2 * (h2 - l2) AS q1,
  high < least(l3, l4) - (greatest(h3, h4) - least(l3, l4))
    AND abs(c1 - o2) > 2 * (greatest(h3, h4) - least(l3, l4)) AS q2,
  low > h2 - (h2 - l2) AND abs(c1 - o1) > 2 * (h2 - l2) AS q3,
  low > greatest(h3, h4) + (greatest(h3, h4) - least(l3, l4))
    AND abs(c1 - o2) > 2 * (greatest(h3, h4) - least(l3, l4)) AS q4 FROM pl)""",
    f"{name} AS (SELECT *, " + ", ".join(
        f"q{k} AND " + " AND ".join(f"NOT coalesce(lag(q{k}, {n}) OVER w, false)" for n in range(1, 5))
        + f" AS {c}" for k, c in enumerate(_PAT, 1)
    ) + " FROM pr WINDOW w AS (PARTITION BY symbol, month ORDER BY timestamp))"]


@query("sr_patterns", "E1a, E1b", S.with_ctes(_LONG_1H, *_pattern_ctes("b"))
       + f"SELECT symbol, timestamp, {', '.join(f'{c}::INT AS {c}' for c in _PAT)} FROM pt")
def sr_patterns(spark, sf):
    return tidy(levels.sr_patterns(_long_1h(spark, sf)), [*KEY, *_PAT])


_ZONE = ["nearest_resist_high", "nearest_resist_low", "nearest_support_high", "nearest_support_low",
         "dist_to_nearest_resist", "dist_to_nearest_support"]
_ZONE_CTES = ["""zf AS (SELECT *, """ + ", ".join(
    f"""last_value(CASE WHEN sr_{side}_1bar OR sr_{side}_2bar THEN {'h2' if edge == 'high' else 'l2'} END IGNORE NULLS)
  OVER w AS nearest_{side}_{edge}""" for side in ("resist", "support") for edge in ("high", "low")
) + " FROM pt WINDOW w AS (PARTITION BY symbol, month ORDER BY timestamp ROWS UNBOUNDED PRECEDING))",
    """zn AS (SELECT *, close - nearest_resist_low AS dist_to_nearest_resist,
  nearest_support_high - close AS dist_to_nearest_support,
  (close BETWEEN nearest_resist_low AND nearest_resist_high) AS in_resist_zone,
  (close BETWEEN nearest_support_low AND nearest_support_high) AS in_support_zone,
  CASE WHEN close > nearest_resist_high THEN 1 WHEN close < nearest_support_low THEN -1 ELSE 0 END
    AS sr_role_reversal FROM zf)"""]


@query("sr_zones", "E1c", tidy_sql(
    S.with_ctes(_LONG_1H, *_pattern_ctes("b"), *_ZONE_CTES) + "SELECT * FROM zn",
    _ZONE, [*KEY, "in_resist_zone::INT AS in_resist_zone", "in_support_zone::INT AS in_support_zone",
            "sr_role_reversal"]))
def sr_zones(spark, sf):
    df = levels.sr_zones(levels.sr_patterns(_long_1h(spark, sf)))
    return tidy(df, [*KEY, *_ZONE, "in_resist_zone", "in_support_zone", "sr_role_reversal"])


_PIVOT_SQL = {
    "traditional": dict(p="(h+l+c)/3", r1="2*(h+l+c)/3-l", s1="2*(h+l+c)/3-h", r2="(h+l+c)/3+h-l",
                        s2="(h+l+c)/3-h+l", r3="h+2*((h+l+c)/3-l)", s3="l-2*(h-(h+l+c)/3)",
                        r4="2*h+2*((h+l+c)/3-l)-l", s4="2*l-2*(h-(h+l+c)/3)-h",
                        r5="3*h+2*((h+l+c)/3-l)-2*l", s5="3*l-2*(h-(h+l+c)/3)-2*h"),
    "fibonacci": dict(p="(h+l+c)/3", r1="(h+l+c)/3+0.382*(h-l)", s1="(h+l+c)/3-0.382*(h-l)",
                      r2="(h+l+c)/3+0.618*(h-l)", s2="(h+l+c)/3-0.618*(h-l)",
                      r3="(h+l+c)/3+(h-l)", s3="(h+l+c)/3-(h-l)"),
    "woodie": dict(p="(h+l+2*c)/4", r1="(h+l+2*c)/2-l", s1="(h+l+2*c)/2-h", r2="(h+l+2*c)/4+h-l",
                   s2="(h+l+2*c)/4-h+l", r3="h+2*((h+l+2*c)/4-l)", s3="l-2*(h-(h+l+2*c)/4)",
                   r4="2*h+2*((h+l+2*c)/4-l)-l", s4="2*l-2*(h-(h+l+2*c)/4)-h"),
    "dm": dict(p="x/4", r1="x/2-l", s1="x/2-h"),
    "camarilla": dict(p="(h+l+c)/3", r1="c+(h-l)*1.1/12", s1="c-(h-l)*1.1/12", r2="c+(h-l)*1.1/6",
                      s2="c-(h-l)*1.1/6", r3="c+(h-l)*1.1/4", s3="c-(h-l)*1.1/4", r4="c+(h-l)*1.1/2",
                      s4="c-(h-l)*1.1/2", r5="h/l*c", s5="c-(h/l*c-c)"),
}
_PIVOT_SQL["classic"] = _PIVOT_SQL["traditional"]


def _pivot_ctes(kind: str, unit: str, parts: str, src: str) -> list[str]:
    """Levels valid from the next present period on, found by an as-of join."""
    cols = ", ".join(f"CAST({_PIVOT_SQL[kind].get(k, 'NULL')} AS DOUBLE) AS pp_{k}" for k in levels.LEVELS)
    return [f"""po AS (SELECT {parts}, date_trunc('{unit}', timestamp) AS ps, arg_min(open, timestamp) AS o,
  max(high) AS h, min(low) AS l, arg_max(close, timestamp) AS c FROM {src} GROUP BY ALL)""",
    f"""pp AS (SELECT *, {cols}, lead(ps) OVER (PARTITION BY {parts} ORDER BY ps) AS valid_from
  FROM (SELECT *, CASE WHEN c < o THEN h + 2*l + c WHEN c > o THEN 2*h + l + c ELSE h + l + 2*c END AS x FROM po))""",
    f"""pj AS (SELECT s.*, {', '.join(f'pp_{k}' for k in levels.LEVELS)}, close - pp_p AS pp_dist_to_p,
  close > pp_p AS pp_above_p, close - pp_r1 AS pp_dist_to_r1, close - pp_s1 AS pp_dist_to_s1
  FROM {src} s ASOF LEFT JOIN (SELECT * FROM pp WHERE valid_from IS NOT NULL) pp
    ON {' AND '.join(f's.{k.strip()} = pp.{k.strip()}' for k in parts.split(','))} AND s.timestamp >= pp.valid_from)"""]


_PP = [f"pp_{k}" for k in levels.LEVELS] + ["pp_dist_to_p", "pp_dist_to_r1", "pp_dist_to_s1"]
_PP_OTHER = [*KEY, "pp_above_p::INT AS pp_above_p"]


def _register_kind(kind: str) -> None:
    @query(f"pivots_{kind}", "E1d, E1f", tidy_sql(
        S.with_ctes(S.BARS_4H, *_pivot_ctes(kind, "day", "symbol, month", "b")) + "SELECT * FROM pj",
        _PP, _PP_OTHER))
    def run(spark, sf):
        return tidy(levels.pivot_points(bars_4h(spark, sf), kind), [*KEY, *_PP, "pp_above_p"])


for _kind in _PIVOT_SQL:
    _register_kind(_kind)


def _register_anchor(anchor: str, unit: str) -> None:
    @query(f"pivot_join_{anchor}", "E1e, E1f", tidy_sql(
        S.with_ctes(S.BARS_1D, *_pivot_ctes("traditional", unit, "symbol", "b")) + "SELECT * FROM pj",
        _PP, _PP_OTHER))
    def run(spark, sf):
        df = levels.pivot_points(bars_1d(spark, sf, staged=True), "traditional", anchor, ("symbol",))
        return tidy(df, [*KEY, *_PP, "pp_above_p"])


for _anchor, _unit in (("daily", "day"), ("weekly", "week"), ("monthly", "month"),
                       ("quarterly", "quarter"), ("yearly", "year")):
    _register_anchor(_anchor, _unit)


@query("asof_backward", "E1g", tidy_sql(S.with_ctes(
    S.TICKS_BY_TYPE, "q AS (SELECT * FROM ticks_by_type WHERE seq % 50 = 0)") + """
SELECT t.symbol, t.timestamp, t.seq, t.bid, q.bid AS quote_bid, q.seq AS quote_seq
FROM ticks_by_type t ASOF LEFT JOIN q ON t.symbol = q.symbol AND t.timestamp >= q.timestamp""",
    ["bid", "quote_bid"], ["symbol", "timestamp", "seq", "quote_seq"]))
def asof_backward(spark, sf):
    t = views.ticks_by_type(spark, sf).select("symbol", "timestamp", "seq", "bid")
    quotes = t.where(F.col("seq") % 50 == 0).select(
        "symbol", "timestamp", F.col("bid").alias("quote_bid"), F.col("seq").alias("quote_seq"))
    return tidy(levels.asof_backward(t, quotes, values=["quote_bid", "quote_seq"]),
                ["symbol", "timestamp", "seq", "bid", "quote_bid", "quote_seq"])


# ---------------------------------------------------------------- indicators
def _join_series(*pairs: tuple[str, str], keys: str = "symbol, month") -> str:
    joins = " ".join(f"LEFT JOIN {cte} USING ({keys}, i)" for cte, _ in pairs)
    return f"SELECT x.*, {', '.join(f'{cte}.y AS {name}' for cte, name in pairs)} FROM x {joins}"


_EMAS = ["ema_20", "ema_50", "ema_200"]
_EMA_CTES = [S.ema_cte(20), S.ema_cte(50), S.ema_cte(200)]


@query("ema", "F1", tidy_sql(S.with_ctes(S.BARS_1H, S.numbered(), *_EMA_CTES)
       + _join_series(("e20", "ema_20"), ("e50", "ema_50"), ("e200", "ema_200")), _EMAS, KEY))
def ema(spark, sf):
    return tidy(indicators.ema(bars_1h(spark, sf)), [*KEY, *_EMAS])


_CONT = S.numbered(keys="symbol")


@query("ema_whole_series", "F1", tidy_sql(
    S.with_ctes(S.BARS_1D, _CONT, *[S.ema_cte(p, "symbol") for p in (20, 50, 200)])
    + _join_series(("e20", "ema_20"), ("e50", "ema_50"), ("e200", "ema_200"), keys="symbol"), _EMAS, KEY))
def ema_whole_series(spark, sf):
    base = bars_1d(spark, sf, staged=True)
    return tidy(indicators.ema(base, ("symbol",)), [*KEY, *_EMAS])


_RSI = "CASE WHEN rg.y + rl.y = 0 THEN 0 ELSE 100 * rg.y / (rg.y + rl.y) END"


@query("rsi", "F2", tidy_sql(S.with_ctes(S.BARS_1H, S.numbered(), S.rsi_ctes()) + f"""
SELECT x.*, {_RSI} AS rsi_14 FROM x LEFT JOIN rg USING (symbol, month, i) LEFT JOIN rl USING (symbol, month, i)
""", ["rsi_14"], KEY).replace("CASE WHEN rg.y + rl.y = 0", "CASE WHEN rg.y IS NULL THEN NULL WHEN rg.y + rl.y = 0"))
def rsi(spark, sf):
    return tidy(indicators.rsi(bars_1h(spark, sf)), [*KEY, "rsi_14"])


_MACD = ["macd", "macd_signal", "macd_hist"]


@query("macd", "F3", tidy_sql(S.with_ctes(S.BARS_1H, S.numbered(), S.macd_ctes()) + """
SELECT x.*, CASE WHEN mg.y IS NOT NULL THEN ml.v END AS macd, mg.y AS macd_signal, ml.v - mg.y AS macd_hist
FROM x LEFT JOIN ml USING (symbol, month, i) LEFT JOIN mg USING (symbol, month, i)""", _MACD, KEY))
def macd(spark, sf):
    return tidy(indicators.macd(bars_1h(spark, sf)), [*KEY, *_MACD])


@query("atr", "F4", tidy_sql(S.with_ctes(*S.WITH_ATR) + "SELECT * FROM ba", ["atr_14"], KEY))
def atr(spark, sf):
    return tidy(indicators.atr(bars_1h(spark, sf)), [*KEY, "atr_14"])


_LONG_KEYS = "symbol"
_WHOLE = ["rsi_14", *_MACD, "atr_14"]


@query("oscillators_whole_series", "F2, F3, F4", tidy_sql(
    S.with_ctes(S.BARS_1D, _CONT, S.rsi_ctes(keys="symbol"), S.macd_ctes(keys="symbol"),
                S.atr_cte(keys="symbol")) + """
SELECT x.*, CASE WHEN rg.y IS NULL THEN NULL WHEN rg.y + rl.y = 0 THEN 0 ELSE 100 * rg.y / (rg.y + rl.y) END AS rsi_14,
  CASE WHEN mg.y IS NOT NULL THEN ml.v END AS macd, mg.y AS macd_signal, ml.v - mg.y AS macd_hist, atr_s.y AS atr_14
FROM x LEFT JOIN rg USING (symbol, i) LEFT JOIN rl USING (symbol, i) LEFT JOIN ml USING (symbol, i)
LEFT JOIN mg USING (symbol, i) LEFT JOIN atr_s USING (symbol, i)""", _WHOLE, KEY))
def oscillators_whole_series(spark, sf):
    base = bars_1d(spark, sf, staged=True)
    df = indicators.add_indicators(base, ("symbol",), ema_periods=())
    return tidy(df, [*KEY, *_WHOLE])


_DIST = ["dist_to_asia_high", "dist_to_asia_low", "dist_to_nypm_high", "dist_to_nypm_low"]
_DIST_ATR = [f"{c}_atr" for c in _DIST]


@query("normalized_distances", "F5", tidy_sql(
    S.with_ctes(*S.WITH_ATR, *_session_ctes("z AS (SELECT 1)", "ba")) + "SELECT *, "
    + ", ".join(f"CASE WHEN atr_14 <> 0 THEN {c} / atr_14 END AS {c}_atr" for c in _DIST)
    + " FROM kz", _DIST_ATR, KEY))
def normalized_distances(spark, sf):
    df = sessions.session_ids(sessions.session_flags(indicators.atr(bars_1h(spark, sf))))
    return tidy(indicators.normalized_distances(sessions.session_levels(df)), [*KEY, *_DIST_ATR])


# Everything at once, on month groups of the hourly bars.
_FULL_CTES = [
    *_session_ctes(S.BARS_1H), *_avg_range_ctes(),
    "et2 AS (SELECT * FROM kza)",
    _PERIODS.replace("FROM et)", "FROM et2)"),
    f"rn1 AS ({_running_sql('symbol, month')})",
    *[c.replace("FROM pk", "FROM rn1") for c in _previous_ctes("symbol, month")],
    *_pattern_ctes("pv"), *_ZONE_CTES,
    *_pivot_ctes("traditional", "day", "symbol, month", "zn"),
    S.numbered("pj"), *_EMA_CTES, S.rsi_ctes(), S.macd_ctes(), S.atr_cte(),
    """ff AS (SELECT x.*, e20.y AS ema_20, e50.y AS ema_50, e200.y AS ema_200, atr_s.y AS atr_14,
  CASE WHEN rg.y IS NULL THEN NULL WHEN rg.y + rl.y = 0 THEN 0 ELSE 100 * rg.y / (rg.y + rl.y) END AS rsi_14,
  CASE WHEN mg.y IS NOT NULL THEN ml.v END AS macd, mg.y AS macd_signal, ml.v - mg.y AS macd_hist
  FROM x LEFT JOIN e20 USING (symbol, month, i) LEFT JOIN e50 USING (symbol, month, i)
  LEFT JOIN e200 USING (symbol, month, i) LEFT JOIN rg USING (symbol, month, i)
  LEFT JOIN rl USING (symbol, month, i) LEFT JOIN ml USING (symbol, month, i)
  LEFT JOIN mg USING (symbol, month, i) LEFT JOIN atr_s USING (symbol, month, i))""",
]
_ALL_DIST = [f"dist_to_{s}_{e}" for s in SESSIONS for e in ("high", "low")] + [
    "dist_to_nearest_resist", "dist_to_nearest_support", "pp_dist_to_p", "pp_dist_to_r1", "pp_dist_to_s1"]
_FULL_CTES.append("fx AS (SELECT *, " + ", ".join(
    f"CASE WHEN atr_14 <> 0 THEN {c} / atr_14 END AS {c}_atr" for c in _ALL_DIST) + " FROM ff)")
_FULL_DOUBLES = ["open", "high", "low", "close", "volume", *_KZ, *_AVG, *_RUN, *_PREV, *_ZONE, *_PP,
                 *_EMAS, "rsi_14", *_MACD, "atr_14", *[f"{c}_atr" for c in _ALL_DIST]]
_FULL_OTHER = [*KEY, *_SID]
_FULL_BOOL = [*_IN, *_PAT, "in_resist_zone", "in_support_zone", "pp_above_p"]


@query("feature_matrix", "D8, F6", tidy_sql(
    S.with_ctes(*_FULL_CTES) + "SELECT * FROM fx", _FULL_DOUBLES,
    [*_FULL_OTHER, "sr_role_reversal", *[f"{c}::INT AS {c}" for c in _FULL_BOOL]]))
def feature_matrix(spark, sf):
    df = feature_table(bars_1h(spark, sf))
    return tidy(df, [*_FULL_OTHER, "sr_role_reversal", *_FULL_BOOL, *_FULL_DOUBLES])


# ---------------------------------------------------------------- labels
_LAB = ["close_ahead_5", "close_ahead_10", "close_ahead_20"]
_LABELS = ["label_5", "label_10", "label_20"]


@query("labels_5_10_20", "G1", tidy_sql(
    S.with_ctes(*S.LABELLED_1H) + "SELECT * FROM lab", _LAB, [*KEY, *_LABELS]))
def labels_5_10_20(spark, sf):
    return tidy(labels.add_labels(indicators.atr(bars_1h(spark, sf))), [*KEY, *_LAB, *_LABELS])


_MONTHLY_LAB = [S.BARS_1D, S.numbered(), S.atr_cte(),
                "ba AS (SELECT x.*, atr_s.y AS atr_14 FROM x LEFT JOIN atr_s USING (symbol, month, i))",
                S.labels_cte("ba")]


@query("labels_by_month", "G2", S.with_ctes(*_MONTHLY_LAB) + """
SELECT symbol, '1D' AS tf, month, count(*) AS bars, count(label_5) AS labelled_5, count(label_10) AS labelled_10,
  CAST(coalesce(sum(label_5), 0) AS BIGINT) AS sum_5 FROM lab GROUP BY 1, 2, 3""")
def labels_by_month(spark, sf):
    bars = stage(bars_1d(spark, sf).withColumn("tf", F.lit("1D")), "bars", ("symbol", "tf", "month"))
    out = store.new_table_path(spark, "labels")
    keys = ("symbol", "tf", "month")
    store.refresh(bars, out, lambda df: labels.add_labels(indicators.atr(df, keys), partition_cols=keys))
    return _by_month(store.read_table(spark, out, tf="1D"))


def _by_month(table):
    return table.groupBy("symbol", "tf", F.date_format("month", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("bars"), F.count("label_5").alias("labelled_5"),
        F.count("label_10").alias("labelled_10"),
        F.coalesce(F.sum("label_5"), F.lit(0)).alias("sum_5"),
    )


@query("labels_after_lost_months", "G2, A11", S.with_ctes(*_MONTHLY_LAB) + """
SELECT symbol, '1D' AS tf, month, count(*) AS bars, count(label_5) AS labelled_5, count(label_10) AS labelled_10,
  CAST(coalesce(sum(label_5), 0) AS BIGINT) AS sum_5 FROM lab WHERE month NOT IN ('1996-03', '1997-05') GROUP BY 1, 2, 3""")
def labels_after_lost_months(spark, sf):
    """A month leaves the source, and the result of a changed month becomes empty."""
    keys = ("symbol", "tf", "month")
    bars = stage(bars_1d(spark, sf).withColumn("tf", F.lit("1D")), "bars")
    out = store.new_table_path(spark, "labels")

    def run(df):
        return labels.add_labels(indicators.atr(df.where("close > 0"), keys), partition_cols=keys)

    month = F.date_format("month", "yyyy-MM")
    store.refresh(bars, out, run, keys=keys)
    store.refresh(bars.where(month != "1996-03").withColumn(
        "close", F.when(month == "1997-05", -1.0).otherwise(F.col("close"))), out, run, keys=keys)
    return _by_month(store.read_table(spark, out, tf="1D"))


_FLAG_DOUBLES = ["open", "high", "low", "close", "rsi_14", "macd_hist", "atr_14", "ema_20", "pp_p",
                 "kz_london_range", "d_high", "pd_high", "dist_to_asia_high_atr", "close_ahead_10"]


@query("ticks_to_labels", "G3", tidy_sql(
    S.with_ctes(*_FULL_CTES, S.labels_cte("fx")) + "SELECT * FROM lab", _FLAG_DOUBLES,
    [*KEY, *_LABELS]))
def ticks_to_labels_query(spark, sf):
    return tidy(ticks_to_labels(views.ticks_all(spark, sf)), [*KEY, *_FLAG_DOUBLES, *_LABELS])


_STATS_TF = {"1H": "1 hour", "4H": "4 hours"}
_STATS_SQL = S.with_ctes(S.TICKS_BY_TYPE, *[
    part for i, step in enumerate(_STATS_TF.values()) for part in (
        S.bars("ticks_by_type", f"b{i}", step, 1), S.numbered(f"b{i}", name=f"x{i}"))
]) + " UNION ALL ".join(f"""
SELECT symbol, '{tf}' AS tf, count(*) AS bars,
  count(*) FILTER (i >= 14 AND i < n - 10) AS labelled, count(DISTINCT month) AS months,
  min(timestamp) AS first_bar, max(timestamp) AS last_bar
FROM (SELECT *, count(*) OVER (PARTITION BY symbol, month) AS n FROM x{i}) GROUP BY symbol"""
    for i, tf in enumerate(_STATS_TF))


@query("label_stage_stats", "G3", _STATS_SQL)
def label_stage_stats(spark, sf):
    return stage_stats(ticks_to_labels(views.ticks_by_type(spark, sf), list(_STATS_TF), min_ticks=1))
