"""Queries over trades and performance."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from marketspark.operators import backtest, evaluation, models, prep, registry, reports
from marketspark.operators.select import label_to_signal
from marketspark.plans import sqlparts as S
from marketspark.plans.catalog_models import _MR, FEATURES, _model_rows, _nb_ctes
from marketspark.plans.common import labelled_1h, labelled_1w
from marketspark.plans.registry import query, tidy, tidy_sql
from marketspark.session import scratch_path, stage

_RULES = dict(tp_r=1.5, sl_r=1.0, commission=0.1)
# Weekly ranges of the supplier symbols are in the thousands, so is a fair fee.
_RULES_1W = dict(tp_r=1.5, sl_r=1.0, commission=200.0)


def _signal_bars(spark, sf, base=labelled_1w):
    df = base(spark, sf, staged=False).withColumn("signal", label_to_signal("label_10"))
    cols = ["symbol", "timestamp", "month", "open", "high", "low", "close", "atr_14", "signal", "label_10"]
    return backtest.indexed_bars(df.select(*cols, *[c for c in ("idx", "n") if c in df.columns]))


def _trades(spark, sf):
    """Trades of every supplier symbol on weekly bars."""
    return backtest.simulate_trades(_signal_bars(spark, sf), **_RULES_1W)


def _trades_1h(spark, sf):
    """Trades of the event series on hourly bars, where entry hours differ."""
    return backtest.simulate_trades(_signal_bars(spark, sf, labelled_1h), **_RULES)


def _candidate_sql(src: str, series: str, tp: str, sl: str, fee: str) -> str:
    """Exit of every signal, found by joining the ten bars after the entry bar."""
    on = " AND ".join(f"f.{k} = s.{k}" for k in series.split(", "))
    on_e = on.replace("f.", "e.")
    part = ", ".join(f"s.{k}" for k in series.split(", "))
    return f"""cand AS (
  SELECT {part}, s.i, e.timestamp AS entry_time, e.open AS entry_price, s.signal AS dir, s.atr_14 * 0.5 AS risk,
    {tp} AS tp, {sl} AS sl, {fee} AS fee, s.n
  FROM {src} s JOIN {src} e ON {on_e} AND e.i = s.i + 1 WHERE s.signal <> 0 AND s.atr_14 > 0),
 hits AS (SELECT s.*, f.i - s.i - 1 AS held, f.timestamp AS exit_time, f.close AS fclose,
    CASE WHEN s.dir = 1 AND f.low <= entry_price - risk * sl THEN 'SL'
         WHEN s.dir = -1 AND f.high >= entry_price + risk * sl THEN 'SL'
         WHEN s.dir = 1 AND f.high >= entry_price + risk * tp THEN 'TP'
         WHEN s.dir = -1 AND f.low <= entry_price - risk * tp THEN 'TP'
         WHEN f.i - s.i - 1 >= 10 THEN 'TIME' END AS reason
  FROM cand s LEFT JOIN {src} f ON {on} AND f.i BETWEEN s.i + 2 AND s.i + 11),
 fin AS (SELECT * FROM hits WHERE reason IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY {series}, i ORDER BY held) = 1),
 cd AS (SELECT {', '.join(f'c.{k}' for k in series.split(', '))}, c.i, c.entry_time, f.exit_time,
    CASE c.dir WHEN 1 THEN 'LONG' ELSE 'SHORT' END AS signal, c.entry_price,
    CASE f.reason WHEN 'SL' THEN c.entry_price - c.dir * c.risk * c.sl WHEN 'TP' THEN c.entry_price + c.dir * c.risk * c.tp
      ELSE f.fclose END AS exit_price, f.held AS bars_held,
    CASE f.reason WHEN 'SL' THEN -c.sl WHEN 'TP' THEN c.tp ELSE c.dir * (f.fclose - c.entry_price) / c.risk END
      - c.fee / c.risk AS pnl_r, f.reason, CAST(isodow(c.entry_time) - 1 AS INT) AS weekday,
    CAST(hour(c.entry_time) AS INT) AS hour, coalesce(c.i + 1 + f.held, c.n) AS exit_i
  FROM cand c LEFT JOIN fin f USING ({series}, i))"""


def _walk_sql(series: str) -> str:
    """One position at a time: from each taken trade jump to the next free signal."""
    keys = series.split(", ")
    on = " AND ".join(f"c.{k} = w.{k}" for k in keys)
    return f"""walk AS (
  SELECT * FROM (SELECT * FROM cd QUALIFY row_number() OVER (PARTITION BY {series} ORDER BY i) = 1)
  UNION ALL
  SELECT * FROM (SELECT c.* FROM walk w JOIN cd c ON {on} AND c.i >= w.exit_i
    QUALIFY row_number() OVER (PARTITION BY {', '.join(f'c.{k}' for k in keys)} ORDER BY c.i) = 1)),
 tr AS (SELECT *, row_number() OVER (PARTITION BY {series} ORDER BY i) - 1 AS t FROM walk WHERE reason IS NOT NULL)"""


_SIGNALS = """sg AS (SELECT *, CASE WHEN label_10 > 0 THEN 1 WHEN label_10 < 0 THEN -1 ELSE 0 END AS signal
  FROM (SELECT * EXCLUDE (i), row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i,
    count(*) OVER (PARTITION BY symbol) AS n FROM lab))"""
_CAND = [*S.LABELLED_1W, _SIGNALS, _candidate_sql("sg", "symbol", "1.5", "1.0", "200.0")]
_TRADES = [*_CAND, _walk_sql("symbol")]
_TRADES_1H = [*S.LABELLED_1H, _SIGNALS, _candidate_sql("sg", "symbol", "1.5", "1.0", "0.1"), _walk_sql("symbol")]
_MONEY = ["entry_price", "exit_price", "pnl_r"]
_FACTS = ["symbol", "entry_time", "exit_time", "signal", "bars_held", "reason", "weekday", "hour"]


@query("trade_candidates", "H1", tidy_sql(S.with_ctes(*_CAND) + "SELECT * FROM cd", _MONEY, _FACTS)
       .replace("SELECT * FROM cd", "SELECT * REPLACE (CASE WHEN reason IS NOT NULL THEN exit_price END AS exit_price) FROM cd"))
def trade_candidates(spark, sf):
    return tidy(backtest.trade_candidates(_signal_bars(spark, sf), **_RULES_1W), [*_FACTS, *_MONEY])


@query("simulate_trades", "H1, A14", tidy_sql(S.with_ctes(*_TRADES) + "SELECT * FROM tr", _MONEY, _FACTS))
def simulate_trades(spark, sf):
    return tidy(_trades(spark, sf), [*_FACTS, *_MONEY])


@query("simulate_trades_short_blocks", "H1", tidy_sql(
    S.with_ctes(*_TRADES) + "SELECT * FROM tr", _MONEY, _FACTS))
def simulate_trades_short_blocks(spark, sf):
    """The same trades with the shortest blocks, so that most trades cross a border."""
    return tidy(backtest.simulate_trades(_signal_bars(spark, sf), block=12, **_RULES_1W), [*_FACTS, *_MONEY])


def _curve_ctes(series: str = "symbol") -> list[str]:
    return [f"""eq0 AS (SELECT *, sum(pnl_r) OVER (PARTITION BY {series} ORDER BY t ROWS UNBOUNDED PRECEDING) AS equity FROM tr)""",
            f"""eq AS (SELECT *, max(equity) OVER (PARTITION BY {series} ORDER BY t ROWS UNBOUNDED PRECEDING) AS peak FROM eq0)"""]


@query("equity_curve", "H4", tidy_sql(S.with_ctes(*_TRADES, *_curve_ctes())
       + "SELECT *, t AS i2, peak - equity AS drawdown FROM eq", ["equity", "peak", "drawdown"],
       ["symbol", "i2 AS i", "exit_time"]))
def equity_curve(spark, sf):
    return tidy(backtest.equity_curve(_trades(spark, sf)),
                ["symbol", "i", "exit_time", "equity", "peak", "drawdown"])


@query("equity_curve_zero_peak", "H4", tidy_sql(S.with_ctes(*_TRADES, *_curve_ctes())
       + "SELECT * EXCLUDE (peak), t AS i2, greatest(peak, 0) AS peak, equity - greatest(peak, 0) AS drawdown FROM eq",
       ["equity", "peak", "drawdown"], ["symbol", "i2 AS i", "exit_time"]))
def equity_curve_zero_peak(spark, sf):
    curve = backtest.equity_curve(_trades(spark, sf), peak_floor=0.0, block=64)
    return tidy(curve.withColumn("drawdown", -F.col("drawdown")),
                ["symbol", "i", "exit_time", "equity", "peak", "drawdown"])


_METRICS = ["win_rate", "total_r", "max_drawdown_r", "profit_factor", "net_profit_dollar", "final_capital",
            "sharpe_ratio", "sortino_ratio", "calmar_ratio"]


def _metric_sql(series: str) -> str:
    return f"""SELECT {series}, count(*) AS total_trades, 100.0 * count(*) FILTER (pnl_r > 0) / count(*) AS win_rate,
  sum(pnl_r) AS total_r, max(peak - equity) AS max_drawdown_r,
  CASE WHEN count(*) FILTER (pnl_r < 0) > 0 THEN coalesce(sum(pnl_r) FILTER (pnl_r > 0), 0) / -sum(pnl_r) FILTER (pnl_r < 0) END AS profit_factor,
  (count(*) FILTER (pnl_r < 0) = 0)::INT AS no_losses,
  100 * sum(pnl_r) AS net_profit_dollar, 10000 + 100 * sum(pnl_r) AS final_capital,
  CASE WHEN stddev_pop(pnl_r) > 0 THEN avg(pnl_r) / stddev_pop(pnl_r) ELSE 0 END AS sharpe_ratio,
  CASE WHEN stddev_pop(pnl_r) FILTER (pnl_r < 0) > 0 THEN avg(pnl_r) / stddev_pop(pnl_r) FILTER (pnl_r < 0) ELSE 0 END AS sortino_ratio,
  CASE WHEN max(peak - equity) > 0 THEN sum(pnl_r) / max(peak - equity) ELSE 0 END AS calmar_ratio
  FROM eq GROUP BY {series}"""


@query("backtest_metrics", "H2", tidy_sql(S.with_ctes(*_TRADES, *_curve_ctes()) + _metric_sql("symbol"),
       _METRICS, ["symbol", "total_trades", "no_losses"]))
def backtest_metrics(spark, sf):
    return tidy(backtest.backtest_metrics(_trades(spark, sf)),
                ["symbol", "total_trades", "no_losses", *_METRICS])


@query("rolling_sharpe", "H3", tidy_sql(S.with_ctes(*_TRADES) + """
SELECT *, t AS i2, CASE WHEN t >= 19 AND stddev_pop(pnl_r) OVER w > 0
  THEN avg(pnl_r) OVER w / stddev_pop(pnl_r) OVER w * sqrt(252) END AS rolling_sharpe
FROM tr WINDOW w AS (PARTITION BY symbol ORDER BY t ROWS 19 PRECEDING)""", ["rolling_sharpe"], ["symbol", "i2 AS i"]))
def rolling_sharpe(spark, sf):
    return tidy(backtest.rolling_sharpe(_trades(spark, sf), block=32), ["symbol", "i", "rolling_sharpe"])


_EVENTS = [*_TRADES, *_curve_ctes(), """isl AS (SELECT *, peak - equity AS dd,
   count(*) FILTER (peak = equity) OVER (PARTITION BY symbol ORDER BY t ROWS UNBOUNDED PRECEDING) AS g,
   max(t) OVER (PARTITION BY symbol) AS last_t FROM eq)""",
   """ev0 AS (SELECT symbol, min(t) AS start_idx, arg_min(t, (equity, t)) AS trough_idx, max(t) AS e, max(last_t) AS last_t,
   max(peak) - min(equity) AS magnitude FROM isl WHERE dd > 0 GROUP BY symbol, g)""",
   """ev AS (SELECT *, (e = last_t) AS ongoing, CASE WHEN e = last_t THEN last_t ELSE e + 1 END AS end_idx FROM ev0
   WHERE e < last_t OR trough_idx > start_idx)"""]


@query("drawdown_events", "H5", tidy_sql(S.with_ctes(*_EVENTS) + """
SELECT *, trough_idx - start_idx AS duration, end_idx - trough_idx AS recovery,
  CASE WHEN ongoing THEN last_t + 1 - start_idx ELSE end_idx - start_idx END AS total_bars, ongoing::INT AS og FROM ev""",
    ["magnitude"], ["symbol", "start_idx", "trough_idx", "end_idx", "duration", "recovery", "total_bars", "og AS ongoing"]))
def drawdown_events(spark, sf):
    curve = backtest.equity_curve(_trades(spark, sf))
    return tidy(backtest.drawdown_events(curve, block=64), [
        "symbol", "start_idx", "trough_idx", "end_idx", "magnitude", "duration", "recovery", "total_bars", "ongoing"])


@query("drawdown_summary", "H5", tidy_sql(S.with_ctes(*_EVENTS) + """
SELECT symbol, max(dd) AS max_drawdown, coalesce(avg(dd) FILTER (dd > 0), 0) AS avg_drawdown,
  (SELECT count(*) FROM ev WHERE ev.symbol = isl.symbol) AS n_events,
  coalesce((SELECT avg(end_idx - trough_idx) FROM ev WHERE ev.symbol = isl.symbol AND NOT ongoing AND end_idx > trough_idx), 0) AS avg_recovery
FROM isl GROUP BY symbol""", ["max_drawdown", "avg_drawdown", "avg_recovery"], ["symbol", "n_events"]))
def drawdown_summary(spark, sf):
    curve = stage(backtest.equity_curve(_trades(spark, sf)), "curve")
    events = backtest.drawdown_events(curve)
    return tidy(backtest.drawdown_summary(curve, events),
                ["symbol", "n_events", "max_drawdown", "avg_drawdown", "avg_recovery"])


_DRAWS = """dr AS (SELECT p.path, s.t AS step, s.n,
   (p.path * 73856093 + s.t * 19349663 + CAST(42 AS BIGINT) * 83492791) % 2147483647 AS h
   FROM (SELECT unnest(range(0, 1000)) AS path) p, (SELECT t, count(*) OVER () AS n FROM tr) s),
 d1 AS (SELECT * EXCLUDE (h), (h * h + h * 48271 + 11) % 2147483647 AS h FROM dr),
 d2 AS (SELECT * EXCLUDE (h), (h * h + h * 48271 + 11) % 2147483647 AS h FROM d1),
 cu AS (SELECT path, step, sum(pnl_r) OVER (PARTITION BY path ORDER BY step ROWS UNBOUNDED PRECEDING) AS equity
   FROM d2 JOIN tr ON tr.t = d2.h % d2.n)"""


@query("bootstrap_bands", "H6", tidy_sql(S.with_ctes(*_TRADES_1H, _DRAWS) + """
SELECT step, avg(equity) AS equity_mean, quantile_cont(equity, 0.025) AS lower_95, quantile_cont(equity, 0.16) AS lower_68,
  quantile_cont(equity, 0.84) AS upper_68, quantile_cont(equity, 0.975) AS upper_95 FROM cu GROUP BY step""",
    ["equity_mean", "lower_95", "lower_68", "upper_68", "upper_95"], ["step"]))
def bootstrap_bands(spark, sf):
    return tidy(backtest.bootstrap_bands(_trades_1h(spark, sf), block=64),
                ["step", "equity_mean", "lower_95", "lower_68", "upper_68", "upper_95"])


# Stored predictions of the prequential model; rows without one are neutral.
_SOURCES = """sg2 AS (SELECT 'labels' AS source, symbol, timestamp, i, n, open, high, low, close, atr_14, signal FROM sg
 UNION ALL SELECT 'model', sg.symbol, sg.timestamp, i, n, open, high, low, close, atr_14,
  CAST(sign(coalesce(prediction, 2) - 2) AS INT) FROM sg LEFT JOIN nb ON nb.symbol = sg.symbol AND nb.timestamp = sg.timestamp)"""


@query("eval_labels_vs_model", "H7, I4", tidy_sql(S.with_ctes(
    *_MR, *_nb_ctes(), _SIGNALS, _SOURCES, _candidate_sql("sg2", "source, symbol", "1.5", "1.0", "200.0"),
    _walk_sql("source, symbol"), *_curve_ctes("source, symbol")) + _metric_sql("source, symbol"),
    _METRICS, ["source", "symbol", "total_trades", "no_losses"]))
def eval_labels_vs_model(spark, sf):
    bars, rows = _signal_bars(spark, sf), _model_rows(spark, sf)
    predictions = models.prequential_bayes(rows, FEATURES, batch=100).select("symbol", "idx", "prediction").join(
        rows.select("symbol", "idx", "timestamp"), ["symbol", "idx"]).drop("idx")
    aligned = prep.align_predictions(bars, stage(predictions, "predictions"))
    model = aligned.withColumn("label", F.col("prediction") - prep.NEUTRAL).withColumn(
        "signal", label_to_signal("label")).select(*bars.columns)
    both = bars.withColumn("source", F.lit("labels")).unionByName(model.withColumn("source", F.lit("model")))
    keys = ("source", "symbol")
    trades = backtest.simulate_trades(both, keys=keys, **_RULES_1W)
    return tidy(backtest.backtest_metrics(trades, keys=keys),
                ["source", "symbol", "total_trades", "no_losses", *_METRICS])


# A registered rule that SQL can restate: busy weeks are followed upward, quiet ones downward.
_RULED = """sg4 AS (SELECT * EXCLUDE (signal), CASE WHEN volume > v THEN 1 WHEN 2 * volume < v THEN -1 ELSE 0 END AS signal
  FROM sg, (SELECT avg(volume) AS v FROM sg))"""


@query("evaluate_registered", "H7, A14, I21", tidy_sql(S.with_ctes(
    *S.LABELLED_1W, _SIGNALS, _RULED, _candidate_sql("sg4", "symbol", "1.5", "1.0", "200.0"), _walk_sql("symbol"),
    *_curve_ctes(), f"mt AS ({_metric_sql('symbol')})")
    + "SELECT a.symbol, coalesce(total_trades, 0) AS total_trades, coalesce(no_losses, 0) AS no_losses, "
    + ", ".join(f"CASE WHEN total_trades IS NULL THEN {10000 if m == 'final_capital' else 0} ELSE {m} END AS {m}" for m in _METRICS)
    + " FROM (SELECT DISTINCT symbol FROM sg) a LEFT JOIN mt USING (symbol)",
    _METRICS, ["symbol", "total_trades", "no_losses"]))
def evaluate_registered(spark, sf):
    bars = backtest.indexed_bars(labelled_1w(spark, sf, staged=False).select(
        "symbol", "timestamp", "month", "open", "high", "low", "close", "volume", "atr_14"))
    mean = bars.agg(F.avg("volume")).first()[0]
    rule = SQLTransformer(statement=f"SELECT *, CASE WHEN volume > {mean!r}D THEN 4.0D WHEN 2 * volume < {mean!r}D THEN 0.0D "
                                    "ELSE 2.0D END AS prediction FROM __THIS__")
    table, folder = scratch_path(spark, "registry"), scratch_path(spark, "evaluation")
    for backend, score in (("rule", 0.4), ("other", 0.2)):
        path = scratch_path(spark, "model")
        Pipeline(stages=[rule]).fit(bars).write().save(path)
        registry.append(registry.entry(
            spark, backend=backend, symbol="ALL", tf="1W", label="label_10", metrics={"best_cv_f1_macro": score},
            registered_at=1.0, feature_columns=["volume"], artifact_path=path), table)
    found = evaluation.evaluate_registered(
        bars, registry.read(spark, table), folder, symbol="ALL", tf="1W", label="label_10", **_RULES_1W)
    return tidy(found, ["symbol", "total_trades", "no_losses", *_METRICS])


_SETTINGS = [(1.5, 1.0, 50.0), (2.0, 1.0, 100.0), (3.0, 1.5, 200.0), (1.0, 0.5, 300.0)]
_SWEEP = "sg3 AS (" + " UNION ALL ".join(
    f"SELECT *, {i} AS param_id, {tp} AS ptp, {sl} AS psl, {fee} AS pfee FROM sg"
    for i, (tp, sl, fee) in enumerate(_SETTINGS)) + ")"


@query("backtest_sweep", "H12", tidy_sql(S.with_ctes(
    *S.LABELLED_1W, _SIGNALS, _SWEEP, _candidate_sql("sg3", "symbol, param_id", "s.ptp", "s.psl", "s.pfee"),
    _walk_sql("symbol, param_id"), *_curve_ctes("symbol, param_id"), f"mt AS ({_metric_sql('symbol, param_id')})")
    + "SELECT a.symbol, a.param_id, coalesce(total_trades, 0) AS total_trades, coalesce(no_losses, 0) AS no_losses, "
    + ", ".join(f"CASE WHEN total_trades IS NULL THEN {10000 if m == 'final_capital' else 0} ELSE {m} END AS {m}" for m in _METRICS)
    + " FROM (SELECT DISTINCT symbol, param_id FROM sg3) a LEFT JOIN mt USING (symbol, param_id)",
    _METRICS, ["symbol", "param_id", "total_trades", "no_losses"]))
def backtest_sweep(spark, sf):
    return tidy(backtest.sweep(_signal_bars(spark, sf), _SETTINGS),
                ["symbol", "param_id", "total_trades", "no_losses", *_METRICS])


# ---------------------------------------------------------------- report tables
_HEAT = [f"{d}_mean" for d in reports.DAYS]


@query("pnl_heatmap", "H8", tidy_sql(S.with_ctes(*_TRADES_1H) + "SELECT h.hour, " + ", ".join(
    f"coalesce(avg(pnl_r) FILTER (weekday = {k}), 0) AS {d}_mean, count(*) FILTER (weekday = {k}) AS {d}_count"
    for k, d in enumerate(reports.DAYS))
    + " FROM (SELECT unnest(range(0, 24)) AS hour) h LEFT JOIN tr USING (hour) GROUP BY 1",
    _HEAT, ["hour", *[f"{d}_count" for d in reports.DAYS]]))
def pnl_heatmap(spark, sf):
    return tidy(reports.pnl_heatmap(_trades_1h(spark, sf)))


def _register_win_rate(by: str) -> None:
    @query(f"win_rate_by_{by}", "H9", tidy_sql(S.with_ctes(*_TRADES_1H) + f"""
SELECT {by}, count(*) AS total, count(*) FILTER (pnl_r > 0) AS wins,
  100.0 * count(*) FILTER (pnl_r > 0) / count(*) AS win_rate FROM tr GROUP BY 1""", ["win_rate"], [by, "total", "wins"]))
    def run(spark, sf):
        return tidy(reports.win_rate(_trades_1h(spark, sf), by))


for _by in ("hour", "weekday"):
    _register_win_rate(_by)

_ATTR = {"signal": "signal", "weekday": "CAST(weekday AS VARCHAR)", "reason": "reason",
         "session": "CASE WHEN hour BETWEEN 8 AND 15 THEN 'London' WHEN hour BETWEEN 16 AND 20 THEN 'New York' ELSE 'Asia' END"}


@query("pnl_attribution", "H10", tidy_sql(S.with_ctes(*_TRADES_1H) + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {v} AS value, sum(pnl_r) AS pnl_r, count(*) AS trades FROM tr GROUP BY 2"
    for d, v in _ATTR.items()), ["pnl_r"], ["dimension", "value", "trades"]))
def pnl_attribution(spark, sf):
    return tidy(reports.pnl_attribution(_trades_1h(spark, sf)))


def _hist_sql(kind: str, col: str, bins: int) -> str:
    return f"""SELECT '{kind}' AS histogram, CAST(CASE WHEN hi = lo THEN 0
  ELSE least(floor(({col} - lo) / ((hi - lo) / {bins}.0)), {bins - 1}) END AS BIGINT)::VARCHAR AS bin, count(*) AS n
  FROM tr, (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM tr) GROUP BY 2"""


@query("trade_histograms", "H11", S.with_ctes(*_TRADES_1H) + " UNION ALL ".join([
    _hist_sql("pnl", "pnl_r", 30), _hist_sql("duration", "bars_held", 20),
    "SELECT 'hour', CAST(hour AS VARCHAR), count(*) FROM tr GROUP BY 2",
    "SELECT 'reason', reason, count(*) FROM tr GROUP BY 2"]))
def trade_histograms(spark, sf):
    return reports.trade_histograms(stage(_trades_1h(spark, sf), "trades"))
