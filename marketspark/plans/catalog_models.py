"""Queries over dataset preparation, folds, models and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.functions.scans import row_index, short
from marketspark.operators import drift, folds, models, prep, registry, scoring
from marketspark.operators.indicators import atr
from marketspark.operators.labels import add_labels
from marketspark.operators.select import numeric_feature_columns
from marketspark.plans import sqlparts as S
from marketspark.plans.common import bars_1d, bars_4h, labelled_1w, ranged_1w
from marketspark.plans.registry import query, tidy, tidy_sql
from marketspark.session import scratch_path, stage

#: What ``numeric_feature_columns`` leaves of the weekly table with the bar's body: no price, no tick count, no label.
FEATURES = ["volume", "atr_14", "body"]
KEY = ["symbol", "timestamp"]


def _indexed(df, staged=True):
    rows = row_index(df, ("symbol",), "timestamp")
    return stage(rows, "rows") if staged else rows


def _complete(bars, staged=True):
    """Rows with all features and a label, at single precision, with their position."""
    bars = bars.drop("idx", "n").withColumn("body", F.col("close") - F.col("open"))
    return _indexed(
        prep.tabular(bars, numeric_feature_columns(bars), "label_10", keep=["symbol", "timestamp", "month"]), staged)


def _model_rows(spark, sf):
    """Complete rows of the weekly table with position, features and ``y`` in 0..4."""
    return _complete(labelled_1w(spark, sf, staged=False))


_ROWS = """mr AS (SELECT symbol, timestamp, month, CAST(CAST(volume AS FLOAT) AS DOUBLE) AS volume,
  CAST(CAST(close - open AS FLOAT) AS DOUBLE) AS body, CAST(CAST(atr_14 AS FLOAT) AS DOUBLE) AS atr_14,
  CAST(label_10 + 2 AS INT) AS y, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS idx,
  count(*) OVER (PARTITION BY symbol) AS n
  FROM {src} WHERE label_10 IS NOT NULL AND atr_14 IS NOT NULL AND volume IS NOT NULL)"""
_MR = [*S.LABELLED_1W, _ROWS.format(src="lab")]


@query("tabular_prep", "I1, B4, B5, B13", tidy_sql(
    S.with_ctes(*_MR) + "SELECT * FROM mr", FEATURES, [*KEY, "y"], 3))
def tabular_prep(spark, sf):
    return tidy(_model_rows(spark, sf), [*KEY, *FEATURES, "y"], 3)


@query("lag_features", "I2, B10, B14", tidy_sql(S.with_ctes(*_MR) + "SELECT symbol AS unique_id, timestamp AS ds, CAST(y AS DOUBLE) AS y, atr_14, idx, "
       + ", ".join(f"CAST(lag(y, {k}) OVER w AS DOUBLE) AS y_lag_{k}" for k in range(1, 6))
       + " FROM mr WINDOW w AS (PARTITION BY symbol ORDER BY timestamp) QUALIFY idx >= 5",
       ["y", "atr_14", *[f"y_lag_{k}" for k in range(1, 6)]], ["unique_id", "ds"], 3))
def lag_features(spark, sf):
    rows = _model_rows(spark, sf).withColumn("label", F.col("y") - 2)
    df = prep.lag_features(rows.drop("y"), "label", ["atr_14"], block=100)
    return tidy(df, ["unique_id", "ds", "y", "atr_14", *[f"y_lag_{k}" for k in range(1, 6)]], 3)


@query("sequence_windows", "I5", tidy_sql(S.with_ctes(*_MR) + """
SELECT a.symbol, a.timestamp, any_value(a.y) AS y, count(*) AS length, min(b.idx) AS first_idx, sum(b.atr_14) AS sum_atr,
  arg_min(b.volume, b.idx) AS first_volume, arg_max(b.volume, b.idx) AS last_volume
FROM mr a JOIN mr b ON b.symbol = a.symbol AND b.idx BETWEEN a.idx - 8 AND a.idx - 1 WHERE a.idx >= 8 GROUP BY 1, 2""",
    ["sum_atr", "first_volume", "last_volume"], [*KEY, "y", "length"], 3))
def sequence_windows(spark, sf):
    df = prep.sequence_windows(_model_rows(spark, sf), FEATURES, "y", 8, block=64)
    at = F.col("window")
    total = F.aggregate(F.transform("window", lambda p: p[FEATURES.index("atr_14")].cast("double")), F.lit(0.0), lambda a, x: a + x)
    return tidy(df.select(
        *KEY, "y", F.size("window").alias("length"), total.alias("sum_atr"),
        at[0][0].cast("double").alias("first_volume"),
        F.element_at(at, -1)[0].cast("double").alias("last_volume")), None, 3)


@query("align_predictions", "I4", S.with_ctes(*_MR) + """
SELECT b.symbol, b.timestamp, coalesce(p.y, 2) AS prediction FROM b LEFT JOIN (SELECT * FROM mr WHERE idx % 3 = 0) p
  USING (symbol, timestamp)""")
def align_predictions(spark, sf):
    rows = stage(labelled_1w(spark, sf, staged=False), "labelled")
    known = _complete(rows)
    preds = known.where(F.col("idx") % 3 == 0).select(*KEY, F.col("y").alias("prediction"))
    return prep.align_predictions(rows.select(*KEY), preds)


# ---------------------------------------------------------------- folds
_FOLD_BASE = [S.BARS_1D, """r AS (SELECT symbol, timestamp, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i,
  count(*) OVER (PARTITION BY symbol) AS n FROM b)""", "k AS (SELECT unnest(range(0, 5)) AS fold)"]


def _fold_sql(bounds: str) -> str:
    return S.with_ctes(*_FOLD_BASE, f"m AS (SELECT symbol, timestamp, i, fold, {bounds} FROM r, k)") + """
SELECT symbol, timestamp, fold, CASE WHEN i >= lo AND i < hi THEN 'test' ELSE 'train' END AS role FROM m
WHERE (i >= lo AND i < hi) OR (i >= tlo AND i < thi) OR i >= aft"""


_FOLD_SQL = {
    "purged_kfold": """n // 5 * fold AS lo, CASE WHEN fold = 4 THEN n ELSE n // 5 * (fold + 1) END AS hi, 0 AS tlo,
  greatest(n // 5 * fold - 10, 0) AS thi,
  least(n, CASE WHEN fold = 4 THEN n ELSE n // 5 * (fold + 1) END + CAST(floor(n * 0.01) AS BIGINT)) AS aft""",
    "purged_timeseries": """n - (5 - fold) * (n // 6) AS lo,
  least(n, n - (4 - fold) * (n // 6) + CAST(floor(n * 0.01) AS BIGINT)) AS hi, 0 AS tlo,
  n - (5 - fold) * (n // 6) - 10 AS thi, n AS aft""",
    "timeseries": """n - (5 - fold) * (n // 6) AS lo, n - (4 - fold) * (n // 6) AS hi, 0 AS tlo,
  n - (5 - fold) * (n // 6) AS thi, n AS aft""",
    "rolling_origin": """n - (5 - fold) * greatest(1, n // 50) AS lo, n - (4 - fold) * greatest(1, n // 50) AS hi, 0 AS tlo,
  n - (5 - fold) * greatest(1, n // 50) AS thi, n AS aft""",
}
_SURVEY = {"purged_kfold": "I6", "purged_timeseries": "I7", "timeseries": "I9", "rolling_origin": "I10"}


def _register_folds(method: str) -> None:
    @query(f"cv_{method}", _SURVEY[method], _fold_sql(_FOLD_SQL[method]))
    def run(spark, sf):
        return folds.assign_folds(_indexed(bars_1d(spark, sf, staged=True)), method).select(
            *KEY, "fold", "role")


for _method in _FOLD_SQL:
    _register_folds(_method)


def _walk_forward_sql(window: int) -> str:
    start = window or 1000
    lo = f"greatest(p - {window}, 0)" if window else "0"
    return S.with_ctes(_FOLD_BASE[0], _FOLD_BASE[1], f"""
p AS (SELECT unnest(range({start}, (SELECT max(n) - 10 FROM r), 500)) AS p),
 q AS (SELECT p, {lo} AS tlo, p - 10 AS thi, p + CAST(floor(n * 0.01) AS BIGINT) AS lo,
   least(n, p + CAST(floor(n * 0.01) AS BIGINT) + 500) AS hi FROM p, (SELECT max(n) AS n FROM r)),
 f AS (SELECT *, row_number() OVER (ORDER BY p) - 1 AS fold FROM q WHERE thi > tlo AND hi > lo)""") + """
SELECT symbol, timestamp, fold, CASE WHEN i >= lo AND i < hi THEN 'test' ELSE 'train' END AS role
FROM r, f WHERE (i >= lo AND i < hi) OR (i >= tlo AND i < thi)"""


@query("cv_walk_forward", "I8", _walk_forward_sql(0))
def cv_walk_forward(spark, sf):
    return folds.assign_folds(_indexed(bars_1d(spark, sf, staged=True)), "walk_forward").select(
        *KEY, "fold", "role")


@query("cv_walk_forward_rolling", "I8", _walk_forward_sql(600))
def cv_walk_forward_rolling(spark, sf):
    return folds.assign_folds(
        _indexed(bars_1d(spark, sf, staged=True)), "walk_forward", train_window=600
    ).select(*KEY, "fold", "role")


# ---------------------------------------------------------------- selection and scores
@query("variance_filter", "I11", tidy_sql(S.with_ctes(*_MR, "v AS (SELECT *, 1.0 AS constant FROM mr)")
       + " UNION ALL ".join(f"SELECT '{f}' AS feature, var_pop({f}) AS variance, (var_pop({f}) > 0)::INT AS keep FROM v"
                            for f in [*FEATURES, "constant"]), ["variance"], ["feature", "keep"], 4))
def variance_filter(spark, sf):
    rows = _model_rows(spark, sf).withColumn("constant", F.lit(1.0))
    return tidy(scoring.feature_variance(rows, [*FEATURES, "constant"]), None, 4)


@query("anova_f_topk", "I12", tidy_sql(S.with_ctes(*_MR, "a AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, y, {f} AS x FROM mr" for f in FEATURES) + """),
 g AS (SELECT feature, y, count(*) AS n, avg(x) AS m FROM a GROUP BY 1, 2),
 t AS (SELECT feature, avg(x) AS gm, count(*) AS total, count(DISTINCT y) AS k FROM a GROUP BY 1)""") + """
SELECT feature, (SELECT sum(n * (m - gm) ** 2) FROM g WHERE g.feature = t.feature) / (k - 1)
  / ((SELECT sum((x - m) ** 2) FROM a JOIN g USING (feature, y) WHERE a.feature = t.feature) / (total - k)) AS f_score
FROM t ORDER BY f_score DESC LIMIT 2""", ["f_score"], ["feature"], 4))
def anova_f_topk(spark, sf):
    return tidy(scoring.top_features(_model_rows(spark, sf), FEATURES, 2), None, 4)


# Persistence predictor: the class seen when its horizon had passed.
_PRED = "pd AS (SELECT symbol, timestamp, y, lag(y, 10) OVER (PARTITION BY symbol ORDER BY timestamp) AS prediction FROM mr)"


def _f1_ctes(src: str, by: str = "", name: str = "f1") -> list[str]:
    """Macro F1 of ``src`` per group ``by`` (comma separated, may be empty)."""
    g = by + ", " if by else ""
    on = " AND ".join(["TRUE", *[f"s.{c.strip()} = c.{c.strip()}" for c in by.split(",") if c.strip()]])
    cg = ", ".join(f"c.{c.strip()}" for c in by.split(",") if c.strip())
    cg = cg + ", " if cg else ""
    return [
        f"{name}_c AS (SELECT {g}y AS cls FROM {src} UNION SELECT {g}prediction FROM {src})",
        f"""{name}_k AS (SELECT {cg}c.cls, count(*) FILTER (s.y = c.cls AND s.prediction = c.cls) AS tp,
  count(*) FILTER (s.y = c.cls OR s.prediction = c.cls) AS either, count(*) FILTER (s.y = c.cls) AS pos,
  count(*) FILTER (s.prediction = c.cls) AS said FROM {name}_c c JOIN {src} s ON {on} GROUP BY {cg}c.cls)""",
        f"""{name} AS (SELECT {g}avg(CASE WHEN tp = 0 THEN 0 ELSE 2 * (tp / pos) * (tp / said) / (tp / pos + tp / said) END) AS macro_f1,
  count(*) AS classes FROM {name}_k {'GROUP BY ' + by if by else ''})""",
    ]


def _persistence(spark, sf):
    rows = _model_rows(spark, sf)
    df = prep.lagged(rows, {"prediction": ("y", 10)}, block=128)
    return df.where(F.col("prediction").isNotNull())


_PD = [*_MR, _PRED, "pp AS (SELECT * FROM pd WHERE prediction IS NOT NULL)"]


@query("macro_f1", "I13", tidy_sql(
    S.with_ctes(*_PD, *_f1_ctes("pp", "symbol")) + "SELECT * FROM f1", ["macro_f1"], ["symbol", "classes"]))
def macro_f1(spark, sf):
    return tidy(scoring.macro_f1(_persistence(spark, sf), by=("symbol",)))


@query("confusion_matrix", "I14", S.with_ctes(*_PD) + """
SELECT y, prediction, count(*) AS n FROM pp GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return scoring.confusion_counts(_persistence(spark, sf))


@query("label_pred_distribution", "I14", S.with_ctes(*_PD) + """
SELECT 'y' AS kind, y AS value, count(*) AS n FROM pp GROUP BY 2
UNION ALL SELECT 'prediction', prediction, count(*) FROM pp GROUP BY 2""")
def label_pred_distribution(spark, sf):
    return scoring.label_distribution(_persistence(spark, sf))


_SN = [*_MR, """sn AS (SELECT t.symbol, t.fold, t.y, coalesce(p.y, q.y, 2) AS prediction FROM
  (SELECT symbol, y, idx, fold, n - (5 - fold) * (n // 6) AS lo, n - (4 - fold) * (n // 6) AS hi
   FROM mr, (SELECT unnest(range(0, 5)) AS fold)) t
  LEFT JOIN mr p ON p.symbol = t.symbol AND p.idx = t.lo - 24 + (t.idx - t.lo) % 24
  LEFT JOIN mr q ON q.symbol = t.symbol AND q.idx = t.lo - 1 WHERE t.idx >= t.lo AND t.idx < t.hi)""",
       "st AS (SELECT symbol, count(*) AS scored FROM sn GROUP BY symbol)"]


@query("seasonal_naive_cv", "I18", tidy_sql(S.with_ctes(*_SN, *_f1_ctes("sn", "symbol, fold")) + """
SELECT symbol, avg(macro_f1) AS cv_f1_macro, count(*) AS folds, any_value(scored) AS scored
FROM f1 JOIN st USING (symbol) GROUP BY symbol""", ["cv_f1_macro"], ["symbol", "folds", "scored"]))
def seasonal_naive_cv(spark, sf):
    return tidy(models.mean_fold_f1(models.seasonal_naive_predictions(_model_rows(spark, sf))))


def _nb_ctes() -> list[str]:
    """``nb``: the prequential Bayes prediction of every row after the first batch of 100."""
    moments = ", ".join(f"avg({f}) AS m_{f}, avg({f} * {f}) AS q_{f}" for f in FEATURES)
    ll = " ".join(
        f"- 0.5 * (ln(greatest(q_{f} - m_{f} * m_{f}, 1e-6)) + (r.{f} - m_{f}) ** 2 / greatest(q_{f} - m_{f} * m_{f}, 1e-6))"
        for f in FEATURES)
    return ["nbt AS (SELECT DISTINCT symbol, idx // 100 AS batch FROM mr)", f"""
nst AS (SELECT nbt.symbol, nbt.batch, mr.y AS c, count(*) AS cn, {moments} FROM nbt JOIN mr ON mr.symbol = nbt.symbol
   AND mr.idx < nbt.batch * 100 GROUP BY 1, 2, 3 HAVING count(*) > 1),
 nsc AS (SELECT r.symbol, r.timestamp, r.idx, r.y, nst.c, ln(cn / sum(cn) OVER (PARTITION BY r.symbol, r.idx)) {ll} AS ll
   FROM mr r JOIN nst ON nst.symbol = r.symbol AND nst.batch = r.idx // 100)""", """
nb AS (SELECT symbol, timestamp, idx // 100 AS batch, idx, y, c AS prediction FROM nsc
QUALIFY row_number() OVER (PARTITION BY symbol, idx ORDER BY ll DESC, c) = 1)"""]


@query("prequential_nb", "I17", S.with_ctes(*_MR, *_nb_ctes()) + "SELECT * EXCLUDE (timestamp) FROM nb")
def prequential_nb(spark, sf):
    bars = labelled_1w(spark, sf, staged=False)
    # Short series are read once, in the order of their windows; others are read several times.
    return models.prequential_bayes(_complete(bars, staged=not short(bars)), FEATURES, batch=100)


# ---------------------------------------------------------------- trained models (no SQL form)
@query("train_online", "I16", S.with_ctes(*_MR) + """
SELECT symbol, count(*) AS scored, max(idx // 50) AS last_batch, 1 AS sound FROM mr WHERE idx >= 50 GROUP BY symbol""")
def train_online(spark, sf):
    # The model is another family than the original; which rows it scores is the protocol's.
    preds = stage(models.online_predictions(_model_rows(spark, sf), FEATURES, batch=50), "predictions")
    score = scoring.macro_f1(preds, by=("symbol",)).select("symbol", F.col("macro_f1").between(0, 1).alias("ok"))
    return preds.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("scored"), F.max("batch").alias("last_batch"),
        F.min(F.col("prediction").between(0, 4)).alias("valid"),
    ).join(score, "symbol").select("symbol", "scored", "last_batch", (F.col("valid") & F.col("ok")).cast("int").alias("sound"))


def _tree_rows(spark, sf):
    rows = _model_rows(spark, sf).withColumn("label", F.col("y") - 2)
    # Lags start at the label horizon, so no lag knows a later price than the row itself.
    lags = prep.lag_features(rows.drop("y"), "label", FEATURES, min_lag=10)
    return stage(lags, "lags"), [*FEATURES, *[f"y_lag_{k}" for k in range(10, 15)]]


def _facts(spark, backend, metrics):
    """What SQL can state of a trained model: rows scored, folds and trials, and that each score is a share."""
    facts = [(backend, k, int(0 <= v <= 1) if "f1" in k else int(v)) for k, v in metrics.items()
             if "f1" in k or k in ("cv_rows", "train_rows", "holdout_rows", "folds", "trials")]
    return spark.createDataFrame(facts, "backend string, metric string, value long")


@query("train_tree", "I15", S.with_ctes(*_MR) + """
SELECT 'tree' AS backend, 'cv_rows' AS metric, count(*) AS value FROM mr WHERE idx >= 14 AND idx >= n - 5 * greatest(1, n // 50)
UNION ALL SELECT 'tree', 'train_rows', count(*) FROM mr WHERE idx >= 14
UNION ALL SELECT 'tree', unnest(['folds', 'trials', 'best_cv_f1_macro', 'train_f1_macro']), unnest([5, 30, 1, 1])""")
def train_tree(spark, sf):
    rows, features = _tree_rows(spark, sf)
    _, metrics = models.train_tree(rows, features)
    return _facts(spark, "tree", metrics)


@query("train_sequence_mlp", "I19", S.with_ctes(
    *_MR, "sw AS (SELECT symbol, max(n) - 8 AS m FROM mr GROUP BY symbol HAVING max(n) > 8)",
    """te AS (SELECT m, m - (m // 6) * (5 - i) AS lo, least(m, m - (m // 6) * (5 - i) + m // 6 + CAST(floor(m * CAST(0.01 AS DOUBLE)) AS BIGINT)) AS hi
  FROM sw, range(5) AS f(i))""") + """
SELECT 'sequence' AS backend, 'cv_rows' AS metric, CAST(sum(hi - lo) AS BIGINT) AS value FROM te
UNION ALL SELECT 'sequence', 'holdout_rows', CAST(sum(m - floor(m * CAST(0.9 AS DOUBLE))) AS BIGINT) FROM sw
UNION ALL SELECT 'sequence', unnest(['folds', 'best_cv_f1_macro', 'holdout_f1_macro']), unnest([5, 1, 1])""")
def train_sequence_mlp(spark, sf):
    _, metrics = models.train_sequence(_model_rows(spark, sf), FEATURES, top=2)
    return _facts(spark, "sequence", metrics)


@query("batch_score", "I3, A13, I21", S.with_ctes(*_MR) + "SELECT symbol, timestamp, y, 1 AS in_range FROM mr")
def batch_score(spark, sf):
    rows = models.with_classes(_model_rows(spark, sf))
    split = F.col("idx") < F.floor(F.col("n") * 0.8)
    table = scratch_path(spark, "registry")

    def train(depth):
        model = models.tree_pipeline(FEATURES, {"numTrees": 10, "maxDepth": depth}, 42).fit(rows.where(split))
        path = scratch_path(spark, "model")
        model.write().save(path)
        held = model.transform(rows.where(~split)).withColumn("prediction", F.col("prediction").cast("int"))
        return path, scoring.macro_f1(held).first()["macro_f1"]

    for trained, (path, score) in enumerate(models._side_by_side(train, (2, 5), rows.count())):
        registry.append(registry.entry(
            spark, backend="tree", symbol="ALL", tf="1W", label="label_10", metrics={"best_cv_f1_macro": score},
            registered_at=float(trained), feature_columns=FEATURES, artifact_path=path), table)
    stored = registry.list_models(registry.read(spark, table), symbol="ALL", tf="1W", label="label_10")
    best = registry.best_models(stored).first()
    out = models.score_to_table(best, rows, scratch_path(spark, "predictions"), keep=[*KEY, "y"])
    return out.select(*KEY, "y", F.col("prediction").between(-2, 2).cast("int").alias("in_range"))


@query("backend_comparison", "I20", tidy_sql(S.with_ctes(
    *_SN, *_f1_ctes("sn", "symbol, fold"), *_nb_ctes(), *_f1_ctes("nb", "", "f2")) + """
SELECT 'stats' AS backend, 'ok' AS status, (SELECT avg(m) FROM (SELECT avg(macro_f1) AS m FROM f1 GROUP BY symbol)) AS score, NULL AS error
UNION ALL SELECT 'bayes', 'ok', (SELECT macro_f1 FROM f2), NULL
UNION ALL SELECT 'sgd', 'ok', NULL, NULL
UNION ALL SELECT 'unknown', 'error', NULL, 'ValueError: backend without a trainer'""", ["score"], ["backend", "status", "error"]))
def backend_comparison(spark, sf):
    rows = _model_rows(spark, sf)

    def naive():
        per_symbol = models.mean_fold_f1(models.seasonal_naive_predictions(rows))
        return {"best_cv_f1_macro": per_symbol.agg(F.avg("cv_f1_macro")).first()[0]}

    def bayes():
        return {"best_cv_f1_macro": scoring.macro_f1(
            models.prequential_bayes(rows, FEATURES, batch=100)).first()["macro_f1"]}

    def online():
        return {"best_cv_f1_macro": scoring.macro_f1(
            models.online_predictions(rows, FEATURES, batch=100)).first()["macro_f1"]}

    def broken():
        raise ValueError("backend without a trainer")

    table = models.compare_backends(spark, {"stats": naive, "bayes": bayes, "sgd": online, "unknown": broken})
    # The online model is another family than the original: its score is its own.
    closed = F.when(F.col("backend").isin("stats", "bayes"), F.col("best_cv_f1_macro"))
    return tidy(table.select("backend", "status", closed.alias("score"), "error"))


# ---------------------------------------------------------------- registry
_LAB4 = [S.BARS_4H, S.numbered(), S.atr_cte(),
         "ba AS (SELECT x.*, atr_s.y AS atr_14 FROM x LEFT JOIN atr_s USING (symbol, month, i))",
         S.labels_cte("ba"), _ROWS.format(src="lab")]
_LAGS = (10, 15, 20, 24)
_BACK = "bk AS (" + " UNION ALL ".join(
    f"SELECT symbol, 'lag_{k}' AS backend, {k} AS k, y, lag(y, {k}) OVER (PARTITION BY symbol ORDER BY timestamp) AS prediction FROM mr"
    for k in _LAGS) + "), bp AS (SELECT * FROM bk WHERE prediction IS NOT NULL)"
_REG = [*_LAB4, _BACK, *_f1_ctes("bp", "symbol, backend"), """
ac AS (SELECT symbol, backend, max(k) AS k, avg((y = prediction)::INT) AS accuracy FROM bp GROUP BY 1, 2),
 rg0 AS (SELECT symbol, backend, CAST(k AS DOUBLE) AS registered_at, macro_f1, accuracy FROM f1 JOIN ac USING (symbol, backend))"""]


def _registry_table(spark, sf):
    """One entry per symbol and persistence lag, scored on the four-hour bars."""
    rows = _complete(add_labels(atr(bars_4h(spark, sf))))
    lagged = prep.lagged(rows, {f"lag_{k}": ("y", k) for k in _LAGS}, block=64)
    long = lagged.unpivot(["symbol", "y"], [f"lag_{k}" for k in _LAGS], "backend", "prediction").where(
        F.col("prediction").isNotNull())
    long = stage(long, "predictions")
    by = ("symbol", "backend")
    hits = long.groupBy(*by).agg(F.avg((F.col("y") == F.col("prediction")).cast("int")).alias("accuracy"))
    return scoring.macro_f1(long, by=by).join(hits, list(by)).select(
        "backend", "symbol", F.lit("4H").alias("tf"), F.lit("label_10").alias("label"),
        F.substring("backend", 5, 9).cast("double").alias("registered_at"),
        F.create_map(F.lit("best_cv_f1_macro"), F.round("macro_f1", 6), F.lit("accuracy"), F.round("accuracy", 6)).alias("metrics"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("feature_columns"), F.lit("").alias("artifact_path"))


@query("model_leaderboard", "I21", tidy_sql(S.with_ctes(*_REG) + """
SELECT symbol, backend, macro_f1 AS score, row_number() OVER (PARTITION BY symbol ORDER BY round(macro_f1, 6) DESC, registered_at) AS rank
FROM rg0""", ["score"], ["symbol", "backend", "rank"]))
def model_leaderboard(spark, sf):
    return tidy(registry.leaderboard(_registry_table(spark, sf)), ["symbol", "backend", "score", "rank"])


@query("model_metrics_long", "I23", tidy_sql(S.with_ctes(*_REG) + """
SELECT symbol, backend, 'best_cv_f1_macro' AS metric, macro_f1 AS value FROM rg0
UNION ALL SELECT symbol, backend, 'accuracy', accuracy FROM rg0""", ["value"], ["symbol", "backend", "metric"]))
def model_metrics_long(spark, sf):
    return tidy(registry.metrics_long(_registry_table(spark, sf)), ["symbol", "backend", "metric", "value"])


@query("run_history", "I22", tidy_sql(S.with_ctes(*_REG) + """
SELECT backend, symbol, macro_f1 AS f1, accuracy, row_number() OVER (PARTITION BY backend ORDER BY registered_at, symbol) - 1 AS run_index FROM rg0""",
    ["f1", "accuracy"], ["backend", "run_index"]))
def run_history(spark, sf):
    entries = _registry_table(spark, sf)
    # A run log as the trainers write it: one JSON object per line; runs of one time go by symbol.
    lines = entries.select(F.to_json(F.struct(
        F.col("registered_at").alias("ts"), "backend", "symbol",
        F.col("metrics")["best_cv_f1_macro"].alias("f1"), F.col("metrics")["accuracy"].alias("accuracy"),
    )).alias("value"))
    log = registry.parse_run_log(lines, ["f1", "accuracy"], names=("symbol",))
    return tidy(registry.run_history(log, ["f1", "accuracy"], ties=("symbol",)), ["backend", "run_index", "f1", "accuracy"])


# ---------------------------------------------------------------- drift
_DF = ["close", "volume", "tick_count", "atr_14"]
SPLIT = "TIMESTAMP '1998-07-01'"
_LONGREF = "lr AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, timestamp < {SPLIT} AS ref FROM ba WHERE {f} IS NOT NULL" for f in _DF) + ")"
_KS = """ks AS (SELECT feature, max(abs(fr - fl)) AS ks_stat, any_value(nr) AS n_ref, any_value(nl) AS n_live FROM (
  SELECT feature, v, count(*) FILTER (ref) OVER w / nr AS fr, count(*) FILTER (NOT ref) OVER w / nl AS fl, nr, nl
  FROM (SELECT *, count(*) FILTER (ref) OVER (PARTITION BY feature) AS nr,
    count(*) FILTER (NOT ref) OVER (PARTITION BY feature) AS nl FROM lr)
  WINDOW w AS (PARTITION BY feature ORDER BY v RANGE UNBOUNDED PRECEDING)) GROUP BY feature)"""
_KSP = """kp AS (SELECT *, CASE WHEN z < 0.04 THEN 1.0 ELSE least(greatest(2 * (SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)
   * exp(-2.0 * z * k * k)) FROM (SELECT unnest(range(1, 101)) AS k)), 0), 1) END AS ks_p
  FROM (SELECT *, ks_stat * ks_stat * (n_ref * n_live / (n_ref + n_live)) AS z FROM ks))"""
_PSI = ["""ed AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM lr GROUP BY 1)""",
        """bn AS (SELECT feature, len(list_filter(e, lambda x: x <= v)) AS bin, ref FROM lr JOIN ed USING (feature))""",
        """gr AS (SELECT f.feature, b.bin, (SELECT count(*) FROM bn WHERE bn.feature = f.feature AND bn.bin = b.bin AND ref) AS cr,
  (SELECT count(*) FROM bn WHERE bn.feature = f.feature AND bn.bin = b.bin AND NOT ref) AS cl
  FROM (SELECT DISTINCT feature FROM lr) f, (SELECT unnest(range(0, 10)) AS bin) b)""",
        """ps AS (SELECT feature, greatest(sum((q - p) * ln(q / p + 1e-6)), 0) AS psi FROM (
  SELECT feature, (cr + 1e-6) / (sum(cr) OVER (PARTITION BY feature) + 1e-5) AS p,
    (cl + 1e-6) / (sum(cl) OVER (PARTITION BY feature) + 1e-5) AS q FROM gr) GROUP BY feature)"""]


def _drift_sides(spark, sf):
    rows = stage(ranged_1w(spark, sf).select("timestamp", *_DF), "ranged")
    early = F.col("timestamp") < F.lit("1998-07-01").cast("timestamp_ntz")
    return rows.where(early), rows.where(~early)


_PCTS = ["p5", "p25", "p50", "p75", "p95"]


@query("drift_profile", "J1", tidy_sql(S.with_ctes(*S.WITH_ATR_1W, _LONGREF) + """
SELECT feature, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, """ + ", ".join(
    f"quantile_cont(v, 0.{p[1:].zfill(2)}) AS {p}" for p in _PCTS) + " FROM lr WHERE ref GROUP BY 1",
    ["mean", "std", *_PCTS], ["feature", "n"]))
def drift_profile(spark, sf):
    return tidy(drift.profile(_drift_sides(spark, sf)[0], _DF), ["feature", "n", "mean", "std", *_PCTS])


@query("drift_ks", "J2", tidy_sql(S.with_ctes(*S.WITH_ATR_1W, _LONGREF, _KS) + "SELECT * FROM ks",
       ["ks_stat"], ["feature", "n_ref", "n_live"]))
def drift_ks(spark, sf):
    return tidy(drift.ks_statistic(drift.compare(*_drift_sides(spark, sf), _DF)))


@query("drift_ks_p", "J3", tidy_sql(S.with_ctes(*S.WITH_ATR_1W, _LONGREF, _KS, _KSP) + "SELECT * FROM kp",
       ["ks_p"], ["feature"]))
def drift_ks_p(spark, sf):
    ks = drift.ks_statistic(drift.compare(*_drift_sides(spark, sf), _DF))
    return tidy(drift.ks_p_value(ks), ["feature", "ks_p"])


@query("drift_psi", "J4", tidy_sql(S.with_ctes(*S.WITH_ATR_1W, _LONGREF, *_PSI) + "SELECT * FROM ps", ["psi"], ["feature"]))
def drift_psi(spark, sf):
    return tidy(drift.psi(drift.compare(*_drift_sides(spark, sf), _DF), _DF))


_REPORT = S.with_ctes(*S.WITH_ATR_1W, _LONGREF, _KS, _KSP, *_PSI)


def drift_report_sql(rows: str = _LONGREF, feature: str = "feature") -> str:
    """Check SQL of the report; ``rows`` defines ``lr`` (feature, v, ref), ``feature`` what is shown of its key."""
    return S.with_ctes(*S.WITH_ATR_1W, rows, _KS, _KSP, *_PSI) + f"""
SELECT {feature}, round(ks_stat, 4) AS ks_stat, round(ks_p, 4) AS ks_p, round(psi, 4) AS psi,
  (ks_stat > 0.1 OR psi > 0.2)::INT AS drifted FROM kp JOIN ps USING (feature) WHERE n_live >= 30"""


@query("drift_report", "J5", drift_report_sql())
def drift_report(spark, sf):
    return tidy(drift.report(*_drift_sides(spark, sf), _DF), None, 4)


@query("drift_summary", "J5", _REPORT + """
SELECT count(*) AS n_tested, count(*) FILTER (ks_stat > 0.1 OR psi > 0.2) AS n_drifted
FROM kp JOIN ps USING (feature) WHERE n_live >= 30""")
def drift_summary(spark, sf):
    return drift.summary(drift.report(*_drift_sides(spark, sf), _DF))
