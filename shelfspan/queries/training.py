"""Leak-free statistics, the fitted chain, blocks of time, and facts that hold for every trained model.

A trained model has no SQL, but much about it has: group means that a saturated
model must give, the number of rows it scores, equal predictions after loading,
importances that sum to one, a best trial that is the least one. Such queries
return rows ``fact, value``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from shelfspan.functions.scalar import weekend
from shelfspan.operators import blocks, boosting, encode, ordering, prepare, splits
from shelfspan.operators import evaluate as ev
from shelfspan.operators import models as m
from shelfspan.operators.demand import add_activity, add_intermittency, add_lags, add_rolling
from shelfspan.plans import chain, retail, training
from shelfspan.queries.aggregates import SPLIT
from shelfspan.queries.base import KEY, OVER, cols, d, f, i, query, rows, with_panel, with_priced
from shelfspan.queries.features import FOLD_OUT, INDEXED, integrated
from shelfspan.queries.models import frame
from shelfspan.queries.windows import KEYS, LAST_SALE, narrow, panel_sql, priced
from shelfspan.session import settle, shared_path
from shelfspan.sources.tables import append_run

TEST_ROWS = "(SELECT COUNT(*) FROM labeled WHERE split = 'test')"


def facts(spark, values: dict[str, float]):
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "fact string, value double")


def facts_sql(values: dict[str, str]) -> str:
    return with_panel(SPLIT) + " UNION ALL ".join(f"SELECT '{k}' AS fact, {f(v, 'value')}" for k, v in values.items())


# ---- statistics as they were known before the day ---------------------------

PAST = ("item_id", "cat_id", "store_id")


def past_cte(c: str, value: str = "demand", source: str = "panel") -> str:
    return f"""
days_{c} AS (SELECT {c} AS v, date AS day, COUNT({value}) AS n, SUM({value}) AS s, SUM({value} * {value}) AS q FROM {source} GROUP BY 1, 2),
past_{c} AS (SELECT v, day, COALESCE(SUM(n) OVER w, 0) AS n, CAST(SUM(s) OVER w AS DOUBLE) AS s, CAST(SUM(q) OVER w AS DOUBLE) AS q FROM days_{c}
             WINDOW w AS (PARTITION BY v ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    "a16_past_target_encoding",
    with_panel(*[past_cte(c) for c in PAST])
    + f"""SELECT {cols('store_id', 'item_id', d('date'), *[x for c in PAST for x in (
        f(f'p_{c}.s / nullif(p_{c}.n, 0)', f'{c}_past_mean'),
        f(f'CASE WHEN p_{c}.n > 1 THEN sqrt(greatest(p_{c}.q - p_{c}.s * p_{c}.s / p_{c}.n, 0) / (p_{c}.n - 1)) ELSE 0 END', f'{c}_past_std'),
        i(f'p_{c}.n', f'{c}_past_count'))])} FROM panel """
    + " ".join(f"JOIN past_{c} AS p_{c} ON p_{c}.v = panel.{c} AND p_{c}.day = panel.date" for c in PAST),
)
def past_target_encoding(spark, folder):
    """Target statistics of strictly earlier days, so no row sees its own demand or a later one."""
    full = encode.add_past_target_encoding(retail.panel(spark, folder), PAST)
    return full.select(*KEYS, *[f"{c}_past_{x}" for c in PAST for x in ("mean", "std", "count")])


@query(
    "a16_past_target_smoothed",
    with_panel("one AS (SELECT *, 'all' AS one FROM panel)", past_cte("cat_id"), past_cte("one", source="one"))
    + f"""SELECT {cols('store_id', 'item_id', d('date'), f('(COALESCE(c.s, 0) + 50 * o.s / nullif(o.n, 0)) / (c.n + 50)', 'cat_id_past_mean'))}
      FROM panel JOIN past_cat_id c ON c.v = panel.cat_id AND c.day = date JOIN past_one o ON o.day = date""",
)
def past_target_smoothed(spark, folder):
    """Category means that lean on the overall past mean by fifty rows."""
    return encode.add_past_target_encoding(retail.panel(spark, folder), ["cat_id"], smoothing=50.0).select(*KEYS, "cat_id_past_mean")


@query(
    "a15_past_price_ratio",
    with_priced(past_cte("cat_id", "sell_price", "priced"))
    + f"SELECT {cols('store_id', 'item_id', d('date'), f('sell_price / nullif(p.s / nullif(p.n, 0), 0)', 'price_vs_past_cat'))} FROM priced JOIN past_cat_id p ON p.v = cat_id AND p.day = date",
)
def past_price_ratio(spark, folder):
    """Price over the category's mean price on earlier days."""
    df = settle(priced(spark, folder), "priced")
    return encode.add_past_ratio(df, "sell_price", "cat_id", "price_vs_past_cat").select(*KEYS, "price_vs_past_cat")


# ---- long series in blocks of time -------------------------------------------


@query(
    "w_block_windows",
    panel_sql(
        *[i(f"LAG(demand, {n}) OVER ({OVER})", f"demand_lag_{n}") for n in (7, 28)],
        *[f(f"{fn}(demand) OVER {rows(n)}", f"demand_rolling_{name}_{n}") for n in (7, 56) for fn, name in (("AVG", "mean"), ("STDDEV_SAMP", "std"), ("MAX", "max"), ("MIN", "min"))],
        i(f"SUM(CASE WHEN demand > 0 THEN 1 ELSE 0 END) OVER {rows(28)}", "active_days_last_28"),
        f(f"AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) OVER {rows(14)}", "intermittency_ratio_14"),
        f(f"COALESCE(AVG(CASE WHEN demand > 0 THEN demand END) OVER {rows(14)}, 0)", "demand_intensity_14"),
    ),
)
def block_windows(spark, folder):
    """The plain windows' values, computed in blocks of 60 days that run side by side."""

    def compute(df, keys):
        df = add_rolling(add_lags(df, (7, 28), keys, detail=False), (7, 56), keys)
        return add_intermittency(add_activity(df, (28,), keys), (14,), keys)

    return blocks.in_blocks(narrow(spark, folder), compute, blocks.widest((7, 28), (7, 56), (28,), (14,)), days=60).drop("demand")


@query("w15_block_last_sale", panel_sql(i(f"COALESCE(date - {LAST_SALE}, 999)", "days_since_last_sale")))
def block_last_sale(spark, folder):
    return blocks.add_last_sale(settle(narrow(spark, folder), "panel"), days=60).drop("demand")


# ---- folds that only read their months ----------------------------------------


def counted(spark, folder, bounds):
    stored = splits.store_by_month(retail.panel(spark, folder).select(*KEYS, "demand"))
    parts = None
    for fold, bound in enumerate(bounds(stored)):
        for role in ("train", "valid"):
            part = splits.fold_rows(stored, bound, role).agg(
                F.lit(fold).alias("fold"), F.lit(role).alias("role"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                F.count(F.lit(1)).alias("n_rows"), F.sum("demand").alias("demand"),
            )
            parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "c10_fold_months",
    with_panel(INDEXED, """
placed AS (SELECT date, demand, fold, CASE WHEN idx < total - 28 - fold * ((total - 56) // 3) - 28 THEN 'train'
                 WHEN idx < total - 28 - fold * ((total - 56) // 3) THEN 'valid' END AS role
          FROM indexed CROSS JOIN (SELECT unnest([0, 1, 2]) AS fold))""")
    + f"SELECT {FOLD_OUT} FROM placed WHERE role IS NOT NULL GROUP BY fold, role",
)
def rolling_months(spark, folder):
    return counted(spark, folder, splits.rolling_origin_bounds)


@query(
    "c11_fold_months",
    with_panel(INDEXED, """
placed AS (SELECT date, demand, fold, CASE WHEN idx < total - (3 - fold) * (total // 4) THEN 'train'
                 WHEN idx < total - (3 - fold) * (total // 4) + (total // 4) THEN 'valid' END AS role
          FROM indexed CROSS JOIN (SELECT unnest([0, 1, 2]) AS fold))""")
    + f"SELECT {FOLD_OUT} FROM placed WHERE role IS NOT NULL GROUP BY fold, role",
)
def expanding_months(spark, folder):
    return counted(spark, folder, splits.expanding_bounds)


# ---- the fitted chain -----------------------------------------------------------

PRICE_LEVEL = "SUM(sell_price) / nullif(COUNT(sell_price), 0)"


@query(
    "c12_fitted_chain",
    with_priced(
        "train AS (SELECT * FROM priced WHERE date <= (SELECT MAX(date) FROM panel) - 56)",
        "month_means AS (SELECT item_id, month(date) AS mon, AVG(demand) AS mm FROM train GROUP BY 1, 2)",
        "strengths AS (SELECT item_id, mon, mm / nullif(AVG(mm) OVER (PARTITION BY item_id), 0) AS strength FROM month_means)",
        f"items AS (SELECT item_id, {PRICE_LEVEL} AS level, MIN(date) FILTER (WHERE demand > 0) AS first_sale, AVG(demand) AS item_mean, COUNT(*) AS item_n, "
        "row_number() OVER (ORDER BY item_id) - 1 AS code FROM train GROUP BY item_id)",
        f"cats AS (SELECT cat_id, {PRICE_LEVEL} AS cat_level, AVG(demand) AS cat_mean, COALESCE(STDDEV_SAMP(demand), 0) AS cat_std FROM train GROUP BY cat_id)",
        "weekdays AS (SELECT weekday, row_number() OVER (ORDER BY weekday) - 1 AS weekday_code FROM (SELECT DISTINCT weekday FROM train JOIN calendar USING (date)))",
        f"""moved AS (SELECT *, LAG(demand) OVER ({OVER}) AS l1, LAG(demand, 7) OVER ({OVER}) AS l7, AVG(demand) OVER {rows(28, 1)} AS m28, AVG(demand) OVER {rows(7, 1)} AS m7,
            AVG(demand) OVER {rows(14, 1)} AS m14, STDDEV_SAMP(demand) OVER {rows(7, 1)} AS s7, SUM(CASE WHEN demand > 0 THEN 1 ELSE 0 END) OVER {rows(7, 1)} AS a7,
            AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) OVER {rows(14, 1)} AS i14, COALESCE(date - {LAST_SALE}, 999) AS since FROM priced)""",
    )
    + f"""SELECT {cols('store_id', 'item_id', d('moved.date', 'date'), i('demand'), i('code', 'item_id_encoded'), i('weekday_code', 'weekday_encoded'), f('strength', 'seasonal_strength'),
        f('sell_price / level', 'price_vs_item_avg'), f('sell_price / cat_level', 'price_vs_cat_avg'), i('moved.date - COALESCE(first_sale, moved.date)', 'item_age_days'),
        i('l7', 'demand_lag_7'), f('m28', 'demand_rolling_mean_28'), i('a7', 'active_days_last_7'), f('i14', 'intermittency_ratio_14'), i('since', 'days_since_last_sale'),
        f('cat_mean', 'cat_id_target_mean'), f('cat_std', 'cat_id_target_std'), i('item_n', 'item_id_target_count'), f('l1 / (item_mean + 1e-8)', 'store_performance'),
        f('m7 - m14', 'demand_velocity_7_14'), f('(l1 - m7) / (s7 + 1e-8)', 'demand_trend_7', 3))}
      FROM moved LEFT JOIN items USING (item_id) LEFT JOIN cats USING (cat_id) LEFT JOIN strengths ON strengths.item_id = moved.item_id AND mon = month(moved.date)
      JOIN calendar c ON c.date = moved.date LEFT JOIN weekdays ON weekdays.weekday = c.weekday""",
)
def fitted_chain(spark, folder):
    """Fitted on the training dates, saved, loaded, and applied to every row."""
    df = splits.split_by_last_days(integrated(spark, folder))
    path = shared_path(spark, "chain")
    PipelineModel([chain.DemandChain().fit(df.where(F.col("split") == "train"))]).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df)
    return out.select(
        *KEYS, "demand", "item_id_encoded", "weekday_encoded", "seasonal_strength", "price_vs_item_avg", "price_vs_cat_avg", "item_age_days", "demand_lag_7",
        "demand_rolling_mean_28", "active_days_last_7", "intermittency_ratio_14", "days_since_last_sale", "cat_id_target_mean", "cat_id_target_std", "item_id_target_count",
        "store_performance", "demand_velocity_7_14", F.round("demand_trend_7", 3).alias("demand_trend_7"),
    )


@query(
    "m01_training_path",
    facts_sql({"features": "134", "rows scored": f"4 * {TEST_ROWS}", "negative or missing": "0", "categories": "4 * (SELECT COUNT(DISTINCT cat_id) FROM panel)"}),
)
def training_path(spark, folder):
    """The whole path: fitted chain, all its features, three models and their ensemble, also by category."""
    df = settle(splits.split_by_last_days(integrated(spark, folder)), "split")
    estimators = {"xgboost": m.boosted_trees(8, 6, rate=0.3), "random_forest": m.random_forest(8, 8), "poisson": boosting.PoissonBoosting(trees=3, depth=5, rate=0.5)}
    path = training.fit_path(df, estimators)
    return facts(spark, {
        "features": len(path.columns),
        "rows scored": path.forecasts.count(),
        "negative or missing": path.forecasts.where("y_pred is null or y_pred < 0").count(),
        "categories": path.by_category.count(),
    })


# ---- count boosting, error curves ------------------------------------------------


@query("m02_poisson_group_means", with_panel() + f"SELECT {cols(i('CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END', 'is_weekend'), f('AVG(demand)', 'y_pred'))} FROM panel GROUP BY 1")
def poisson_group_means(spark, folder):
    """One full step of count boosting with a single split gives the groups' means."""
    df = prepare.assemble(retail.panel(spark, folder).select("demand", weekend().alias("is_weekend")), ["is_weekend"])
    fitted = boosting.PoissonBoosting(trees=1, depth=1, rate=1.0).fit(df)
    return fitted.transform(df).groupBy("is_weekend").agg(F.max("prediction").alias("y_pred"))


def matrix(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    return data


def split_of(data, name):
    return data.where(F.col("split") == name)


@query(
    "m02_poisson_boosting",
    facts_sql({"trees grown": "8", "rounds with rising deviance": "0", "kept beyond the best": "0", "rows scored": TEST_ROWS, "not positive": "0", "different after loading": "0"}),
)
def poisson_boosting(spark, folder):
    """Deviance falls with every tree; validation rows choose how many are kept."""
    data = matrix(spark, folder)
    flagged = data.where(F.col("split") != "test").withColumn("is_valid", F.col("split") == "valid")
    model = boosting.PoissonBoosting(trees=8, depth=5, rate=0.3, patience=100, validationCol="is_valid").fit(flagged)
    curve = model.history(spark).orderBy("iteration").collect()
    errors = [r["valid_error"] for r in curve]
    path = shared_path(spark, "poisson")
    model.write().overwrite().save(path)
    scored = boosting.TreeSum.load(path).named("again").transform(model.transform(split_of(data, "test")))
    return facts(spark, {
        "trees grown": len(curve),
        "rounds with rising deviance": sum(b["train_error"] > a["train_error"] + 1e-12 for a, b in zip(curve, curve[1:], strict=False)),
        "kept beyond the best": model.getNumTrees - 1 - errors.index(min(errors)),
        "rows scored": scored.count(),
        "not positive": scored.where("prediction is null or prediction <= 0").count(),
        "different after loading": scored.where("again <> prediction").count(),
    })


@query("m11_iteration_history", facts_sql({"iterations": "12", "kept differs from the best": "0", "kept error differs from the curve": "0", "rising training errors": "0"}))
def iteration_history(spark, folder):
    """Errors after each tree in one pass; the stored model holds the trees up to the best iteration."""
    data = matrix(spark, folder)
    train, valid = split_of(data, "train"), split_of(data, "valid")
    cut = boosting.cut_at_best(m.boosted_trees(12, 5, rate=0.3, rows=1.0, columns=1.0).fit(train), train, valid)
    curve = cut.history(spark).orderBy("iteration").collect()
    errors = [r["valid_error"] for r in curve]
    own = cut.transform(valid).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("demand"), 2)))).first()[0]
    return facts(spark, {
        "iterations": len(curve),
        "kept differs from the best": cut.getNumTrees - 1 - errors.index(min(errors)),
        "kept error differs from the curve": abs(own - min(errors)) > 1e-9,
        "rising training errors": sum(b["train_error"] > a["train_error"] + 1e-9 for a, b in zip(curve, curve[1:], strict=False)),
    })


# ---- facts of the other models ----------------------------------------------------


def saturated(name: str, model):
    """Count models of one flag must give the means of its two groups."""
    sql = with_panel() + f"SELECT {cols(i('CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END', 'is_weekend'), f('AVG(demand)', 'y_pred', 4))} FROM panel GROUP BY 1"

    @query(name, sql, digits=4)
    def run(spark, folder):
        df = prepare.assemble(retail.panel(spark, folder).select("demand", weekend().alias("is_weekend")), ["is_weekend"])
        return model().fit(df).transform(df).groupBy("is_weekend").agg(F.max("prediction").alias("y_pred"))


saturated("m03_poisson_group_means", lambda: m.count_model("poisson", regularisation=0.0))
saturated("m03_tweedie_group_means", lambda: m.count_model("tweedie", 1.1, regularisation=0.0))


@query(
    "m05_trend_line",
    with_panel() + f"SELECT {cols('cat_id', f('regr_intercept(demand, date - lo)', 'level', 5), f('regr_slope(demand, date - lo)', 'slope'))} FROM panel CROSS JOIN bounds GROUP BY cat_id",
    digits=6,
)
def trend_line(spark, folder):
    """With a constant and a line as terms the seasonal fit is plain regression."""
    df = settle(retail.panel(spark, folder).select(*training.KEYS, "demand"), "panel")
    start = df.agg(F.min("date")).scalar()
    basis = F.array(F.lit(1.0), F.datediff("date", start).cast("double"))
    fitted = m.fit_seasonal(df, "cat_id", start, basis=basis, logarithm=False)
    return fitted.select(F.col("group").alias("cat_id"), F.round(F.get("coefficients", F.lit(0)), 5).alias("level"), F.get("coefficients", F.lit(1)).alias("slope"))


@query("m05_trend_with_bends", facts_sql({"rows": "(SELECT COUNT(*) FROM panel)", "outside its interval": "0", "negative": "0", "coefficients": "28 + 25 + 1", "groups": "(SELECT COUNT(DISTINCT cat_id) FROM panel)"}))
def trend_with_bends(spark, folder):
    """A trend with 25 possible bends, waves and a holiday term, with its interval."""
    df = settle(retail.panel(spark, folder).select(*training.KEYS, "demand"), "panel")
    start, end = df.agg(F.min("date")).scalar(), df.agg(F.max("date")).scalar()
    christmas = (F.date_format("date", "MM-dd") == "12-25").cast("int")
    basis = m.seasonal_basis("date", start, end=end, changepoints=25, events=[christmas])
    fitted = settle(m.fit_seasonal(df, "cat_id", start, basis=basis, penalties=m.bend_penalties(events=1)), "fitted")
    out = m.predict_seasonal(df, fitted, "cat_id", start, basis=basis)
    seen = out.agg(F.count(F.lit(1)), F.count_if(F.expr("not (y_low <= y_pred and y_pred <= y_high)")), F.count_if(F.expr("y_low < 0 or y_pred < 0"))).first()
    sizes = fitted.agg(F.max(F.size("coefficients")), F.count(F.lit(1))).first()
    return facts(spark, dict(zip(("rows", "outside its interval", "negative", "coefficients", "groups"), (*seen, *sizes), strict=True)))


SPACE = {"trees": (2, 6), "depth": (2, 5), "rate": (0.05, 0.5, "log"), "rows": (0.5, 1.0), "columns": (0.4, 1.0), "min_rows": (1, 30)}


@query(
    "m09_model_search",
    facts_sql({"trials": "6", "random trials": "3", "best differs from the least": "0", "worse than its random trials": "0", "pruned with all folds": "0", "outside the space": "0"}),
)
def model_search(spark, folder):
    """Six parameters, trials behind the first learn from those before, folds read only their months."""
    stored = splits.store_by_month(matrix(spark, folder).select(*training.KEYS, "demand", "features"))
    results = m.search_months(m.boosted_trees, SPACE, stored, splits.expanding_bounds(stored, 2), trials=6, startup=3)
    found = results.collect()
    whole = [r for r in found if not r["pruned"]]
    best = m.best_candidate(results.where("not pruned")).first()

    def inside(text: str) -> bool:
        values = dict(pair.split("=") for pair in text.split(", "))
        return all(low - 1e-9 <= float(values[name]) <= high + 1e-9 for name, (low, high, *_) in SPACE.items())

    return facts(spark, {
        "trials": len(found),
        "random trials": sum(r["source"] == "random" for r in found),
        "best differs from the least": best["rmse"] != min(r["rmse"] for r in whole),
        "worse than its random trials": best["rmse"] > min(r["rmse"] for r in found[:3]),
        "pruned with all folds": sum(r["pruned"] and r["folds"] == 2 for r in found),
        "outside the space": sum(not inside(r["params"]) for r in found),
    })


@query("m10_grid_facts", facts_sql({"candidates": "4", "best differs from the least": "0", "folds read": "2"}))
def grid_facts(spark, folder):
    stored = splits.store_by_month(matrix(spark, folder).select(*training.KEYS, "demand", "features"))
    bounds = splits.rolling_origin_bounds(stored, 2)
    errors = {}
    for number, params in enumerate(m.grid({"trees": [3, 6], "depth": [3, 5]})):
        fits = [m.random_forest(**params).fit(splits.fold_rows(stored, b, "train")) for b in bounds]
        errors[number] = sum(m.rmse_of(fit, splits.fold_rows(stored, b, "valid")) for fit, b in zip(fits, bounds, strict=True)) / len(bounds)
    results = spark.createDataFrame([(n, str(n), e) for n, e in errors.items()], "candidate int, params string, rmse double")
    return facts(spark, {"candidates": len(errors), "best differs from the least": errors[m.best_candidate(results).first()["candidate"]] != min(errors.values()), "folds read": len(bounds)})


@query(
    "m06_m15_model_facts",
    facts_sql({
        "rows scored": TEST_ROWS, "models": "2", "negative or missing": "0", "ensemble differs from its weights": "0", "importances sum": "1", "negative importances": "0",
        "features": str(len(training.FEATURES)), "records": "2", "recorded error differs": "0", "promoted is not the best": "0", "promoted error differs": "0", "different after loading": "0",
    }),
)
def model_facts(spark, folder):
    """Two models trained, recorded, scored, averaged, compared, promoted, loaded: what must hold of each step."""
    source = frame(spark, folder)
    both = {"xgboost": m.boosted_trees(8, 5, rate=0.3), "random_forest": m.random_forest(8, 6)}
    pipelines, records, metrics = training.compare(source, both, m.ENSEMBLE_WEIGHTS)
    path = shared_path(spark, "promoted")
    best = training.promote(pipelines, metrics, path)
    test = split_of(source, "test")
    fitted = {name: p.stages[-1] for name, p in pipelines.items()}
    data = pipelines["xgboost"].stages[0].transform(test)
    scored = settle(m.score(fitted, data.select(*training.KEYS, "demand", "features")), "scored").withColumn("ensemble", m.weighted_mean(list(fitted), m.ENSEMBLE_WEIGHTS))
    w = m.ENSEMBLE_WEIGHTS
    own = (F.col("xgboost") * w["xgboost"] + F.col("random_forest") * w["random_forest"]) / (w["xgboost"] + w["random_forest"])
    names = [*fitted, "ensemble"]
    loaded = m.load_model(f"{path}/model").transform(test).select(*training.KEYS, m.non_negative(F.col("prediction")).alias("again"))
    joined = scored.join(loaded, list(training.KEYS), "full_outer")
    weights = m.importances(fitted["random_forest"], training.FEATURES, spark).agg(F.sum("importance"), F.count_if(F.expr("importance < 0")), F.count(F.lit(1))).first()
    table = {r["model"]: r["rmse"] for r in metrics.collect()}
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr(" or ".join(f"{c} is null or {c} < 0" for c in names))).alias("bad"), F.count_if(F.abs(own - F.col("ensemble")) > 1e-9).alias("off"),
        *[F.sqrt(F.avg(F.pow(F.col(c) - F.col("demand"), 2))).alias(f"rmse_{c}") for c in names],
    ).first()
    run = spark.read.json(f"{path}/runs").first()
    errors = {r["model"]: r["train_rmse"] for r in records.collect()}
    again = {name: m.rmse_of(p, split_of(source, "train")) for name, p in pipelines.items()}
    return facts(spark, {
        "rows scored": sums["n"], "models": len(fitted), "negative or missing": sums["bad"], "ensemble differs from its weights": sums["off"],
        "importances sum": weights[0], "negative importances": weights[1], "features": weights[2], "records": records.count(),
        "recorded error differs": sum(abs(errors[name] - again[name]) > 1e-6 for name in errors),
        "promoted is not the best": sums[f"rmse_{best}"] > min(sums[f"rmse_{name}"] for name in fitted) + 1e-9,
        "promoted error differs": abs(float(run["value"]) - sums[f"rmse_{best}"]) > 1e-6 or abs(table[best] - sums[f"rmse_{best}"]) > 1e-6,
        "different after loading": joined.where(f"again is null or {best} is null or abs(again - {best}) > 1e-9").count(),
    })


@query("r09_sample_facts", facts_sql({"rows": "1000", "different keys": "1000", "not in the table": "0", "same again": "1000"}))
def sample_facts(spark, folder):
    panel = settle(retail.panel(spark, folder).select(*KEYS, "demand"), "panel")
    sample = settle(ordering.sample_rows(panel, 1000), "sample")
    again = ordering.sample_rows(panel, 1000)
    return facts(spark, {
        "rows": sample.count(), "different keys": sample.select(*KEYS).distinct().count(), "not in the table": sample.exceptAll(panel).count(), "same again": sample.intersect(again).count(),
    })


@query("s13_run_facts", facts_sql({"records": "2", "models": "2", "without a time": "0"}))
def run_facts(spark, folder):
    """Run records appended one after another, read back."""
    data = matrix(spark, folder)
    path = shared_path(spark, "runs")
    _, records = m.train({"poisson": m.count_model(), "random_forest": m.random_forest(3, 4)}, split_of(data, "train"))
    for row in records.collect():
        append_run(spark, path, row.asDict())
    runs = spark.read.json(path)
    return facts(spark, {"records": runs.count(), "models": runs.select("model").distinct().count(), "without a time": runs.where("recorded_at is null or training_time is null").count()})


@query("s12_save_load_facts", facts_sql({"rows scored": TEST_ROWS, "different after loading": "0"}))
def save_load_facts(spark, folder):
    data = matrix(spark, folder)
    fitted = Pipeline(stages=[m.random_forest(3, 4)]).fit(split_of(data, "train"))
    path = shared_path(spark, "model")
    m.save_model(fitted, path)
    test = split_of(data, "test").select(*training.KEYS, "features")
    before, after = (p.transform(test).select(*training.KEYS, "prediction") for p in (fitted, m.load_model(path)))
    return facts(spark, {"rows scored": after.count(), "different after loading": before.exceptAll(after).count()})


ROBUST = ("demand", "day_num")


@query(
    "c05_exact_robust_scaling",
    with_panel("q AS (SELECT " + ", ".join(f"quantile_cont({c}, {p}) AS {c}_{n}" for c in ROBUST for n, p in (("a", 0.25), ("m", 0.5), ("b", 0.75))) + " FROM panel)")
    + f"SELECT {KEY}, {cols(*[f(f'({c} - {c}_m) / CASE WHEN {c}_b = {c}_a THEN 1 ELSE {c}_b - {c}_a END', c) for c in ROBUST])} FROM panel CROSS JOIN q",
)
def exact_robust_scaling(spark, folder):
    """Exact medians and quartiles, without a quantile sketch."""
    df = settle(retail.panel(spark, folder).select(*KEYS, *ROBUST), "panel")
    return prepare.robust_scale(df, ROBUST)
