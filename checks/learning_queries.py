"""Learning on the given tables; checked by row counts and by the tests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from perilspark.functions.flags import AlertThresholds
from perilspark.operators.isotonic import fit_isotonic
from perilspark.operators.learners import (
    climate_clusters, cluster_stations, draw_trials, feature_importance, fit_learner, parameter_space, permutation_importance, weekly_profile,
)
from perilspark.plans.modelling import ModelSpec, final_model, predict, prepare, tune

from . import rounded, table

SPEC = ModelSpec(
    label="y", numeric=["price", "quantity", "tax"], categorical=["status", "month"], algorithm="xgbc",
    months_backtest=12, group="station_id", group_fraction=0.2, quantiles=10,
)
PARAMS = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "scale_pos_weight": 3}
SPACE = {
    "n_estimators": {"type": "int", "low": 2, "high": 4}, "max_depth": {"type": "int", "low": 2, "high": 3},
    "learning_rate": {"type": "float", "low": 0.1, "high": 0.3, "step": 0.1},
}


def master(spark, folder):
    """Line items as a master table: expensive items are the events."""
    li = table(spark, folder, "lineitem")
    time = F.to_date("l_shipdate")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("station_id"), time.alias("time"),
        F.date_format(time, "yyyyMM").alias("yearmon"), F.month(time).alias("month"), F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"),
        F.when(F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_tax") * 100000 > 60000, 1).otherwise(0).alias("y"),
    )


def nation_weeks(spark, folder):
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.col("c_nationkey")
    weekly = orders.groupBy(
        n.alias("station_id"), (n % 5).cast("double").alias("lon"), F.floor(n / 5).cast("double").alias("lat"),
        F.year("o_orderdate").alias("year"), F.weekofyear("o_orderdate").alias("week"),
    )
    return weekly.agg(F.round(F.sum("o_totalprice"), 2).alias("prcp"))


def clusters(spark, folder):
    return climate_clusters(nation_weeks(spark, folder), "prcp", ["station_id"], ["lon", "lat"])


def week_profile(spark, folder):
    """Weekly means per station as columns, joined with the coordinates."""
    wide = weekly_profile(nation_weeks(spark, folder), "prcp", ["station_id"], ["lon", "lat"])
    return rounded(wide, 4, *[f"prcp_{w}" for w in range(1, 53)])


def vector_clusters(spark, folder):
    e = table(spark, folder, "embeddings")
    wide = e.select(F.col("vec_id").alias("station_id"), *[F.get("embedding", F.lit(i)).cast("double").alias(f"v{i}") for i in range(64)])
    return cluster_stations(wide, ["station_id"], components=4, k=3)


def train_calibrate(spark, folder):
    prepared = prepare(master(spark, folder), SPEC)
    out = final_model(prepared, SPEC, PARAMS, ties=["l_orderkey", "l_linenumber", "l_partkey"])
    return out.predictions.select("l_orderkey", "l_linenumber", "subset", "y", "prob_class_0", "prob_class_1", "quantile_class_0", "quantile_class_1")


def train_report(spark, folder):
    return final_model(prepare(master(spark, folder), SPEC), SPEC, PARAMS, ties=["l_orderkey", "l_linenumber", "l_partkey"]).metrics


def importance(spark, folder):
    prepared = prepare(master(spark, folder), SPEC)
    model = final_model(prepared, SPEC, PARAMS, ties=["l_orderkey", "l_linenumber", "l_partkey"]).model
    gain = feature_importance(model).withColumn("kind", F.lit("gain"))
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    loss = permutation_importance(model, prepared.where(F.col("subset") != "train"), "y", ids)
    return gain.unionByName(loss.withColumn("kind", F.lit("permutation")))


def tuning(spark, folder):
    result = tune(prepare(master(spark, folder), SPEC), SPEC, SPACE, n_trials=4)
    return result.trials


def score(spark, folder):
    rows = master(spark, folder)
    prepared = prepare(rows, SPEC)
    model = final_model(prepared, SPEC, PARAMS, ties=["l_orderkey", "l_linenumber", "l_partkey"]).model
    return predict(rows, model, SPEC.categorical, AlertThresholds(0.4, 0.1), ["l_orderkey", "l_linenumber", "station_id", "time"])


# Trees of one split have twins in SQL: one feature, one border, two means.
STUMP = ModelSpec(
    label="y", numeric=["quantity", "tax", "month"], categorical=["status"], algorithm="xgbc",
    months_backtest=12, group="station_id", group_fraction=0.2, quantiles=10,
)
ONE_SPLIT = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "scale_pos_weight": 3}
STUMP_SPACE = {
    "n_estimators": {"type": "int", "low": 1, "high": 1}, "max_depth": {"type": "categorical", "choices": [1]},
    "scale_pos_weight": {"type": "categorical", "choices": [1, 2, 3, 5]}, "max_features": {"type": "categorical", "choices": ["all"]},
}
TRIALS = 3
IDS = ["l_orderkey", "l_linenumber", "l_partkey"]


def stump_train(spark, folder):
    """Split, weigh, fit, calibrate, score and rank: the whole run with trees of one split."""
    out = final_model(prepare(master(spark, folder), STUMP), STUMP, ONE_SPLIT, ties=IDS).predictions
    return rounded(out.select(*IDS, "subset", "y", "prob_class_0", "prob_class_1", "quantile_class_0", "quantile_class_1"), 9, "prob_class_0", "prob_class_1")


def stump_alerts(spark, folder):
    rows = master(spark, folder)
    model = final_model(prepare(rows, STUMP), STUMP, ONE_SPLIT, ties=IDS).model
    out = predict(rows, model, STUMP.categorical, AlertThresholds(0.4, 0.1), [*IDS, "station_id", "time"])
    return rounded(out, 9, "pred_target")


def stump_tuning(spark, folder):
    """Trials on the default four folds; choices that are words stay words."""
    trials = tune(prepare(master(spark, folder), STUMP), STUMP, STUMP_SPACE, n_trials=TRIALS).trials
    out = trials.select(
        "trial_number", F.col("params")["scale_pos_weight"].alias("weight"), F.col("params")["max_features"].alias("max_features"), "state",
        "mean_test_score", "mean_train_score", "gap_train_test",
    )
    return rounded(out, 9, "mean_test_score", "mean_train_score", "gap_train_test")


def stump_three_classes(spark, folder):
    """Boosting of three classes: one against the rest on the same bins, shares that sum to 1."""
    rows = master(spark, folder).withColumn("cls", F.when(F.col("quantity") > 35, 2).when(F.col("tax") > 0.04, 1).otherwise(0))
    model = fit_learner(rows, "cls", ["quantity", "tax", "month"], ["status"], "xgbc", ONE_SPLIT, n_classes=3)
    scored = model.with_label(model.score(rows))
    return rounded(scored.select(*IDS, "cls", "predicted", *[f"prob_class_{i}" for i in range(3)]), 9, *[f"prob_class_{i}" for i in range(3)])


class Rule:
    """A stated rule in a model's place: it scores rows and names its features."""

    algorithm, n_classes = "hgbc", 2
    features = ["quantity", "tax", "month"]

    def score(self, df):
        p = F.least(F.lit(1.0), F.col("quantity") / 60 + F.col("tax") * 4)
        return df.withColumns({"prob_class_0": 1 - p, "prob_class_1": p})

    def with_label(self, df):
        return df.withColumn("predicted", (F.col("prob_class_1") > 0.5).cast("int"))


def permutation_rule(spark, folder):
    """Loss of accuracy and of AUC over the default four repeats."""
    rows = master(spark, folder)
    kinds = [permutation_importance(Rule(), rows, "y", [*IDS, "station_id", "time"], metric=m).withColumn("metric", F.lit(m)) for m in ("accuracy", "auc")]
    return rounded(kinds[0].unionByName(kinds[1]), 9, "importance")


def isotonic(spark, folder):
    """The fit of a score with ties, at every score."""
    rows = master(spark, folder).withColumn("p", F.floor(F.col("price") / 250) / 1000)
    curve = fit_isotonic(rows, "p", "y")
    return rounded(curve.transform(rows.select("p").distinct(), "p", "fitted"), 9, "fitted")


def separated_clusters(spark, folder):
    """Climates far apart: each station with the smallest member of its cluster."""
    weekly = nation_weeks(spark, folder).withColumn("prcp", F.col("prcp") / 1e9 + 10 * (F.col("station_id") % 3))
    found = climate_clusters(weekly.withColumns({"lon": F.lit(0.0), "lat": F.col("lat") / 1e6}), "prcp", ["station_id"], ["lon", "lat"])
    return found.select("station_id", F.min("station_id").over(Window.partitionBy("cluster")).alias("first_of_cluster"))


QUERIES = {
    "climate_clusters": clusters,
    "week_profile": week_profile,
    "vector_clusters": vector_clusters,
    "train_calibrate": train_calibrate,
    "train_report": train_report,
    "importance": importance,
    "tuning": tuning,
    "score": score,
    "stump_train": stump_train,
    "stump_alerts": stump_alerts,
    "stump_tuning": stump_tuning,
    "stump_three_classes": stump_three_classes,
    "permutation_rule": permutation_rule,
    "isotonic": isotonic,
    "climate_clusters_separated": separated_clusters,
}

_MASTER = """
    m as (select l_orderkey, l_linenumber, l_partkey, l_suppkey as station_id, cast(l_shipdate as date) as time, strftime(l_shipdate, '%Y%m') as yearmon,
                 month(l_shipdate) as month, l_linestatus as status, l_extendedprice as price, l_quantity as quantity, l_tax as tax,
                 case when l_extendedprice * (1 - l_discount) + l_tax * 100000 > 60000 then 1 else 0 end as y from lineitem)"""

_PREPARED = f"""{_MASTER},
    outs as (select station_id from (
        select station_id, row_number() over (order by md5(concat_ws('|', station_id, 42)), station_id) as r, count(*) over () as n
        from (select distinct station_id from m)) where r <= ceil(round(n * 0.2e0, 9))),
    late as (select distinct yearmon from m where station_id not in (select station_id from outs) order by 1 desc limit 12),
    prepared as (select *, case when station_id in (select station_id from outs) then 'out_of_sample' when yearmon in (select yearmon from late) then 'backtest' else 'train' end as subset from m)"""


def stump_sql(source: str, name: str) -> str:
    """CTEs that fit a tree of one split per key k on ``source`` (k, y, w and features), ending in ``<name>``.

    Its rows are (k, f, nxt, ml, mr): values of feature f below nxt have mean ml of the labels -1 and 1, others mr.
    """
    parts = " union all ".join(
        f"select k, '{f}' as f, {v} as v, sum(w) as w, sum(w * (2 * y - 1)) as s from {source} group by all"
        for f, v in (("quantity", "cast(quantity as double)"), ("tax", "cast(tax as double)"), ("month", "cast(month as double)"),
                     ("status", "case when status = 'O' then 1e0 else 0e0 end"))
    )
    return f"""
    {name}_levels as ({parts}),
    {name}_sums as (select *, lead(v) over by_v as nxt, sum(w) over by_v as wl, sum(s) over by_v as sl,
                           sum(w) over (partition by k, f) as wt, sum(s) over (partition by k, f) as st
                    from {name}_levels window by_v as (partition by k, f order by v)),
    {name} as (select k, f, nxt, sl / wl as ml, (st - sl) / (wt - wl) as mr from (
        select *, row_number() over (partition by k order by round(sl * sl / wl + (st - sl) * (st - sl) / (wt - wl), 6) desc, f, v) as r
        from {name}_sums where nxt is not null) where r = 1)"""


def _value(f: str = "t.f", row: str = "p") -> str:
    return f"case {f} when 'quantity' then {row}.quantity when 'tax' then {row}.tax when 'month' then {row}.month else ({row}.status = 'O')::int end"


_PROBABILITY = f"1 / (1 + exp(-2 * case when {_value()} < t.nxt then t.ml else t.mr end))"

# The largest, over all starts below, of the smallest mean over all ends above.
_ISOTONIC = """
    {0}_sums as (select p, sum(s) over (order by p) as s, sum(n) over (order by p) as n, s as own_s, n as own_n from {0}),
    {0}_pairs as (select a.p as start, b.p as p, min((b.s - a.s + a.own_s) / (b.n - a.n + a.own_n)) over (partition by a.p order by b.p desc) as low
                  from {0}_sums a join {0}_sums b on a.p <= b.p),
    {0}_fit as (select p, max(low) as fitted from {0}_pairs group by p)"""

_STUMP = f"""{_PREPARED},
    fitted_on as (select 0 as k, y, case when y = 1 then 3e0 else 1e0 end as w, quantity, tax, month, status from prepared where subset = 'train'),
    {stump_sql('fitted_on', 'tree')},
    raw as (select p.*, {_PROBABILITY} as p from prepared p, tree t),
    held as (select round(p, 12) as p, sum(y)::double as s, count(*)::double as n from raw where subset <> 'train' group by 1),
    {_ISOTONIC.format('held')},
    done as (select raw.*, fitted as prob_class_1, 1 - fitted as prob_class_0 from raw join held_fit on held_fit.p = round(raw.p, 12))"""


def _quantile(p: str) -> str:
    rank = f"row_number() over (partition by station_id order by round({p}, 12) desc, time, l_orderkey, l_linenumber, l_partkey)"
    return f"cast(greatest(1, ceil(({rank} - 1) * 10 / greatest(count(*) over (partition by station_id) - 1, 1))) as int)"


_WEIGHTS = [t["scale_pos_weight"] for t in draw_trials(parameter_space(STUMP_SPACE), TRIALS)]

_TUNING = f"""{_PREPARED},
    months as (select distinct yearmon from prepared where subset = 'train'),
    folds as (select fold, yearmon from (
        select fold, yearmon, row_number() over (partition by fold order by md5(concat_ws('|', yearmon, fold, 42)), yearmon) as r, count(*) over (partition by fold) as n
        from months, generate_series(0, 3) g(fold)) where r <= ceil(n * 0.25e0)),
    trials(trial, weight) as (values {', '.join(f'({i}, {w})' for i, w in enumerate(_WEIGHTS))}),
    parted as (select p.*, fold, (fold, yearmon) in (select (fold, yearmon) from folds) as test
               from prepared p, generate_series(0, 3) g(fold) where subset = 'train'),
    fitted_on as (select trial * 10 + fold as k, y, case when y = 1 then weight::double else 1e0 end as w, quantity, tax, month, status
                  from parted, trials where not test),
    {stump_sql('fitted_on', 'tree')},
    raw as (select k, test, p.y, {_PROBABILITY} as p from parted p join tree t on k % 10 = fold),
    lv0 as (select k, test, round(p, 12) as p, sum(y) as pos, sum(1 - y) as neg from raw group by all),
    lv as (select *, sum(neg) over (partition by k, test order by p) as cn, sum(pos) over (partition by k, test) as tpos, sum(neg) over (partition by k, test) as tneg from lv0),
    aucs as (select k // 10 as trial, test, sum(pos * (cn - neg + neg / 2e0)) / (max(tpos) * max(tneg)) as a from lv group by k, test),
    means as (select trial, avg(a) filter (test) as mt, avg(a) filter (not test) as mf from aucs group by 1)"""

_THREE = ", ".join(
    f"fitted_{c} as (select 0 as k, (cls = {c})::int as y, 1e0 as w, quantity, tax, month, status from classes), {stump_sql(f'fitted_{c}', f'tree_{c}')}"
    for c in range(3)
)

_PERMUTED = f"""{_MASTER},
    numbered as (select quantity, tax, month, y, count(*) over () as n,
                        row_number() over (order by md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, station_id, time))) as i from m),
    pairs as (select r, a.y, a.quantity, a.tax, a.month, b.quantity as q2, b.tax as t2, b.month as m2 from numbered a cross join generate_series(0, 3) g(r)
              join numbered b on a.i = (b.i - 1 + 1 + (r + 24) * 2654435761 % (b.n - 1)) % b.n + 1),
    moved as (select '' as f, -1 as r, y, quantity, tax from numbered
              union all select 'quantity', r, y, q2, tax from pairs union all select 'tax', r, y, quantity, t2 from pairs
              union all select 'month', r, y, quantity, tax from pairs),
    scored as (select f, r, y, least(1e0, quantity / 60 + tax * 4) as p from moved),
    lv0 as (select f, r, p, sum(y) as pos, sum(1 - y) as neg from scored group by all),
    lv as (select *, sum(neg) over (partition by f, r order by p) as cn, sum(pos) over (partition by f, r) as tpos, sum(neg) over (partition by f, r) as tneg from lv0),
    quality as (select 'auc' as metric, f, r, sum(pos * (cn - neg + neg / 2e0)) / (max(tpos) * max(tneg)) as q from lv group by f, r
                union all select 'accuracy', f, r, avg((y = (p > 0.5)::int)::int) from scored group by f, r)"""

ORACLES = {
    "week_profile": f"""
        with w as (select c_nationkey as station_id, cast(c_nationkey % 5 as double) as lon, cast(c_nationkey // 5 as double) as lat,
                          year(o_orderdate) as y, weekofyear(o_orderdate) as week, round(sum(o_totalprice), 2) as prcp
                   from orders join customer on o_custkey = c_custkey group by all)
        select station_id, lon, lat, {', '.join(f'round(avg(prcp) filter (week = {w}), 4) as prcp_{w}' for w in range(1, 53))} from w group by all""",
    "stump_train": f"""
        with {_STUMP} select l_orderkey, l_linenumber, l_partkey, subset, y, round(prob_class_0, 9) as prob_class_0, round(prob_class_1, 9) as prob_class_1,
            {_quantile('prob_class_0')} as quantile_class_0, {_quantile('prob_class_1')} as quantile_class_1 from done""",
    "stump_alerts": f"""
        with {_STUMP} select l_orderkey, l_linenumber, l_partkey, station_id, time, round(prob_class_1, 9) as pred_target, case when prob_class_1 >= 0.4 then 'Red' when prob_class_1 >= 0.1 then 'Orange' else 'None' end as alert_level from done""",
    "stump_tuning": f"""
        with {_TUNING} select trial as trial_number, weight::varchar as weight, 'all' as max_features, 'COMPLETE' as state, round(mt, 9) as mean_test_score,
            round(mf, 9) as mean_train_score, round(mf - mt, 9) as gap_train_test from means join trials using (trial)""",
    "stump_three_classes": f"""
        with {_MASTER}, classes as (select *, case when quantity > 35 then 2 when tax > 0.04 then 1 else 0 end as cls from m), {_THREE},
        own as (select p.*, {', '.join(f"(select {_PROBABILITY} from tree_{c} t) as p{c}" for c in range(3))} from classes p),
        shares as (select *, p0 / (p0 + p1 + p2) as s0, p1 / (p0 + p1 + p2) as s1, p2 / (p0 + p1 + p2) as s2 from own)
        select l_orderkey, l_linenumber, l_partkey, cls, case when s0 >= s1 and s0 >= s2 then 0 when s1 >= s2 then 1 else 2 end as predicted,
               round(s0, 9) as prob_class_0, round(s1, 9) as prob_class_1, round(s2, 9) as prob_class_2 from shares""",
    "permutation_rule": f"""
        with {_PERMUTED} select a.metric, a.f as feature, round(max(b.q) - avg(a.q), 9) as importance
        from quality a join quality b on a.metric = b.metric and b.r = -1 where a.r >= 0 group by 1, 2""",
    "isotonic": f"""
        with {_MASTER}, points as (select floor(price / 250) / 1000 as p, sum(y)::double as s, count(*)::double as n from m group by 1), {_ISOTONIC.format('points')}
        select p, round(fitted, 9) as fitted from points_fit""",
    "climate_clusters_separated": """
        select distinct c_nationkey as station_id, min(c_nationkey) over (partition by c_nationkey % 3) as first_of_cluster from orders join customer on o_custkey = c_custkey""",
}
