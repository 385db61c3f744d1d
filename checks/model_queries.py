"""Master tables, splits, evaluation metrics and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilspark.functions.temporal import Calendar
from perilspark.operators.columns import split_columns
from perilspark.operators.grid import GridSpec
from perilspark.operators.metrics import (
    auc,
    binary_metrics,
    class_count,
    class_shares,
    classification_report,
    ks_statistic,
    label_metrics,
    long_scores,
    metric_by_group,
    metric_rows,
    multiclass_report,
    one_vs_rest,
    precision_at_recall,
    regression_metrics,
    threshold_sweep,
)
from perilspark.operators.ranking import best_trials, quantile_class, rank_trials
from perilspark.operators.split import assign_subsets, backtest_flag, holdout_groups, shuffle_folds, slice_shares
from perilspark.plans.master import FeatureSet, align_features, at_stations, inference_table, station_nodes, training_table

from . import lat_sql, lon_sql, point_lat, point_lon, rounded, table

#: All seasons of the given tables; their first day is 1995-01-01, their last 2001-11-04.
SEASON = Calendar("1995-01-01", "2001-12-31")
GRID = GridSpec.from_bounds(-69.6, -14.7, -65.0, -9.9, 3)
SOURCE_GRID = GridSpec(-69.6, -10, 10, 10, 2)
STEPS = [2, 3, 4]


def _cell(key):
    k = F.col(key)
    return [F.round(-69.6 + (k % 10) * 0.5, 4).alias("lon"), F.round(-10 - (F.floor(k / 10) % 10) * 0.5, 4).alias("lat")]


def _cell_sql(key):
    return f"round(-69.6e0 + ({key} % 10) * 0.5e0, 4) as lon, round(-10e0 - (({key} // 10) % 10) * 0.5e0, 4) as lat"


def feature_sets(spark, folder):
    """Three sets: with leads, daily, and static."""
    items = table(spark, folder, "lineitem").select(*_cell("l_suppkey"), F.to_date("l_shipdate").alias("time"), F.col("l_linenumber").alias("step"), "l_quantity")
    leads = items.groupBy("lon", "lat", "time", "step").agg(F.avg("l_quantity").alias("t2m"))
    orders = table(spark, folder, "orders").select(*_cell("o_custkey"), F.to_date("o_orderdate").alias("time"), "o_totalprice")
    rain = orders.groupBy("lon", "lat", "time").agg(F.round(F.sum("o_totalprice"), 2).alias("tp"))
    static = table(spark, folder, "supplier").select(*_cell("s_suppkey"), "s_acctbal")
    static = static.groupBy("lon", "lat").agg(F.max("s_acctbal").alias("altitude"))
    return [FeatureSet(leads, SOURCE_GRID), FeatureSet(rain, SOURCE_GRID), static]


def stations(spark, folder):
    o = table(spark, folder, "orders")
    keyed = o.select("o_custkey", F.to_date("o_orderdate").alias("time"), "o_totalprice", point_lon("o_custkey").alias("lon"), point_lat("o_custkey").alias("lat"))
    return keyed.groupBy("lon", "lat", "time").agg(
        F.max(F.when(F.col("o_totalprice") % 3 < 2, F.when(F.col("o_totalprice") > 250000, 1).otherwise(0))).alias("target")
    )


def _shown(df):
    out = rounded(df, 6, "t2m")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("month", "week")})


def aligned(spark, folder):
    return _shown(align_features(feature_sets(spark, folder), GRID, SEASON, STEPS))


def master_predict(spark, folder):
    """One forecast day, as the daily run has it; ``align_features`` is the same plan over all days."""
    day = Calendar("1998-02-10", "1998-02-10")
    return _shown(inference_table(feature_sets(spark, folder), GRID, day, STEPS))


def station_extract(spark, folder):
    grid_features = align_features(feature_sets(spark, folder), GRID, SEASON, STEPS)
    return _shown(at_stations(grid_features, station_nodes(stations(spark, folder), GRID)))


def master_train(spark, folder):
    return _shown(training_table(feature_sets(spark, folder), stations(spark, folder), "target", GRID, SEASON, STEPS))


def flag_scores(spark, folder):
    """Line items as predictions: heavily tied and nearly continuous scores."""
    li = table(spark, folder, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", F.to_date("l_shipdate").alias("time"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        (F.col("l_discount") * 10).alias("p_tied"),
        (F.col("l_extendedprice") / 110000).alias("p_fine"),
        F.when(F.year("l_shipdate") >= 2000, "backtest").when(F.col("l_suppkey") % 5 == 0, "out_of_sample").otherwise("train").alias("subset"),
        "l_extendedprice", "l_quantity", "l_tax",
    )


FLAG_SCORES = """
    select l_orderkey, l_linenumber, l_linestatus, l_returnflag, cast(l_shipdate as date) as time,
           case when l_returnflag = 'R' then 1 else 0 end as y, l_discount * 10 as p_tied, l_extendedprice / 110000 as p_fine,
           case when year(l_shipdate) >= 2000 then 'backtest' when l_suppkey % 5 = 0 then 'out_of_sample' else 'train' end as subset,
           l_extendedprice, l_quantity, l_tax from lineitem
"""


def toxic_scores(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return table(spark, folder, "labels").join(docs, "doc_id").select(
        "doc_id", "lang", F.col("toxic").alias("y"), (F.col("n_chars") / (F.col("n_chars") + 2000)).alias("p")
    )


TOXIC_SCORES = """
    select doc_id, lang, toxic as y, n_chars / (n_chars + 2000) as p from labels join documents using (doc_id)
"""


def months(spark, folder):
    o = table(spark, folder, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyyMM").alias("yearmon"), F.when(F.col("o_orderkey") % 17 > 0, F.col("o_totalprice")).alias("value"))


MONTHS = """
    select o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y%m') as yearmon,
           case when o_orderkey % 17 > 0 then o_totalprice end as value from orders
"""


def prepare_subsets(spark, folder):
    out = assign_subsets(months(spark, folder), n_months=12, required=["value"])
    features, descriptive, label = split_columns(out, ["o_orderkey", "yearmon", "subset"], "value")
    return out.select(*descriptive, *features, label)


def grouped_subsets(spark, folder):
    out = assign_subsets(months(spark, folder), 12, group="o_custkey", fraction=0.2, stratify="o_orderpriority", required=["value"])
    return out.select("o_orderkey", "o_custkey", "o_orderpriority", "yearmon", "subset")


def backtest_months(spark, folder):
    m = months(spark, folder)
    return m.withColumn("backtest", backtest_flag(m, "yearmon", n_slices=6).cast("int")).select("o_orderkey", "yearmon", "backtest")


def backtest_fraction(spark, folder):
    m = months(spark, folder)
    return m.withColumn("backtest", backtest_flag(m, "yearmon", frac_slices=0.2).cast("int")).select("o_orderkey", "yearmon", "backtest")


def slice_share(spark, folder):
    return rounded(slice_shares(months(spark, folder), "yearmon"), 9, "share", "cum_share")


def stratified_holdout(spark, folder):
    """The customers held out of each segment."""
    c = table(spark, folder, "customer")
    held = holdout_groups(c, "c_custkey", 0.2, "c_mktsegment")
    return c.join(held, "c_custkey").select("c_mktsegment", "c_custkey")


def group_folds(spark, folder):
    """The months each fold tests on."""
    return shuffle_folds(months(spark, folder), "yearmon", 4, 0.25)


def auc_gini(spark, folder):
    y = F.col("y")
    flags = long_scores(flag_scores(spark, folder), {"tied": (y, F.col("p_tied")), "fine": (y, F.col("p_fine"))}, "score")
    toxic = long_scores(toxic_scores(spark, folder), {"toxic": (y, F.col("p"))}, "score")
    return rounded(auc(flags.unionByName(toxic), "y", "p", ["score"]), 9, "auc", "gini")


def ks(spark, folder):
    y = F.col("y")
    both = long_scores(flag_scores(spark, folder), {"tied": (y, F.col("p_tied")), "fine": (y, F.col("p_fine"))}, "score", ["l_linestatus"])
    return rounded(ks_statistic(both, "y", "p", ["l_linestatus", "score"]), 9, "ks")


def prf(spark, folder):
    s = flag_scores(spark, folder).withColumn("hat", (F.col("p_tied") > 0.5).cast("int"))
    binary = label_metrics(s, "y", "hat", [0, 1], ["subset"]).withColumn("kind", F.lit("binary"))
    three = s.withColumns({"y": F.ascii("l_returnflag") % 3, "hat": F.col("l_linenumber") % 3})
    macro = label_metrics(three, "y", "hat", [0, 1, 2], ["subset"]).withColumn("kind", F.lit("macro"))
    return rounded(binary.unionByName(macro), 9, "precision", "recall", "f1", "jaccard")


def precision_recall(spark, folder):
    s = flag_scores(spark, folder)
    a = precision_at_recall(s, "y", "p_tied", 0.8, ["subset"]).withColumn("recall", F.lit(80))
    b = precision_at_recall(s, "y", "p_fine", 0.25, ["subset"]).withColumn("recall", F.lit(25))
    return rounded(a.unionByName(b), 9, "precision_at_recall")


def regression(spark, folder):
    s = flag_scores(spark, folder).withColumn("hat", F.col("l_quantity") * 1500)
    return rounded(regression_metrics(s, "l_extendedprice", "hat", ["subset"]), 5, "R2", "RMSE", "MAE", "MEAE", "MAXE")


def metrics_by_group(spark, folder):
    m = binary_metrics(flag_scores(spark, folder), "y", "p_fine", ["subset", "l_linestatus"])
    return rounded(metric_rows(m, ["subset", "l_linestatus"], ["AUC", "GINI", "KS", "F1", "REC", "PR"]), 9, "value")


def metric_per_station(spark, folder):
    s = toxic_scores(spark, folder)
    return rounded(metric_by_group(s, "y", "p", ["lang"], "gini"), 7, "metric")


def report(spark, folder):
    names = ["train", "backtest", "out_of_sample"]
    out = classification_report(flag_scores(spark, folder), "y", "p_fine", "subset", names)
    return rounded(out, 6, *names)


def report_multiclass(spark, folder):
    s = flag_scores(spark, folder).withColumns({
        "cls": F.ascii("l_returnflag") % 3, "hat": F.col("l_linenumber") % 3, "p2": F.col("l_tax") * 10, "p1": F.col("l_quantity") / 50})
    names = ["train", "backtest", "out_of_sample"]
    out = multiclass_report(s, "cls", "hat", {0: "p_tied", 1: "p1", 2: "p2"}, "subset", names)
    return rounded(out, 6, *names)


def multiclass_auc(spark, folder):
    s = flag_scores(spark, folder).withColumns({"cls": F.ascii("l_returnflag") % 3, "p2": F.col("l_tax") * 10, "p1": F.col("l_quantity") / 50})
    return rounded(one_vs_rest(s, "cls", {0: "p_fine", 1: "p1", 2: "p2"}), 9, "auc", "gini", "ks")


def sweep(spark, folder):
    out = threshold_sweep(flag_scores(spark, folder), "y", "p_fine", ["subset"], 100)
    return rounded(out, 9, "threshold", "fraction_days", "precision", "recall", "fpr", "fnr")


def sweep_tied(spark, folder):
    out = threshold_sweep(flag_scores(spark, folder), "y", "p_tied", steps=11)
    return rounded(out, 9, "threshold", "fraction_days", "precision", "recall", "fpr", "fnr")


def quantile_classes(spark, folder):
    s = flag_scores(spark, folder)
    out = quantile_class(s, "p_tied", ["l_returnflag"], 20, ["time", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"], "quantile")
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", F.col("quantile").cast("bigint").alias("quantile"))


def _trials(spark, folder):
    c = table(spark, folder, "customer")
    return c.select(
        F.col("c_custkey").alias("trial_number"),
        F.when(F.col("c_custkey") % 11 > 0, F.round(F.col("c_acctbal") / 500)).alias("gap_train_test"),
        F.when(F.col("c_custkey") % 13 > 0, (F.col("c_custkey") * 37 % 97).cast("double")).alias("mean_test_score"),
    )


def trial_ranking(spark, folder):
    out = rank_trials(_trials(spark, folder))
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("rank_dif", "rank_test")})


def best_trial(spark, folder):
    return best_trials(rank_trials(_trials(spark, folder)), 10).select("trial_number", "mean_rank", "mean_test_score")


def class_share(spark, folder):
    return rounded(class_shares(flag_scores(spark, folder), "l_returnflag", ["subset"]), 9, "share")


def class_counts(spark, folder):
    return class_count(flag_scores(spark, folder), "l_returnflag")


QUERIES = {
    "align_features": aligned,
    "master_predict": master_predict,
    "station_extract": station_extract,
    "master_train": master_train,
    "prepare_subsets": prepare_subsets,
    "prepare_subsets_grouped": grouped_subsets,
    "backtest_months": backtest_months,
    "backtest_fraction": backtest_fraction,
    "slice_shares": slice_share,
    "stratified_holdout": stratified_holdout,
    "group_folds": group_folds,
    "auc_gini": auc_gini,
    "ks": ks,
    "prf": prf,
    "precision_at_recall": precision_recall,
    "regression_metrics": regression,
    "metrics_by_group": metrics_by_group,
    "metric_per_station": metric_per_station,
    "classification_report": report,
    "multiclass_report": report_multiclass,
    "multiclass_auc": multiclass_auc,
    "threshold_sweep": sweep,
    "threshold_sweep_tied": sweep_tied,
    "quantile_class": quantile_classes,
    "trial_ranking": trial_ranking,
    "best_trial": best_trial,
    "class_share": class_share,
    "class_count": class_counts,
}

_NODES = "nx as (select round(-69.6e0 + i / 3e0, 6) as t from generate_series(0, 13) a(i)), ny as (select round(-9.9e0 - j / 3e0, 6) as t from generate_series(0, 14) b(j))"


_LINES = {
    "lon": "select round(-69.6e0 + i / 2e0, 6) as s from generate_series(0, 9) a(i)",
    "lat": "select round(-10e0 - i / 2e0, 6) as s from generate_series(0, 9) a(i)",
}


def _placed(name: str, columns: str, known_grid: bool = True) -> str:
    """Nearest regrid of a table, from its grid lines or those it holds."""

    def pairs(axis: str, targets: str) -> str:
        lines = _LINES[axis] if known_grid else f"select distinct {axis} as s from {name}"
        return f"""(select t, s from (select t, s, row_number() over (partition by t order by round(abs(t - s), 9), s desc) as k
             from {targets} cross join ({lines})) where k = 1)"""

    return f"""
        {name}x as {pairs('lon', 'nx')}, {name}y as {pairs('lat', 'ny')},
        {name}g as (select {name}x.t as lon, {name}y.t as lat, {columns} from {name}
             join {name}x on {name}x.s = {name}.lon join {name}y on {name}y.s = {name}.lat)"""


def _features_sql(start: str, end: str) -> str:
    inside = f"time between date '{start}' and date '{end}'"
    ctes = f"""
        {_NODES},
        items as (select {_cell_sql('l_suppkey')}, cast(l_shipdate as date) as time, l_linenumber as step, l_quantity from lineitem),
        steps as (select lon, lat, time, step, avg(l_quantity) as v from items group by 1, 2, 3, 4),
        leads as (select lon, lat, time, avg(v) as t2m from steps where step in (2, 3, 4) and {inside} group by 1, 2, 3),
        rain as (select lon, lat, time, round(sum(o_totalprice), 2) as tp
                 from (select {_cell_sql('o_custkey')}, cast(o_orderdate as date) as time, o_totalprice from orders) where {inside} group by 1, 2, 3),
        {_placed('leads', 'time, t2m')}, {_placed('rain', 'time, tp')}"""
    return ctes + f""",
        static as (select lon, lat, max(s_acctbal) as altitude from (select {_cell_sql('s_suppkey')}, s_acctbal from supplier) group by 1, 2),
        {_placed('static', 'altitude', False)},
        base as (select lon, lat, cast(unnest(generate_series(date '{start}', date '{end}', interval 1 day)) as date) as time, altitude from staticg),
        ab as (select coalesce(a.lon, b.lon) as lon, coalesce(a.lat, b.lat) as lat, coalesce(a.time, b.time) as time, t2m, tp
               from leadsg a full join raing b on a.lon = b.lon and a.lat = b.lat and a.time = b.time),
        feats as (select coalesce(a.lon, b.lon) as lon, coalesce(a.lat, b.lat) as lat, coalesce(a.time, b.time) as time, t2m, tp, altitude
                  from ab a full join base b on a.lon = b.lon and a.lat = b.lat and a.time = b.time)"""


_FEATURES = _features_sql(SEASON.start, SEASON.end)
_TIME = "month(time) as month, weekofyear(time) as week, strftime(time, '%Y%m') as yearmon"
_STATIONS = f"""
    stations as (select lon, lat, time, max(case when o_totalprice % 3 < 2 then case when o_totalprice > 250000 then 1 else 0 end end) as target
        from (select {lon_sql('o_custkey')} as lon, {lat_sql('o_custkey')} as lat, cast(o_orderdate as date) as time, o_totalprice from orders)
        group by 1, 2, 3),
    spots as (select distinct lon, lat,
        round(-69.6e0 + greatest(0, least(13, ceil(round((lon + 69.6e0) * 3, 6) - 0.5))) / 3e0, 6) as nlon,
        round(-9.9e0 - greatest(0, least(14, floor(round((-9.9e0 - lat) * 3, 6) + 0.5))) / 3e0, 6) as nlat from stations)
"""


def curve_sql(source: str, y: str, p: str, keys: str = "1") -> str:
    """CTE chain ending in ``lv``: (k, p, pos, neg, tp, fp, cp, cn, tpos, tneg).

    tp and fp count scores at or above the level, cp and cn at or below.
    """
    return f"""
        lv0 as (select {keys} as k, {p} as p, sum(case when {y} then 1 else 0 end) as pos, sum(case when {y} then 0 else 1 end) as neg
                from {source} group by 1, 2),
        lv as (select *, sum(pos) over (partition by k order by p desc) as tp, sum(neg) over (partition by k order by p desc) as fp,
                      sum(pos) over (partition by k order by p) as cp, sum(neg) over (partition by k order by p) as cn,
                      sum(pos) over (partition by k) as tpos, sum(neg) over (partition by k) as tneg from lv0)"""


_AUC = "sum(pos * (cn - neg + neg / 2e0)) / (max(tpos) * max(tneg))"
_KS = "max(abs(cp / tpos - cn / tneg))"


def _pr(recall: float) -> str:
    return f"coalesce(max(case when tp / tpos >= {recall} then tp / (tp + fp) end), 0)"


_F1 = "2 * sum(case when p > 0.5 then pos else 0 end) / (sum(pos) + sum(case when p > 0.5 then pos + neg else 0 end))"
_REC = "sum(case when p > 0.5 then pos else 0 end) / sum(pos)"
_KEYED = "subset || '|' || l_linestatus"


def _auc_part(name: str, source: str, p: str) -> str:
    return f"select '{name}' as score, round(a, 9) as auc, round(2 * a - 1, 9) as gini from (with src as ({source}), {curve_sql('src', 'y = 1', p)} select {_AUC} as a from lv)"


def _ks_part(name: str, p: str) -> str:
    return f"select '{name}' as score, k as l_linestatus, round(ks, 9) as ks from (with src as ({FLAG_SCORES}), {curve_sql('src', 'y = 1', p, 'l_linestatus')} select k, {_KS} as ks from lv group by k)"


def _confusion(classes, used, kind: str) -> str:
    def avg(f):
        return "(" + " + ".join(f(f"sum((y = {c} and hat = {c})::int)", f"sum((y <> {c} and hat = {c})::int)", f"sum((y = {c} and hat <> {c})::int)") for c in used) + f") / {len(used)}"

    q = lambda n, d: f"coalesce(({n}) / nullif({d}, 0), 0)"
    return f"""select subset, '{kind}' as kind, round({avg(lambda t, f, m: q(t, f'{t} + {f}'))}, 9) as precision,
        round({avg(lambda t, f, m: q(t, f'{t} + {m}'))}, 9) as recall, round({avg(lambda t, f, m: q(f'2 * {t}', f'2 * {t} + {f} + {m}'))}, 9) as f1,
        round({avg(lambda t, f, m: q(t, f'{t} + {f} + {m}'))}, 9) as jaccard"""


def _pivot(metrics: dict[str, str], source: str) -> str:
    names = ["train", "backtest", "out_of_sample"]
    return " union all ".join(
        f"select '{m}' as metric, " + ", ".join(f"round(max(case when subset = '{n}' then {e} end), 6) as {n}" for n in names) + f" from {source}"
        for m, e in metrics.items()
    )


_ONE_VS_REST = """
    src as (select *, ascii(l_returnflag) % 3 as cls, l_linenumber % 3 as hat, l_tax * 10 as p2, l_quantity / 50 as p1 from ({0})),
    long as (select subset, 0 as c, cls = 0 as y, {1} as p from src union all select subset, 1, cls = 1, p1 from src
             union all select subset, 2, cls = 2, p2 from src)
"""


def _sweep_sql(p: str, keys: str, steps: int) -> str:
    t = f"case when i = {steps - 1} then 1e0 else i * (1e0 / {steps - 1}) end"
    group = f"{keys}, " if keys else ""
    return f"""
        with src as ({FLAG_SCORES}), t as (select {t} as threshold from generate_series(0, {steps - 1}) g(i)),
        c as (select {group}threshold, count(*) as n, sum((y = 1 and {p} > threshold)::int) as tp, sum((y = 0 and {p} > threshold)::int) as fp,
                     sum((y = 0 and not {p} > threshold)::int) as tn, sum((y = 1 and not {p} > threshold)::int) as fn
              from src cross join t group by all)
        select {group}round(threshold, 9) as threshold, round((tp + fp) / n, 9) as fraction_days,
               round(coalesce(tp / nullif(tp + fp, 0), 0), 9) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) as recall,
               round(coalesce(fp / nullif(fp + tn, 0), 0), 9) as fpr, round(coalesce(fn / nullif(fn + tp, 0), 0), 9) as fnr,
               cast(tp as bigint) as "TP", cast(fp as bigint) as "FP", cast(tn as bigint) as "TN", cast(fn as bigint) as "FN" from c"""


_TRIALS = """
    t as (select c_custkey as trial_number, case when c_custkey % 11 > 0 then round(c_acctbal / 500) end as gap_train_test,
                 case when c_custkey % 13 > 0 then cast(c_custkey * 37 % 97 as double) end as mean_test_score from customer),
    ranked as (select *, dense_rank() over (order by gap_train_test nulls last) as rank_dif,
                      dense_rank() over (order by mean_test_score desc nulls last) as rank_test from t),
    done as (select *, (rank_dif + rank_test) / 2 as mean_rank from ranked)
"""
_CUM = "with m as ({0}), c as (select yearmon, count(*) as n from m group by 1), s as (select yearmon, n, n / sum(n) over () as share, sum(n) over (order by yearmon desc) / sum(n) over () as cum_share from c)".format(MONTHS)



def held_sql(source: str, group: str, stratum: str, fraction: str = "0.2e0") -> str:
    """CTEs ending in ``held``: groups held out, the share rounded up over all, parts by largest remainder."""
    return f"""
        g as (select distinct {group}, {stratum} from {source}),
        g1 as (select *, row_number() over (partition by {stratum} order by md5(concat_ws('|', {group}, 42)), {group}) as r from g),
        sizes as (select {stratum}, count(*) as n, sum(count(*)) over () as total from g group by 1),
        wanted as (select *, ceil(round(total * {fraction}, 9)) as out_all, n * ceil(round(total * {fraction}, 9)) / total as exact from sizes),
        parts as (select *, floor(round(exact, 9)) as q, round(exact - floor(round(exact, 9)), 9) as rest from wanted),
        quota as (select {stratum}, q + case when row_number() over (order by rest desc, {stratum}) <= out_all - sum(q) over () then 1 else 0 end as q from parts),
        held as (select g1.* from g1 join quota using ({stratum}) where r <= q)"""


ORACLES = {
    "align_features": f"with {_FEATURES} select lon, lat, time, round(t2m, 6) as t2m, tp, altitude, {_TIME} from feats",
    "master_predict": f"with {_features_sql('1998-02-10', '1998-02-10')} select lon, lat, time, round(t2m, 6) as t2m, tp, altitude, {_TIME} from feats",
    "station_extract": f"""
        with {_FEATURES}, {_STATIONS}
        select spots.lon, spots.lat, time, round(t2m, 6) as t2m, tp, altitude, {_TIME} from spots join feats on feats.lon = nlon and feats.lat = nlat""",
    "master_train": f"""
        with {_FEATURES}, {_STATIONS}
        select s.lon, s.lat, s.time, round(t2m, 6) as t2m, tp, altitude, {_TIME.replace('time)', 's.time)').replace('(time,', '(s.time,')}, target
        from stations s join spots on spots.lon = s.lon and spots.lat = s.lat
        join feats on feats.lon = nlon and feats.lat = nlat and feats.time = s.time where target is not null""",
    "prepare_subsets": f"""
        with m as ({MONTHS}), kept as (select * from m where value is not null),
        late as (select distinct yearmon from kept order by 1 desc limit 12)
        select o_orderkey, yearmon, case when yearmon in (select yearmon from late) then 'backtest' else 'train' end as subset,
               o_custkey, o_orderpriority, value from kept""",
    "backtest_months": f"""
        with m as ({MONTHS}), late as (select distinct yearmon from m order by 1 desc limit 6)
        select o_orderkey, yearmon, case when yearmon in (select yearmon from late) then 1 else 0 end as backtest from m""",
    "backtest_fraction": f"""
        {_CUM} select o_orderkey, m.yearmon, case when cum_share < 0.2 then 1 else 0 end as backtest from m join s on s.yearmon = m.yearmon""",
    "slice_shares": f"{_CUM} select yearmon, n, round(share, 9) as share, round(cum_share, 9) as cum_share from s",
    "stratified_holdout": f"with {held_sql('customer', 'c_custkey', 'c_mktsegment')} select c_mktsegment, c_custkey from held",
    "prepare_subsets_grouped": f"""
        with m as (select * from ({MONTHS}) where value is not null), {held_sql('m', 'o_custkey', 'o_orderpriority')},
        late as (select distinct yearmon from m where o_custkey not in (select o_custkey from held) order by 1 desc limit 12)
        select o_orderkey, o_custkey, o_orderpriority, yearmon, case when o_custkey in (select o_custkey from held) then 'out_of_sample'
               when yearmon in (select yearmon from late) then 'backtest' else 'train' end as subset from m""",
    "group_folds": f"""
        select cast(fold as int) as fold, yearmon from (
            select fold, yearmon, row_number() over (partition by fold order by md5(concat_ws('|', yearmon, fold, 42)), yearmon) as r, count(*) over (partition by fold) as n
            from (select distinct yearmon from ({MONTHS})), generate_series(0, 3) g(fold)) where r <= ceil(n * 0.25e0)""",
    "auc_gini": " union all ".join([
        _auc_part("tied", FLAG_SCORES, "p_tied"), _auc_part("fine", FLAG_SCORES, "p_fine"), _auc_part("toxic", TOXIC_SCORES, "p")]),
    "ks": f"{_ks_part('tied', 'p_tied')} union all {_ks_part('fine', 'p_fine')}",
    "prf": f"""
        with s as ({FLAG_SCORES}), a as (select subset, y, (p_tied > 0.5)::int as hat from s),
        b as (select subset, ascii(l_returnflag) % 3 as y, l_linenumber % 3 as hat from s)
        {_confusion((0, 1), (1,), 'binary')} from a group by subset union all {_confusion((0, 1, 2), (0, 1, 2), 'macro')} from b group by subset""",
    "precision_at_recall": " union all ".join(
        f"select k as subset, {int(r * 100)} as recall, round(v, 9) as precision_at_recall from (with src as ({FLAG_SCORES}), {curve_sql('src', 'y = 1', p, 'subset')} select k, {_pr(r)} as v from lv group by k)"
        for p, r in (("p_tied", 0.8), ("p_fine", 0.25))),
    "regression_metrics": f"""
        with s as (select subset, l_extendedprice as y, l_quantity * 1500 as hat from ({FLAG_SCORES}))
        select subset, round(1 - avg((y - hat) * (y - hat)) / var_pop(y), 5) as "R2", round(sqrt(avg((y - hat) * (y - hat))), 5) as "RMSE",
               round(avg(abs(y - hat)), 5) as "MAE", round(median(abs(y - hat)), 5) as "MEAE", round(max(abs(y - hat)), 5) as "MAXE"
        from s group by 1""",
    "metrics_by_group": f"""
        with src as ({FLAG_SCORES}), {curve_sql('src', 'y = 1', 'p_fine', _KEYED)},
        m as (select k, {_AUC} as auc, {_KS} as ks, {_F1} as f1, {_REC} as rec, {_pr(0.25)} as pr from lv group by k),
        r as (select k, 'AUC' as metric, auc as v from m union all select k, 'GINI', 2 * auc - 1 from m union all select k, 'KS', ks from m
              union all select k, 'F1', f1 from m union all select k, 'REC', rec from m union all select k, 'PR', pr from m)
        select split_part(k, '|', 1) as subset, split_part(k, '|', 2) as l_linestatus, metric, round(v, 9) as value from r""",
    "metric_per_station": f"""
        with src as ({TOXIC_SCORES}), {curve_sql('src', 'y = 1', 'p', 'lang')}
        select k as lang, round((2 * sum(pos * (cn - neg + neg / 2e0)) / nullif(max(tpos) * max(tneg), 0) - 1) * 100, 7) as metric from lv group by k""",
    "classification_report": f"""
        with src as ({FLAG_SCORES}), {curve_sql('src', 'y = 1', 'p_fine', 'subset')},
        m as (select k as subset, round({_AUC}, 4) * 100 as auc, round({_KS}, 4) * 100 as ks, round({_F1}, 4) * 100 as f1,
                     round({_REC}, 4) * 100 as rec, round({_pr(0.25)} * 100) as pr from lv group by k)
        {_pivot({'AUC': 'auc', 'GINI': '2 * auc - 100', 'KS': 'ks', 'F1': 'f1', 'REC': 'rec', 'PR': 'pr'}, 'm')}""",
    "multiclass_report": f"""
        with {_ONE_VS_REST.format(FLAG_SCORES, 'p_tied')}, {curve_sql('long', 'y', 'p', "subset || '|' || c")},
        per as (select split_part(k, '|', 1) as subset, {_AUC} as auc, {_KS} as ks from lv group by k),
        cur as (select subset, avg(auc) as auc, avg(ks) as ks from per group by 1),
        lab as (select subset, precision, recall, f1, jaccard from (
            {_confusion((0, 1, 2), (0, 1, 2), 'macro')} from (select subset, cls as y, hat from src) group by subset)),
        m as (select subset, round(auc, 4) * 100 as auc, round(ks, 4) * 100 as ks, round(precision, 4) * 100 as pr, round(recall, 4) * 100 as rec,
                     round(f1, 4) * 100 as f1, round(jaccard, 4) * 100 as ja from cur join lab using (subset))
        {_pivot({'AUC': 'auc', 'GINI': '2 * auc - 100', 'KS': 'ks', 'PREC': 'pr', 'RECALL': 'rec', 'F1': 'f1', 'JACCARD': 'ja'}, 'm')}""",
    "multiclass_auc": f"""
        with {_ONE_VS_REST.format(FLAG_SCORES, 'p_fine')}, {curve_sql('long', 'y', 'p', 'c')},
        per as (select {_AUC} as auc, {_KS} as ks from lv group by k)
        select round(avg(auc), 9) as auc, round(avg(2 * auc - 1), 9) as gini, round(avg(ks), 9) as ks from per""",
    "threshold_sweep": _sweep_sql("p_fine", "subset", 100),
    "threshold_sweep_tied": _sweep_sql("p_tied", "", 11),
    "quantile_class": f"""
        with s as ({FLAG_SCORES}), r as (
            select *, row_number() over (partition by l_returnflag order by p_tied desc, time, l_orderkey, l_linenumber, l_extendedprice, l_quantity) as r,
                   count(*) over (partition by l_returnflag) as n from s)
        select l_orderkey, l_linenumber, l_returnflag, l_extendedprice, cast(greatest(1, ceil((r - 1) * 20 / (n - 1))) as bigint) as quantile from r""",
    "trial_ranking": f"with {_TRIALS} select * from done",
    "best_trial": f"with {_TRIALS} select trial_number, mean_rank, mean_test_score from done order by mean_rank, mean_test_score nulls first, trial_number limit 10",
    "class_share": f"""
        with s as ({FLAG_SCORES}) select subset, l_returnflag, count(*) as n, round(count(*) / sum(count(*)) over (partition by subset), 9) as share
        from s group by 1, 2""",
    "class_count": "select count(distinct l_returnflag) as n_classes from lineitem",
}
