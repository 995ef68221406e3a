"""Descriptive statistics and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import hash_below, hash_threshold
from millrace.lineage import materialise
from millrace.operators import aggregates as A
from millrace.operators import metrics as M
from millrace.operators import mljobs
from millrace.operators import ranking as R
from millrace.operators import sketches as K
from millrace.operators import stats as Q
from millrace.plans.registry import Tables, query
from millrace.plans.views import FEATURES, feat, plays

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 5) AS mean,
        ROUND(STDDEV_SAMP({c}), 5) AS stddev, MIN({c}) AS min, MAX({c}) AS max FROM lineitem"""
        for c in _MEASURES
    )
)
def describe_long(t: Tables) -> DataFrame:
    out = Q.describe_long(t.lineitem, _MEASURES)
    return out.withColumns({"mean": F.round("mean", 5), "stddev": F.round("stddev", 5)})


_PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


@query(
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS prob, ROUND(quantile_cont(o_totalprice, {p}), 6) AS value FROM orders"
        for p in _PROBS
    )
)
def quantiles_exact(t: Tables) -> DataFrame:
    return Q.quantiles_exact(t.orders, "o_totalprice", _PROBS).withColumn("value", F.round("value", 6))


@query(" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS prob, TRUE AS within" for p in _PROBS))
def quantiles_approx(t: Tables) -> DataFrame:
    """Whether the true rank of each approximate quantile is off by no more than it may be."""
    err, price = 0.05, F.col("o_totalprice")
    found = Q.quantiles(t.orders, "o_totalprice", _PROBS, err).collect()  # one row a probability
    checks = []
    for row in found:
        wanted, slack = F.lit(row["prob"]) * F.count(price), err * F.count(price)
        below, upto = F.count_if(price < row["value"]), F.count_if(price <= row["value"])
        checks.append(F.struct(F.lit(row["prob"]).alias("prob"), wanted.between(below - slack, upto + slack).alias("within")))
    return t.orders.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@query(
    f"""
SELECT 'f' || i AS a, 'f' || j AS b,
       ROUND(CORR(CAST(embedding[i + 1] AS DOUBLE), CAST(embedding[j + 1] AS DOUBLE)), 8) AS corr
FROM embeddings, unnest(range({len(FEATURES)})) AS x(i), unnest(range({len(FEATURES)})) AS y(j)
GROUP BY i, j"""
)
def corr_matrix(t: Tables) -> DataFrame:
    return Q.corr_matrix(feat(t), FEATURES).withColumn("corr", F.round("corr", 8))


@query(
    """
WITH bounds AS (SELECT MIN(o_totalprice) AS low, (MAX(o_totalprice) - MIN(o_totalprice)) / 10 AS width FROM orders),
binned AS (SELECT CAST(LEAST(FLOOR((o_totalprice - low) / width), 9) AS INT) AS bin, low, width FROM orders, bounds)
SELECT bin, ROUND(low + bin * width, 4) AS low, ROUND(low + (bin + 1) * width, 4) AS high, COUNT(*) AS n
FROM binned GROUP BY bin, low, width"""
)
def histogram(t: Tables) -> DataFrame:
    bins = Q.histogram(t.orders, "o_totalprice", 10)
    return bins.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query("SELECT lang, COUNT(*) AS n, ROUND(COUNT(*) / CAST((SELECT COUNT(*) FROM documents) AS DOUBLE), 8) AS share FROM documents GROUP BY lang")
def class_balance(t: Tables) -> DataFrame:
    return Q.class_balance(t.documents, "lang").withColumn("share", F.round("share", 8))


@query(
    """
SELECT COALESCE(flag, '-') AS flag, COUNT(*) AS n
FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag FROM lineitem) f GROUP BY flag"""
)
def flag_audit(t: Tables) -> DataFrame:
    """Rows per quality flag, those without one included."""
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return A.count_by(t.lineitem.select(flag.alias("flag")), "flag").fillna("-", ["flag"])


@query(
    """
WITH joined AS (SELECT o_orderkey, o_custkey, p_name, p_retailprice FROM orders LEFT JOIN part ON p_partkey = o_orderkey)
SELECT 'o_orderkey' AS "column", 'bigint' AS type, COUNT(o_orderkey) AS n_nonnull FROM joined
UNION ALL SELECT 'o_custkey', 'bigint', COUNT(o_custkey) FROM joined
UNION ALL SELECT 'p_name', 'string', COUNT(p_name) FROM joined
UNION ALL SELECT 'p_retailprice', 'double', COUNT(p_retailprice) FROM joined"""
)
def column_profile(t: Tables) -> DataFrame:
    joined = t.orders.join(t.part, F.col("p_partkey") == F.col("o_orderkey"), "left")
    return Q.column_profile(joined.select("o_orderkey", "o_custkey", "p_name", "p_retailprice"))


# ---- classifiers


def _scored_events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / 500).alias("score"),
        (F.col("value") > 100).cast("int").alias("prediction"),
    )


_BINARY_SQL = """
WITH pred AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, CASE WHEN value > 100 THEN 1 ELSE 0 END AS p
  FROM events),
c AS (
  SELECT COUNT(*) AS total, COUNT(*) FILTER (y = 1) AS positive, COUNT(*) FILTER (y = 0) AS negative,
         COUNT(*) FILTER (p = 1) AS predicted_positive, COUNT(*) FILTER (p = 0) AS predicted_negative,
         COUNT(*) FILTER (y = 1 AND p = 1) AS tp, COUNT(*) FILTER (y = 0 AND p = 1) AS fp,
         COUNT(*) FILTER (y = 0 AND p = 0) AS tn, COUNT(*) FILTER (y = 1 AND p = 0) AS fn
  FROM pred)
SELECT *, ROUND(tp / CAST(tp + fp AS DOUBLE), 8) AS "precision", ROUND(tp / CAST(tp + fn AS DOUBLE), 8) AS recall,
       ROUND((tp + tn) / CAST(total AS DOUBLE), 8) AS accuracy,
       ROUND(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 8) AS f1
FROM c"""


@query(_BINARY_SQL)
def binary_metrics(t: Tables) -> DataFrame:
    rates = M.binary_metrics(_scored_events(t))
    return rates.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "accuracy", "f1")})


@query(
    """
WITH pred AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, value / 500 AS score FROM events),
ranks AS (SELECT y, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM pred),
n AS (SELECT CAST(SUM(y) AS DOUBLE) AS p, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS q FROM pred)
SELECT ROUND((SUM(CASE WHEN y = 1 THEN r ELSE 0 END) - MAX(p) * (MAX(p) + 1) / 2) / (MAX(p) * MAX(q)), 7) AS auroc
FROM ranks, n"""
)
def auroc(t: Tables) -> DataFrame:
    return M.auroc(_scored_events(t), "score", "label").withColumn("auroc", F.round("auroc", 7))


@query("SELECT event_id, CASE WHEN value / 500 > 0.4 THEN 1 ELSE 0 END AS custom_prediction FROM events")
def with_threshold(t: Tables) -> DataFrame:
    pred = mljobs.with_threshold(_scored_events(t), 0.4, "score")
    return pred.select("event_id", "custom_prediction")


_TYPES = ["click", "error", "purchase", "signup", "view"]


def _typed_events(t: Tables) -> DataFrame:
    label = F.array_position(F.array(*[F.lit(x) for x in _TYPES]), F.col("event_type")) - 1
    return t.events.select(label.cast("int").alias("label"), (F.col("event_id") % 5).cast("int").alias("prediction"))


_CLASSES_SQL = """
WITH pred AS (
  SELECT list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS label,
         event_id % 5 AS prediction FROM events),
actual AS (SELECT label, COUNT(*) AS n, COUNT(*) FILTER (label = prediction) AS n_hit FROM pred GROUP BY label),
guessed AS (SELECT prediction AS label, COUNT(*) AS n_predicted FROM pred GROUP BY prediction),
classes AS (
  SELECT CAST(label AS INT) AS label, n, n_hit, COALESCE(n_predicted, 0) AS n_predicted,
         n_hit / CAST(n_predicted AS DOUBLE) AS prec, n_hit / CAST(n AS DOUBLE) AS recall,
         2 * n_hit / CAST(n + n_predicted AS DOUBLE) AS f1
  FROM actual LEFT JOIN guessed USING (label))"""


@query(
    _CLASSES_SQL
    + """SELECT label, n, n_hit, n_predicted, ROUND(prec, 8) AS "precision", ROUND(recall, 8) AS recall,
    ROUND(f1, 8) AS f1 FROM classes"""
)
def per_class_metrics(t: Tables) -> DataFrame:
    classes = M.per_class_metrics(_typed_events(t))
    return classes.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    _CLASSES_SQL
    + """SELECT ROUND(SUM(prec * n) / SUM(n), 8) AS weighted_precision, ROUND(SUM(recall * n) / SUM(n), 8) AS weighted_recall,
    ROUND(SUM(f1 * n) / SUM(n), 8) AS weighted_f1, ROUND(SUM(n_hit) / CAST(SUM(n) AS DOUBLE), 8) AS accuracy FROM classes"""
)
def multiclass_summary(t: Tables) -> DataFrame:
    summary = M.multiclass_summary(_typed_events(t))
    return summary.select(*[F.round(c, 8).alias(c) for c in summary.columns])


@query(
    """
SELECT ROUND(SQRT(AVG((o_totalprice - mean) * (o_totalprice - mean))), 5) AS rmse
FROM orders JOIN (SELECT o_custkey, AVG(o_totalprice) AS mean FROM orders GROUP BY o_custkey) m USING (o_custkey)
WHERE o_orderstatus <> 'P'"""
)
def rmse(t: Tables) -> DataFrame:
    """Order prices against the customer's mean; orders of one status have no prediction."""
    means = materialise(A.mean_by(t.orders, ["o_custkey"], "o_totalprice", "prediction"), "means")
    unknown = F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("prediction"))
    scored = t.orders.join(means, "o_custkey").withColumn("prediction", unknown)
    return M.rmse(scored, "o_totalprice", "prediction").withColumn("rmse", F.round("rmse", 5))


# ---- recommendation lists: the items most bought in the customer's nation


def _marked_plays(t: Tables) -> DataFrame:
    in_train = hash_below(["user_id", "item_id"], "r5", 0.7)
    return plays(t).withColumn("in_train", in_train)


def _relevant(marked: DataFrame) -> DataFrame:
    return R.top_k_per_group(marked.filter("NOT in_train"), "user_id", "item_id", "plays", 10, "relevant")


def _lists(t: Tables) -> DataFrame:
    """Per user the recommended and the relevant items."""
    marked = materialise(_marked_plays(t), "marked")
    home = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"))
    popular = (
        marked.filter("in_train").join(home, "user_id").groupBy("nation", "item_id").agg(F.sum("plays").alias("plays"))
    )
    # one row a nation; written, so that the planner knows it is small
    recommended = materialise(R.top_k_per_group(popular, "nation", "item_id", "plays", 10, "recommended"), "popular")
    return (
        _relevant(marked).join(home, "user_id").join(recommended, "nation").select("user_id", "recommended", "relevant")
    )


_LISTS_SQL = f"""
WITH marked AS (
  SELECT *, substring(md5('r5:' || user_id || ':' || item_id), 1, 8) < '{hash_threshold(0.7)}' AS in_train FROM plays),
popular AS (
  SELECT c_nationkey AS nation, item_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY SUM(plays) DESC, item_id) AS rank
  FROM marked JOIN customer ON c_custkey = user_id WHERE in_train GROUP BY c_nationkey, item_id),
ranked AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, item_id) AS rank
  FROM marked WHERE NOT in_train),
relevant AS (SELECT user_id, item_id, rank FROM ranked WHERE rank <= 10),
users AS (SELECT user_id, COUNT(*) AS n_relevant FROM relevant GROUP BY user_id),
hits AS (
  SELECT r.user_id, p.rank, row_number() OVER (PARTITION BY r.user_id ORDER BY p.rank) AS so_far
  FROM relevant r JOIN customer ON c_custkey = r.user_id
  JOIN popular p ON p.nation = c_nationkey AND p.item_id = r.item_id AND p.rank <= 10)"""


@query(f"{_LISTS_SQL} SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS items FROM relevant GROUP BY user_id")
def relevant_items(t: Tables) -> DataFrame:
    top = _relevant(_marked_plays(t))
    return top.select("user_id", F.array_join(F.col("relevant").cast("array<string>"), ",").alias("items"))


@query(
    f"""{_LISTS_SQL}
SELECT ROUND((SELECT COUNT(*) FROM hits WHERE rank <= 5) / 5.0 / (SELECT COUNT(*) FROM users), 8) AS precision_at_5"""
)
def precision_at_5(t: Tables) -> DataFrame:
    return M.precision_at(_lists(t), 5).select(F.round("precision_at_5", 8).alias("precision_at_5"))


@query(
    f"""{_LISTS_SQL},
gains AS (SELECT user_id, SUM(1 / ln(rank + 1)) AS gain FROM hits GROUP BY user_id),
ideals AS (
  SELECT user_id, SUM(1 / ln(rank + 1)) AS ideal FROM relevant GROUP BY user_id)
SELECT ROUND(SUM(COALESCE(gain, 0) / ideal) / COUNT(*), 8) AS ndcg_at_10 FROM ideals LEFT JOIN gains USING (user_id)"""
)
def ndcg_at_10(t: Tables) -> DataFrame:
    return M.ndcg_at(_lists(t), 10).select(F.round("ndcg_at_10", 8).alias("ndcg_at_10"))


@query(
    f"""{_LISTS_SQL},
sums AS (SELECT user_id, SUM(so_far / CAST(rank AS DOUBLE)) AS total FROM hits GROUP BY user_id)
SELECT ROUND(SUM(COALESCE(total, 0) / n_relevant) / COUNT(*), 8) AS map FROM users LEFT JOIN sums USING (user_id)"""
)
def map_score(t: Tables) -> DataFrame:
    return M.mean_average_precision(_lists(t)).select(F.round("map", 8).alias("map"))


_PERIOD = "ts < TIMESTAMP '2024-01-11 00:00:00'"


@query(
    " UNION ALL ".join(
        f"SELECT event_type, CAST({p} AS DOUBLE) AS prob, COUNT(value) AS n, TRUE AS within FROM events WHERE {_PERIOD} GROUP BY event_type"
        for p in (0.1, 0.5, 0.9)
    )
)
def period_quantiles(t: Tables) -> DataFrame:
    """Quantiles of a period from one stored sketch per type and day, and whether their true ranks are within the bound."""
    daily = t.events.withColumn("day", F.to_date("ts"))
    stored = materialise(K.quantile_sketches(daily, ["event_type", "day"], "value"), "sketches")
    found = K.merged_quantiles(stored.where("day < DATE '2024-01-11'"), ["event_type"], [0.1, 0.5, 0.9])
    met = t.events.where(_PERIOD).select("event_type", F.col("value").alias("own")).join(materialise(found, "found"), "event_type")
    ranks = met.groupBy("event_type", "prob", "n").agg(
        F.count_if(F.col("own") < F.col("value")).alias("below"), F.count_if(F.col("own") <= F.col("value")).alias("upto")
    )
    wanted, slack = F.col("prob") * F.col("n"), K.quantile_error() * F.col("n")
    return ranks.select("event_type", "prob", "n", wanted.between(F.col("below") - slack, F.col("upto") + slack).alias("within"))


@query(
    " UNION ALL ".join(
        f"SELECT DISTINCT event_type, '{measure}' AS measure, TRUE AS within FROM events" for measure in ("all", "early", "lost")
    )
)
def period_distinct(t: Tables) -> DataFrame:
    """Users of each type in all days, in the first ten, and in these alone, from stored sets, and whether they are within the bound."""
    daily = t.events.withColumn("day", F.to_date("ts"))
    stored = materialise(K.set_sketches(daily, ["event_type", "day"], ["user_id"]), "sets")
    early = F.col("day") < F.lit("2024-01-11").cast("date")
    sides = stored.groupBy("event_type").agg(
        K.union_of("user_id").alias("all"),
        F.theta_union_agg(F.when(early, F.col("user_id")), K.SET_SIZE).alias("early"),
        F.theta_union_agg(F.when(~early, F.col("user_id")), K.SET_SIZE).alias("late"),
    )
    said = {"all": K.distinct("all"), "early": K.distinct("early"), "lost": K.distinct(K.without("early", "late"))}
    said = sides.select("event_type", *[c.alias(name) for name, c in said.items()])
    seen = daily.groupBy("event_type", "user_id").agg(F.bool_or(early).alias("early"), F.bool_or(~early).alias("late"))
    true = seen.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if("early").alias("n_early"), F.count_if(F.col("early") & ~F.col("late")).alias("n_lost")
    )
    error = 5 * F.col("n_all") / F.lit(2.0 ** (K.SET_SIZE / 2))  # five standard deviations of the largest set
    each = [
        F.struct(F.lit(name).alias("measure"), (F.abs(F.col(name) - F.col(f"n_{name}")) <= error).alias("within"))
        for name in ("all", "early", "lost")
    ]
    return said.join(true, "event_type").select("event_type", F.inline(F.array(*each)))
