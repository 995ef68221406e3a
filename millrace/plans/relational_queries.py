"""Projections, filters, joins, aggregates, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.lineage import materialise
from millrace.operators import aggregates as A
from millrace.operators import filters as P
from millrace.operators import heavy as H
from millrace.operators import joins as J
from millrace.operators import ranking as R
from millrace.plans.registry import Tables, query
from millrace.plans.views import CORE, edges, inventory, nodes, obs, plays, stations
from millrace.sources.tables import first_n

# ---- projection and filters


@query("SELECT event_id, user_id, event_type FROM events")
def select_except(t: Tables) -> DataFrame:
    return P.select_except(t.events, ["ts", "props", "value"])


@query("SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_by_type(t: Tables) -> DataFrame:
    return P.select_by_type(t.lineitem, ["double"])


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def select_all_but_last(t: Tables) -> DataFrame:
    return P.select_all_but_last(t.supplier)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'")
def where_not_equal(t: Tables) -> DataFrame:
    return P.where_equal(t.orders, "o_orderstatus", "F", negate=True).select("o_orderkey", "o_custkey")


@query("SELECT * FROM inventory WHERE 20240115 BETWEEN first_day AND last_day AND element = 'view'")
def active_in_period(t: Tables) -> DataFrame:
    return P.where_equal(P.active_in(inventory(t), "first_day", "last_day", 20240115), "element", "view")


@query("SELECT id, day, element, value FROM obs WHERE element IN ('click', 'view', 'purchase')")
def core_only(t: Tables) -> DataFrame:
    return P.where_in(obs(t), "element", CORE)


@query("SELECT id, day, element, value FROM obs WHERE element NOT IN ('click', 'view', 'purchase')")
def core_excluded(t: Tables) -> DataFrame:
    return P.where_in(obs(t), "element", CORE, negate=True)


_FLAGS_SQL = """
WITH flagged AS (
  SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'b' ELSE '' END AS brand_flag,
         CASE WHEN p_type = 'PROMO' THEN 'p' END AS promo_flag
  FROM part)
SELECT 'all' AS mode, p_partkey FROM flagged WHERE brand_flag <> '' AND promo_flag <> ''
UNION ALL
SELECT 'any' AS mode, p_partkey FROM flagged WHERE brand_flag <> '' OR promo_flag <> ''"""


@query(_FLAGS_SQL)
def flag_combos(t: Tables) -> DataFrame:
    flagged = t.part.select(
        "p_partkey",
        F.when(F.col("p_brand").like("Brand#1%"), "b").otherwise("").alias("brand_flag"),
        F.when(F.col("p_type") == "PROMO", "p").alias("promo_flag"),
    )
    flags = ["brand_flag", "promo_flag"]
    return J.union_all(
        [P.where_flags(flagged, flags, mode).select(F.lit(mode).alias("mode"), "p_partkey") for mode in ("all", "any")]
    )


@query("SELECT id, latitude FROM stations WHERE latitude < 0")
def southern_stations(t: Tables) -> DataFrame:
    return P.where_sign(stations(t), "latitude", -1).select("id", "latitude")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE '%HOLD%'")
def name_like(t: Tables) -> DataFrame:
    return P.where_like(t.customer, "c_mktsegment", "%HOLD%").select("c_custkey", "c_mktsegment")


_MISSING_SQL = """
WITH joined AS (
  SELECT id, CASE WHEN p.p_partkey IS NULL OR p.p_type = 'PROMO' THEN '' ELSE p.p_name END AS label,
         CASE WHEN p.p_type = 'SMALL' THEN CAST('NaN' AS DOUBLE) ELSE p.p_retailprice END AS price
  FROM (SELECT o_orderkey AS id FROM orders) o LEFT JOIN part p ON p.p_partkey = o.id)
SELECT id, label = '' AS label_missing, price IS NULL OR isnan(price) AS price_missing FROM joined
WHERE label = '' OR price IS NULL OR isnan(price)"""


@query(_MISSING_SQL)
def missing_filters(t: Tables) -> DataFrame:
    """Keys beyond the dimension give null, some types the empty string or NaN."""
    ids = t.orders.select(F.col("o_orderkey").alias("id"))
    joined = ids.join(t.part, F.col("p_partkey") == F.col("id"), "left").select(
        "id",
        F.when(F.col("p_partkey").isNull() | (F.col("p_type") == "PROMO"), "").otherwise(F.col("p_name")).alias("label"),
        F.when(F.col("p_type") == "SMALL", float("nan")).otherwise(F.col("p_retailprice")).alias("price"),
    )
    label, price = C.is_missing(joined, "label"), C.is_missing(joined, "price")
    return joined.filter(label | price).select("id", label.alias("label_missing"), price.alias("price_missing"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label FROM documents")
def label_binary(t: Tables) -> DataFrame:
    return P.case_column(t.documents, "label", [(F.col("lang") == "en", 1)], 0).select("doc_id", "label")


@query(
    """
SELECT DISTINCT s_suppkey AS carrier_id, s_name AS carrier_name
FROM edges JOIN supplier ON s_suppkey = carrier_id WHERE src_id = 3 OR dst_id = 3"""
)
def carriers_serving(t: Tables) -> DataFrame:
    carriers = t.supplier.select(F.col("s_suppkey").alias("carrier_id"), F.col("s_name").alias("carrier_name"))
    return J.serving(edges(t), carriers, 3, "src_id", "dst_id", "carrier_id", "carrier_name")


# ---- joins


@query(
    """
SELECT c_custkey, c_name, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""
)
def lookup_nation_region(t: Tables) -> DataFrame:
    with_nation = J.lookup(
        t.customer, t.nation, "c_nationkey", "n_nationkey", {"n_name": "nation", "n_regionkey": "region_key"}
    )
    return J.lookup(with_nation, t.region, "region_key", "r_regionkey", {"r_name": "region"}).select(
        "c_custkey", "c_name", "nation", "region"
    )


@query(
    """
WITH users AS (SELECT DISTINCT id FROM obs),
counts AS (
  SELECT id, COUNT(DISTINCT element) AS n_elements,
         COUNT(DISTINCT CASE WHEN element IN ('click', 'view', 'purchase') THEN element END) AS n_core
  FROM inventory GROUP BY id),
span AS (SELECT id, MIN(first_day) AS first_day, MAX(last_day) AS last_day FROM inventory GROUP BY id)
SELECT id, COALESCE(n_elements, 0) AS n_elements, COALESCE(n_core, 0) AS n_core,
       COALESCE(n_elements - n_core, 0) AS n_other, COALESCE(first_day, 0) AS first_day,
       COALESCE(last_day, 0) AS last_day
FROM users LEFT JOIN counts USING (id) LEFT JOIN span USING (id)"""
)
def enrich_users(t: Tables) -> DataFrame:
    users = A.distinct_keys(obs(t), ["id"])
    held = materialise(inventory(t), "inventory")
    counts = A.element_counts(held, "id", "element", CORE)
    return J.enrich(users, counts, A.active_span(held, "id", "first_day", "last_day"), on="id").fillna(0)


@query(
    """
SELECT n_nationkey, n_name, COUNT(c_custkey) AS n_customers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING'
GROUP BY n_nationkey, n_name"""
)
def count_into_dim(t: Tables) -> DataFrame:
    builders = P.where_equal(t.customer, "c_mktsegment", "BUILDING")
    return J.count_into(t.nation, builders, "n_nationkey", "c_nationkey", "n_customers").select(
        "n_nationkey", "n_name", "n_customers"
    )


def _parts(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("l_partkey"), "p_brand")


_FACT = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"]


@query(
    """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, p_brand
FROM lineitem JOIN part ON p_partkey = l_partkey AND p_type = 'PROMO'"""
)
def fact_inner_dim(t: Tables) -> DataFrame:
    return J.join_dim(t.lineitem.select(*_FACT), _parts(t), "l_partkey")


@query(
    """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, COALESCE(p_brand, '-') AS p_brand
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_type = 'PROMO'"""
)
def fact_left_dim(t: Tables) -> DataFrame:
    return J.join_dim(t.lineitem.select(*_FACT), _parts(t), "l_partkey", "left").fillna("-", ["p_brand"])


@query(
    """
SELECT p_brand, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN part ON p_partkey = l_partkey AND p_type = 'PROMO' GROUP BY p_brand"""
)
def fact_broadcast_dim(t: Tables) -> DataFrame:
    joined = J.join_dim(t.lineitem.select("l_partkey", "l_quantity"), _parts(t), "l_partkey", broadcast=True)
    return joined.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query(
    """
WITH rejected AS (SELECT DISTINCT l_partkey AS item_id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50),
accepted AS (SELECT p_partkey AS item_id FROM part WHERE p_brand = 'Brand#17')
SELECT user_id, item_id, plays FROM plays
WHERE item_id NOT IN (SELECT item_id FROM rejected WHERE item_id NOT IN (SELECT item_id FROM accepted))"""
)
def drop_rejected(t: Tables) -> DataFrame:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    rejected = t.lineitem.filter(returned).select(F.col("l_partkey").alias("item_id"))
    accepted = t.part.filter(F.col("p_brand") == "Brand#17").select(F.col("p_partkey").alias("item_id"))
    return J.drop_rejected(plays(t), rejected, accepted, ["item_id"])


@query(
    f"""
SELECT event_id, event_type FROM events
WHERE NOT substring(md5('split:' || event_id), 1, 8) < '{C.hash_threshold(0.8)}'"""
)
def split_complement(t: Tables) -> DataFrame:
    part = t.events.filter(C.hash_below("event_id", "split", 0.8))
    return J.complement(t.events.select("event_id", "event_type"), part, "event_id")


@query(
    """
SELECT user_id, item_id, plays FROM plays
WHERE user_id IN (SELECT user_id FROM plays GROUP BY user_id HAVING COUNT(*) > 40)"""
)
def semi_keep(t: Tables) -> DataFrame:
    rows = materialise(plays(t), "plays")
    active = A.activity(rows, "user_id", "item_id", "plays", "n_items", "total").filter(F.col("n_items") > 40)
    return J.keep_matching(rows, active, "user_id")


@query(
    """
SELECT carrier_id, COUNT(*) AS n_edges, CAST(SUM(s.latitude - d.latitude) AS BIGINT) AS southward
FROM edges JOIN nodes s ON s.node_id = src_id JOIN nodes d ON d.node_id = dst_id
WHERE s.latitude > d.latitude GROUP BY carrier_id"""
)
def edge_endpoints(t: Tables) -> DataFrame:
    ends = J.edge_endpoints(edges(t), nodes(t), "src_id", "dst_id", "node_id", ["latitude"])
    south = F.col("src_latitude") - F.col("dst_latitude")
    return (
        ends.filter(south > 0)
        .groupBy("carrier_id")
        .agg(F.count(F.lit(1)).alias("n_edges"), F.sum(south).cast("bigint").alias("southward"))
    )


def _big_spenders(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))


_MISSING_KEYS_SQL = """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 450000"""


@query(_MISSING_KEYS_SQL)
def missing_keys_join(t: Tables) -> DataFrame:
    return J.missing_keys(t.customer, _big_spenders(t), "c_custkey", via="join")


@query(_MISSING_KEYS_SQL)
def missing_keys_except(t: Tables) -> DataFrame:
    return J.missing_keys(t.customer, _big_spenders(t), "c_custkey", via="except")


@query(
    """
WITH named AS (
  SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'The ' || n_name ELSE n_name END AS place
  FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, place, COALESCE(a.n_regionkey, b.n_regionkey) AS region_key
FROM named LEFT JOIN nation a ON a.n_name = place
LEFT JOIN nation b ON CAST(b.n_nationkey AS VARCHAR) = code"""
)
def lookup_with_fallback(t: Tables) -> DataFrame:
    """The place names of one segment are spelt differently and found by code instead."""
    nation = t.nation.withColumn("code", F.col("n_nationkey").cast("string"))
    named = J.lookup(t.customer, t.nation, "c_nationkey", "n_nationkey", {"n_name": "place"}).select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("code"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("The "), "place")).otherwise(F.col("place")).alias("place"),
    )
    found = J.lookup_with_fallback(named, nation, [("place", "n_name"), ("code", "code")], "n_regionkey", "region_key")
    return found.select("c_custkey", "place", "region_key")


# ---- aggregates


@query("SELECT COUNT(*) AS n FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return A.row_count(t.lineitem)


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def count_by_type(t: Tables) -> DataFrame:
    return A.count_by(t.events, "event_type")


@query("SELECT id, MIN(first_day) AS first_day, MAX(last_day) AS last_day FROM inventory GROUP BY id")
def active_span(t: Tables) -> DataFrame:
    return A.active_span(inventory(t), "id", "first_day", "last_day")


_COUNTS_SQL = """
SELECT id, COUNT(DISTINCT element) AS n_elements,
       COUNT(DISTINCT CASE WHEN element IN ('click', 'view', 'purchase') THEN element END) AS n_core,
       COUNT(DISTINCT CASE WHEN element NOT IN ('click', 'view', 'purchase') THEN element END) AS n_other
FROM inventory GROUP BY id"""


@query(_COUNTS_SQL)
def element_counts(t: Tables) -> DataFrame:
    return A.element_counts(inventory(t), "id", "element", CORE)


@query(f"SELECT * FROM ({_COUNTS_SQL}) counts WHERE n_core = 3")
def full_core(t: Tables) -> DataFrame:
    return A.full_core(A.element_counts(inventory(t), "id", "element", CORE), CORE)


@query(
    """
SELECT 'core' AS test, id FROM inventory WHERE element IN ('click', 'view', 'purchase')
GROUP BY id HAVING MIN(element) = 'view' AND MAX(element) = 'view'
UNION ALL
SELECT 'all' AS test, id FROM inventory GROUP BY id HAVING MIN(element) = 'view' AND MAX(element) = 'view'"""
)
def only_x(t: Tables) -> DataFrame:
    held = materialise(inventory(t), "inventory")
    return J.union_all(
        [
            A.only_core(held, "id", "element", CORE, "view").select(F.lit("core").alias("test"), "id"),
            A.only(held, "id", "element", "view").select(F.lit("all").alias("test"), "id"),
        ]
    )


@query(
    """
SELECT o_orderpriority, COUNT(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS n
FROM orders GROUP BY o_orderpriority"""
)
def count_nonnull(t: Tables) -> DataFrame:
    finished = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return A.count_nonnull(t.orders.withColumn("finished_price", finished), ["o_orderpriority"], "finished_price")


def _yearly(t: Tables) -> DataFrame:
    return edges(t).select(F.year("shipdate").alias("year"), "dst_id", "quantity")


@query(
    """
SELECT CAST(YEAR(shipdate) AS INT) AS year, dst_id, ROUND(AVG(quantity), 6) AS mean
FROM edges GROUP BY 1, 2"""
)
def mean_by_year_group(t: Tables) -> DataFrame:
    return A.mean_by(_yearly(t), ["year", "dst_id"], "quantity").withColumn("mean", F.round("mean", 6))


@query(
    """
SELECT dst_id, ROUND(AVG(mean), 6) AS mean FROM (
  SELECT YEAR(shipdate) AS year, dst_id, AVG(quantity) AS mean FROM edges GROUP BY 1, 2) yearly
GROUP BY dst_id"""
)
def mean_of_means(t: Tables) -> DataFrame:
    means = A.mean_of_means(_yearly(t), ["year"], ["dst_id"], "quantity")
    return means.withColumn("mean", F.round("mean", 6))


@query(
    """
SELECT id, day FROM obs GROUP BY id, day
HAVING SUM(CASE WHEN element = 'click' THEN 1 ELSE 0 END) > 0
   AND SUM(CASE WHEN element = 'view' THEN 1 ELSE 0 END) = 0"""
)
def has_without(t: Tables) -> DataFrame:
    return A.has_without(obs(t), ["id", "day"], "element", "click", "view")


@query("SELECT COUNT(DISTINCT user_id) AS n_user_id, COUNT(DISTINCT item_id) AS n_item_id FROM plays")
def distinct_two(t: Tables) -> DataFrame:
    return A.distinct_counts(plays(t), ["user_id", "item_id"])


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_keys(t: Tables) -> DataFrame:
    return A.distinct_keys(t.orders, ["o_custkey", "o_orderstatus"])


@query("SELECT DISTINCT text, lang FROM documents")
def full_dedupe(t: Tables) -> DataFrame:
    return A.dedupe(t.documents.select("text", "lang"))


@query("SELECT user_id, COUNT(item_id) AS song_count, CAST(SUM(plays) AS BIGINT) AS play_count FROM plays GROUP BY user_id")
def user_activity(t: Tables) -> DataFrame:
    return A.activity(plays(t), "user_id", "item_id", "plays", "song_count", "play_count")


@query("SELECT item_id, COUNT(user_id) AS user_count, CAST(SUM(plays) AS BIGINT) AS play_count FROM plays GROUP BY item_id")
def item_activity(t: Tables) -> DataFrame:
    return A.activity(plays(t), "item_id", "user_id", "plays", "user_count", "play_count")


@query(
    """
SELECT CAST(MIN(YEAR(l_shipdate)) AS INT) AS first_year, CAST(MAX(YEAR(l_shipdate)) AS INT) AS last_year,
       COUNT(DISTINCT YEAR(l_shipdate)) AS n_years FROM lineitem"""
)
def year_coverage(t: Tables) -> DataFrame:
    return A.year_coverage(t.lineitem, "l_shipdate")


@query("SELECT DISTINCT l_returnflag, l_discount FROM lineitem")
def set_per_class(t: Tables) -> DataFrame:
    return A.values_per_group(t.lineitem, "l_returnflag", "l_discount")


@query(
    """
SELECT src_id, node_name, COUNT(dst_id) AS n_edges
FROM edges LEFT JOIN nodes ON node_id = src_id GROUP BY src_id, node_name"""
)
def top_by_edges(t: Tables) -> DataFrame:
    return A.top_by_edges(edges(t), nodes(t), "src_id", "dst_id", "node_id", "node_name")


_TOP_SQL = """
SELECT src_id, node_name, n_edges
FROM (SELECT src_id, COUNT(dst_id) AS n_edges FROM edges GROUP BY src_id) counts
LEFT JOIN nodes ON node_id = src_id ORDER BY n_edges DESC, src_id"""


@query(_TOP_SQL)
def top_by_edges_sql(t: Tables) -> DataFrame:
    """The same question put in SQL over frames."""
    text = _TOP_SQL.replace("FROM edges", "FROM {edges}").replace("JOIN nodes", "JOIN {nodes}")
    return t.spark.sql(text, edges=edges(t), nodes=nodes(t))


@query(
    """
SELECT carrier_id, s_name, COUNT(dst_id) AS n_edges
FROM edges LEFT JOIN supplier ON s_suppkey = carrier_id
GROUP BY carrier_id, s_name ORDER BY n_edges DESC, carrier_id LIMIT 10"""
)
def top_carriers(t: Tables) -> DataFrame:
    return A.top_by_edges(edges(t), t.supplier, "carrier_id", "dst_id", "s_suppkey", "s_name", 10)


@query(
    """
SELECT carrier_id, s_name, COUNT(DISTINCT dst_id) AS n_reached
FROM edges LEFT JOIN supplier ON s_suppkey = carrier_id
GROUP BY carrier_id, s_name ORDER BY n_reached DESC, carrier_id LIMIT 10"""
)
def top_by_reach(t: Tables) -> DataFrame:
    return A.top_by_reach(edges(t), t.supplier, "carrier_id", "dst_id", "s_suppkey", "s_name", 10)


_CROSSING_SQL = """
SELECT {key}, k.node_name, COUNT(*) AS n_edges
FROM edges JOIN nodes s ON s.node_id = src_id JOIN nodes d ON d.node_id = dst_id
JOIN nodes k ON k.node_id = {key}
WHERE s.latitude * d.latitude < 0 GROUP BY {key}, k.node_name"""


@query(_CROSSING_SQL.format(key="src_id"))
def crossing_by_src(t: Tables) -> DataFrame:
    return A.crossing_counts(edges(t), nodes(t), "src_id", "dst_id", "node_id", "node_name", "latitude", "src")


@query(_CROSSING_SQL.format(key="dst_id"))
def crossing_by_dst(t: Tables) -> DataFrame:
    return A.crossing_counts(edges(t), nodes(t), "src_id", "dst_id", "node_id", "node_name", "latitude", "dst")


# ---- ranking


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10", name="first_n")
def first_orders(t: Tables) -> DataFrame:
    return first_n(t.orders.select("o_orderkey", "o_totalprice"), 10, ["o_orderkey"])


@query(
    """
SELECT event_id, event_type,
       row_number() OVER (PARTITION BY event_type ORDER BY md5('w1:' || event_id), event_id) AS row
FROM events"""
)
def row_number_per_class(t: Tables) -> DataFrame:
    return R.number_in_class(t.events.select("event_id", "event_type"), "event_type", "event_id", "w1")


@query(
    """
WITH activity AS (SELECT COUNT(*) AS n_items FROM plays GROUP BY user_id)
SELECT n_items, COUNT(*) AS n,
       ROUND(SUM(COUNT(*)) OVER (ORDER BY n_items) / CAST((SELECT COUNT(*) FROM activity) AS DOUBLE), 8) AS ecdf
FROM activity GROUP BY n_items"""
)
def ecdf(t: Tables) -> DataFrame:
    activity = A.activity(plays(t), "user_id", "item_id", "plays", "n_items", "total")
    return R.ecdf(activity, "n_items").withColumn("ecdf", F.round("ecdf", 8))


@query(
    """
WITH counts AS (SELECT carrier_id, COUNT(*) AS n FROM edges GROUP BY carrier_id),
ranked AS (SELECT carrier_id, n, row_number() OVER (ORDER BY n DESC, carrier_id) AS rank FROM counts)
SELECT carrier_id, n, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 60 AND (rank - 1) % 10 = 0"""
)
def every_nth(t: Tables) -> DataFrame:
    counts = edges(t).groupBy("carrier_id").agg(F.count(F.lit(1)).alias("n"))
    return R.every_nth(counts, [F.desc("n"), F.asc("carrier_id")], 10, 60)


@query("SELECT user_id, item_id, plays FROM plays ORDER BY plays DESC, user_id, item_id")
def ordered(t: Tables) -> DataFrame:
    return R.ordered(plays(t), [F.desc("plays")], ["user_id", "item_id"])


@query("SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def top_groups(t: Tables) -> DataFrame:
    return R.top_groups(t.part, "p_brand", 10)


@query(
    """
SELECT user_id, item_id, plays FROM plays WHERE item_id IN (
  SELECT item_id FROM plays GROUP BY item_id ORDER BY COUNT(*) DESC, item_id LIMIT 10)"""
)
def keep_top_groups(t: Tables) -> DataFrame:
    return R.keep_top_groups(materialise(plays(t), "plays"), "item_id", 10)


_TOP_K_SQL = """
WITH ranked AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, item_id) AS rank
  FROM plays)
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS items
FROM ranked WHERE rank <= 10 GROUP BY user_id"""


@query(_TOP_K_SQL)
def top_k_per_user(t: Tables) -> DataFrame:
    top = R.top_k_per_group(plays(t), "user_id", "item_id", "plays", 10)
    return top.select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    """
SELECT event_id, value / 500 AS confidence FROM events WHERE event_type = 'purchase'
ORDER BY value DESC, event_id LIMIT 10"""
)
def top_confident(t: Tables) -> DataFrame:
    pred = t.events.select(
        "event_id",
        (F.col("value") / 500).alias("probability"),
        (F.col("event_type") == "purchase").cast("int").alias("prediction"),
    )
    return R.top_confident(pred, 1, 10, "event_id").select("event_id", "confidence")


# ---- arrays and hashes


@query(
    """
WITH ranked AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, item_id) AS rank
  FROM plays),
top AS (SELECT user_id, item_id, rank FROM ranked WHERE rank <= 5)
SELECT user_id, item_id, CAST(rank AS INT) AS rank,
       MAX(CASE WHEN item_id = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS has_seven
FROM top"""
)
def array_suite(t: Tables) -> DataFrame:
    """Lists per group, exploded again with their position."""
    top = R.top_k_per_group(plays(t), "user_id", "item_id", "plays", 5)
    has_seven = F.array_contains("items", F.lit(7).cast("bigint")).cast("int")
    return top.select("user_id", has_seven.alias("has_seven"), F.posexplode("items")).select(
        "user_id", F.col("col").alias("item_id"), (F.col("pos") + 1).alias("rank"), "has_seven"
    )


@query("SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10")
def top_groups_by_summary(t: Tables) -> DataFrame:
    """The ten busiest suppliers; only those that a summary of each task can't rule out are counted."""
    return H.heavy_hitters(t.lineitem, "l_suppkey", 10)


@query(
    """
SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS word FROM documents) w
WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 100"""
)
def top_words_by_summary(t: Tables) -> DataFrame:
    """The hundred commonest words of all documents, without shuffling the rare ones."""
    words = t.documents.select(F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word"))
    return H.heavy_hitters(words.where("word <> ''"), "word", 100)
