"""Headline relational queries over the star schema, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import relational
from .tables import table


def _price():  # noqa: ANN202
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def pricing_summary(s, d):  # noqa: ANN001, ANN201
    li = table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"), F.round(F.sum(_price()), 2).alias("revenue"), F.avg("l_discount").alias("discount"), F.count("*").alias("lines"))


def revenue_by_nation(s, d):  # noqa: ANN001, ANN201
    """Local suppliers' revenue: customer and supplier of one nation."""
    n = table(s, d, "nation")
    j = table(s, d, "lineitem").select("l_orderkey", "l_suppkey", _price().alias("price")).join(table(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(table(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(table(s, d, "supplier").select("s_suppkey", "s_nationkey"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return j.groupBy("s_nationkey").agg(F.round(F.sum("price"), 2).alias("revenue"), F.count("*").alias("lines")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "revenue", "lines")


def filtered_revenue(s, d):  # noqa: ANN001, ANN201
    li = table(s, d, "lineitem").where("l_quantity < 24 AND l_discount BETWEEN 0.05 AND 0.07")
    return li.agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"), F.count("*").alias("lines"))


def top_orders(s, d):  # noqa: ANN001, ANN201
    r = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(_price()), 2).alias("revenue"))
    return r.orderBy(F.desc("revenue"), "l_orderkey").limit(20)


def top_customers(s, d):  # noqa: ANN001, ANN201
    return relational.ranked_frequencies(table(s, d, "orders"), "o_custkey", top=50)


def orders_without_returns(s, d):  # noqa: ANN001, ANN201
    back = table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.pending(table(s, d, "orders").select("o_orderkey", "o_orderpriority"), back, "o_orderkey").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


def best_lines(s, d):  # noqa: ANN001, ANN201
    """Of each part its dearest line, ties by order and line."""
    li = table(s, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return relational.first_n(li, ["l_partkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")


def running_spend(s, d):  # noqa: ANN001, ANN201
    """Each customer's orders in time: running count, previous order, share of the running total."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(s, d, "orders").select("o_orderkey", F.row_number().over(w).alias("k"), F.lag("o_orderkey").over(w).alias("previous"), F.ntile(4).over(w).alias("quarter"), F.round(F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), 2).alias("spent"))


def cube_counts(s, d):  # noqa: ANN001, ANN201
    return table(s, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))


def nation_pivot(s, d):  # noqa: ANN001, ANN201
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("n_name").pivot("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]).agg(F.count("c_custkey")).na.fill(0)


def nearest_vectors(s, d):  # noqa: ANN001, ANN201
    """Mean vector length and members of each label."""
    e = table(s, d, "embeddings").withColumn("norm", F.sqrt(F.aggregate(F.transform("embedding", lambda x: (x * x).cast("double")), F.lit(0.0), lambda a, b: a + b)))
    return e.groupBy("label").agg(F.count("*").alias("vectors"), F.round(F.avg("norm"), 4).alias("mean_norm"), F.max(F.size("embedding")).alias("parts"))


def event_sets(s, d):  # noqa: ANN001, ANN201
    """Users who bought but never met an error, and users who did both."""
    e = table(s, d, "events").select("user_id", "event_type")
    bought, failed = (e.where(F.col("event_type") == t).select("user_id") for t in ("purchase", "error"))
    one, both = bought.subtract(failed), bought.intersect(failed)
    return one.withColumn("kind", F.lit("bought only")).union(both.withColumn("kind", F.lit("both"))).groupBy("kind").agg(F.count("*").alias("users"), F.min("user_id").alias("first"), F.max("user_id").alias("last"))


QUERIES = {f.__name__: f for f in (pricing_summary, revenue_by_nation, filtered_revenue, top_orders, top_customers, orders_without_returns, best_lines, running_spend, cube_counts, nation_pivot, nearest_vectors, event_sets)}

ORACLES = {
    "pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, avg(l_discount) AS discount, count(*) AS lines FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
    "revenue_by_nation": """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
    "filtered_revenue": "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue, count(*) AS lines FROM lineitem WHERE l_quantity < 24 AND l_discount BETWEEN 0.05::DOUBLE AND 0.07::DOUBLE",
    "top_orders": "SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1 ORDER BY revenue DESC, l_orderkey LIMIT 20",
    "top_customers": "WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 50) SELECT o_custkey, n, row_number() OVER (ORDER BY n DESC, o_custkey)::INTEGER AS place FROM c",
    "orders_without_returns": "SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1",
    "best_lines": "SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1",
    "running_spend": """SELECT o_orderkey, row_number() OVER w::INTEGER AS k, lag(o_orderkey) OVER w AS previous, ntile(4) OVER w::INTEGER AS quarter, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS spent
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "cube_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "nation_pivot": "SELECT n_name, " + ", ".join(f"count(*) FILTER (c_mktsegment = '{m}') AS {m}" for m in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "nearest_vectors": "SELECT label, count(*) AS vectors, round(avg(sqrt(list_sum(list_transform(embedding, lambda x: (x * x)::DOUBLE)))), 4) AS mean_norm, max(len(embedding))::INTEGER AS parts FROM embeddings GROUP BY label",
    "event_sets": """WITH b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error'), u AS (SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM f) THEN 'both' ELSE 'bought only' END AS kind FROM b)
        SELECT kind, count(*) AS users, min(user_id) AS first, max(user_id) AS last FROM u GROUP BY kind""",
}
