"""Joins, windows, sets, sampling, vectors and event time over the star schema and the stream table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docketry.operators.timelines import nearest_before
from docketry.operators.vectors import cosine_topk, label_centroids
from docketry.plans.registry import CORE
from docketry.sources.tables import table


@CORE.query(
    "header_detail_stats",
    "SELECT o.o_orderkey, o.o_orderpriority, coalesce(n, 0) AS lines, round(coalesce(total, 0), 2) AS total FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey WHERE coalesce(n, 0) >= 6",
)
def header_detail_stats(spark, sf):
    """Headers with grouped statistics of their details; the details are aggregated before the join."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("t"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    n = F.coalesce("n", F.lit(0))
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").where(n >= 6).select("o_orderkey", "o_orderpriority", n.alias("lines"), F.round(F.coalesce("t", F.lit(0.0)), 2).alias("total"))


@CORE.query(
    "hierarchy_lookup",
    "SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, count(DISTINCT s_suppkey) AS suppliers FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL",
)
def hierarchy_lookup(spark, sf):
    """A parent chain with counts at the leaves; each leaf table is counted before it meets the other, so no product of them is formed."""
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("c"))
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("s"))
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return n.select("r_name", "n_name", F.coalesce("c", F.lit(0)).alias("customers"), F.coalesce("s", F.lit(0)).alias("suppliers"))


@CORE.query("pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 4) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def pricing_summary(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 4).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@CORE.query(
    "revenue_by_nation",
    "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY revenue DESC, n_name LIMIT 10",
)
def revenue_by_nation(spark, sf):
    """Revenue is summed per order before the orders are joined to their customers."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    by = o.groupBy("o_custkey").agg(F.sum("rev").alias("rev")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return by.groupBy("n_name").agg(F.round(F.sum("rev"), 2).alias("revenue")).orderBy(F.desc("revenue"), "n_name").limit(10)


@CORE.query(
    "full_outer_ledger",
    """SELECT coalesce(j.source_name, p.source_name) AS source_name, coalesce(j.n, 0) AS judgments, coalesce(p.n, 0) AS pages, CASE WHEN j.n IS NULL THEN 'pages only' WHEN p.n IS NULL THEN 'judgments only' WHEN j.n > p.n THEN 'ahead' ELSE 'behind' END AS state
    FROM (SELECT source_name, count(*) AS n FROM judgment GROUP BY 1) j FULL OUTER JOIN (SELECT source_name, count(*) AS n FROM page_result GROUP BY 1) p ON p.source_name = j.source_name""",
)
def full_outer_ledger(spark, sf):
    j = table(spark, sf, "judgment").groupBy("source_name").agg(F.count(F.lit(1)).alias("j"))
    p = table(spark, sf, "page_result").groupBy("source_name").agg(F.count(F.lit(1)).alias("p"))
    state = F.when(F.col("j").isNull(), "pages only").when(F.col("p").isNull(), "judgments only").when(F.col("j") > F.col("p"), "ahead").otherwise("behind")
    return j.join(p, "source_name", "full_outer").select("source_name", F.coalesce("j", F.lit(0)).alias("judgments"), F.coalesce("p", F.lit(0)).alias("pages"), state.alias("state"))


_A, _B = "SELECT reporter, decision_year FROM judgment", "SELECT reporter, CAST(year(listed_at) AS INTEGER) FROM enumerated_case"


@CORE.query("set_operations", f"SELECT 'union' AS op, count(*) AS n FROM ({_A} UNION {_B}) UNION ALL SELECT 'union_all', count(*) FROM ({_A} UNION ALL {_B}) UNION ALL SELECT 'intersect', count(*) FROM ({_A} INTERSECT {_B}) UNION ALL SELECT 'except', count(*) FROM ({_A} EXCEPT {_B}) UNION ALL SELECT 'except_all', count(*) FROM ({_A} EXCEPT ALL {_B}) UNION ALL SELECT 'intersect_all', count(*) FROM ({_A} INTERSECT ALL {_B})")
def set_operations(spark, sf):
    a = table(spark, sf, "judgment").select("reporter", F.col("decision_year").alias("y"))
    b = table(spark, sf, "enumerated_case").select("reporter", F.year("listed_at").alias("y"))
    out = None
    for op, df in (("union", a.union(b).distinct()), ("union_all", a.union(b)), ("intersect", a.intersect(b)), ("except", a.subtract(b)), ("except_all", a.exceptAll(b)), ("intersect_all", a.intersectAll(b))):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@CORE.query("ranking_windows", "SELECT p_partkey, p_brand, rank() OVER w AS r, dense_rank() OVER w AS d, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn, ntile(4) OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS q, round(percent_rank() OVER w, 6) AS pr FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice DESC)")
def ranking_windows(spark, sf):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"))
    t = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return table(spark, sf, "part").select("p_partkey", "p_brand", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.row_number().over(t).alias("rn"), F.ntile(4).over(t).alias("q"), F.round(F.percent_rank().over(w), 6).alias("pr"))


@CORE.query("moving_windows", "SELECT event_id, round(avg(value) OVER w, 6) AS mean5, lag(value) OVER o AS before, lead(value) OVER o AS after, first_value(value) OVER o AS first FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id), w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def moving_windows(spark, sf):
    o = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_id", F.round(F.avg("value").over(o.rowsBetween(-4, 0)), 6).alias("mean5"), F.lag("value").over(o).alias("before"), F.lead("value").over(o).alias("after"), F.first("value").over(o).alias("first"))


@CORE.query("nearest_preceding", "SELECT c.user_id, c.ts, c.event_id, (SELECT NULL) IS NULL AND v.value IS NOT NULL AS has, v.value AS nearest FROM (SELECT * FROM events WHERE event_type = 'purchase') c ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON v.user_id = c.user_id AND c.ts > v.ts")
def nearest_preceding(spark, sf):
    """Each purchase with the last view strictly before it."""
    e = table(spark, sf, "events")
    views = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    got = nearest_before(e.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), views, "user_id", "ts", "value", "event_id")
    return got.select("user_id", "ts", "event_id", F.col("nearest").isNotNull().alias("has"), "nearest")


@CORE.query("tumbling_windows", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("hour"), "event_type", "n", "total")


@CORE.query("sliding_windows", "SELECT date_trunc('hour', ts) - to_hours(CAST(k AS INTEGER)) AS start, count(*) AS n FROM events, range(3) r(k) GROUP BY 1")
def sliding_windows(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "3 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


@CORE.query(
    "session_windows",
    "WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, sid",
)
def session_windows(spark, sf):
    e = table(spark, sf, "events").groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return e.select("user_id", F.col("w.start").alias("start"), "n")


@CORE.query("debounced_requests", "SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts) AS slot, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def debounced_requests(spark, sf):
    """At most one request per key and window: the batch twin of the streaming debounce."""
    return table(spark, sf, "events").groupBy("user_id", F.window("ts", "10 minutes").alias("w")).agg(F.min("event_id").alias("event_id")).select("user_id", F.col("w.start").alias("slot"), "event_id")


@CORE.query("approximate_statistics", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS parts_near, count(DISTINCT l_suppkey) AS suppliers, true AS suppliers_near, true AS median_near FROM lineitem GROUP BY 1")
def approximate_statistics(spark, sf):
    """Sketches beside the exact figures, and whether they are within their bounds: 15 % for distinct counts, half a per cent of the rows for the median."""
    li = table(spark, sf, "lineitem")
    sketch = li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("p"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("m"), F.hll_sketch_estimate(F.hll_sketch_agg("l_suppkey")).alias("s"))
    exact = li.join(F.broadcast(sketch.select("l_returnflag", "m")), "l_returnflag").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count_if(F.col("l_extendedprice") < F.col("m")).alias("below"), F.count_if(F.col("l_extendedprice") > F.col("m")).alias("above"), F.count(F.lit(1)).alias("n")
    )
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.15 * F.col(b)
    return exact.join(sketch, "l_returnflag").select("l_returnflag", "parts", near("p", "parts").alias("parts_near"), "suppliers", near("s", "suppliers").alias("suppliers_near"), (F.greatest("below", "above") <= 0.505 * F.col("n") + 1).alias("median_near"))


@CORE.query("exact_quantiles", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, count(DISTINCT l_partkey) AS parts, round(stddev_samp(l_quantity), 6) AS sd, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def exact_quantiles(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.percentile("l_extendedprice", 0.5), 4).alias("p50"), F.round(F.percentile("l_extendedprice", 0.9), 4).alias("p90"), F.count_distinct("l_partkey").alias("parts"), F.round(F.stddev_samp("l_quantity"), 6).alias("sd"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@CORE.query("event_properties", "SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def event_properties(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@CORE.query("variant_properties", "SELECT user_id, sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS total FROM events GROUP BY 1")
def variant_properties(spark, sf):
    """The same field read through the variant type."""
    k = F.expr("variant_get(parse_json(props), '$.k', 'int')")
    return table(spark, sf, "events").groupBy("user_id").agg(F.sum(k).alias("total"))


@CORE.query("map_functions", "SELECT user_id, count(DISTINCT event_type) AS kinds, max(n) AS most FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def map_functions(spark, sf):
    """Counts per kind folded into a map and read from it."""
    e = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return m.select("user_id", F.size(F.map_keys("m")).alias("kinds"), F.array_max(F.map_values("m")).alias("most"))


@CORE.query(
    "cosine_topk",
    """WITH q AS (SELECT vec_id AS qid, embedding AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT qid, vec_id, round(list_cosine_similarity(e::DOUBLE[], embedding::DOUBLE[]), 6) AS sim FROM q, embeddings WHERE vec_id <> qid)
    SELECT qid, vec_id, sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, vec_id) AS rn FROM s) WHERE rn <= 5""",
)
def cosine_neighbours(spark, sf):
    """The five nearest rows of every row whose id is divisible by 50, exactly."""
    e = table(spark, sf, "embeddings")
    return cosine_topk(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 5)


@CORE.query("label_centroids", "SELECT label, i, round(avg(embedding[i]), 6) AS mean FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2")
def centroids(spark, sf):
    return label_centroids(table(spark, sf, "embeddings"), "label", "embedding")


@CORE.query("right_join_counts", "SELECT s_nationkey, n_name, count(s_suppkey) AS n FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2")
def right_join_counts(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "right").groupBy("s_nationkey", "n_name").agg(F.count("s_suppkey").alias("n"))


@CORE.query("band_join", "SELECT e.event_id, count(*) AS near FROM events e JOIN events o ON o.user_id = e.user_id AND o.ts BETWEEN e.ts - INTERVAL 10 MINUTE AND e.ts GROUP BY 1")
def band_join(spark, sf):
    """Rows within a band before each row: a range frame over a sorted partition in place of an inequality join."""
    s = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("_s").rangeBetween(-600_000_000, 0)
    return table(spark, sf, "events").withColumn("_s", s).select("event_id", F.count(F.lit(1)).over(w).alias("near"))
