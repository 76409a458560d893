"""All queries on the driver tables and, next to each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import identity, reconcile, scans, scores, statistics, temporal, text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The driver tables by name, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its name, with its SQL."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _priced(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_totalprice", "o_orderstatus").join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))


# --- describing -----------------------------------------------------------------------------------------------------------------


@query("""SELECT c_mktsegment, count(o_totalprice) AS n, count(*) - count(o_totalprice) AS n_missing, round(quantile_cont(o_totalprice, 0.25), 4) AS q1,
  round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS q3
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def describe_continuous(t: Tables) -> DataFrame:
    return statistics.continuous(_priced(t), ["c_mktsegment"], "o_totalprice")


@query("""SELECT c_mktsegment, count(*) FILTER (WHERE o_orderstatus = 'F') AS final_k, count(o_orderstatus) AS final_n,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(o_orderstatus), 4) AS final_pct FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def describe_categorical(t: Tables) -> DataFrame:
    return _priced(t).groupBy("c_mktsegment").agg(*statistics.categorical(F.col("o_orderstatus") == "F", "final"))


@query("""WITH e AS (SELECT nullif(event_type, 'view') AS event_type, CASE WHEN value > 50 THEN value END AS value, props FROM events)
  SELECT 'event_type' AS variable, count(event_type) AS n_known, count(*) - count(event_type) AS n_missing FROM e
  UNION ALL SELECT 'value', count(value), count(*) - count(value) FROM e UNION ALL SELECT 'props', count(props), count(*) - count(props) FROM e""")
def missingness_summary(t: Tables) -> DataFrame:
    e = t.events.select(F.expr("nullif(event_type, 'view')").alias("event_type"), F.when(F.col("value") > 50, F.col("value")).alias("value"), "props")
    return statistics.missing(e, ["event_type", "value", "props"])


@query("""SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS is_click, count(*) FILTER (WHERE event_type = 'purchase') AS is_purchase,
  count(*) FILTER (WHERE event_type = 'view') AS is_view FROM events GROUP BY user_id""")
def one_hot_primary(t: Tables) -> DataFrame:
    hot = statistics.one_hot(t.events.select("user_id", "event_type"), "event_type", ["click", "purchase", "view"], "is_")
    return hot.groupBy("user_id").agg(*[F.count_if(c).alias(c) for c in ("is_click", "is_purchase", "is_view")])


@query("""SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS flag, count(DISTINCT l_returnflag) > 1 AS differs
  FROM lineitem GROUP BY l_orderkey""")
def consensus_or_null(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(statistics.consensus("l_returnflag").alias("flag"), statistics.conflict("l_returnflag").alias("differs"))


@query("""WITH l AS (SELECT l_orderkey, CASE WHEN l_quantity > 45 THEN 'yes' WHEN l_quantity < 25 THEN 'no' END AS v FROM lineitem)
  SELECT l_orderkey, CASE WHEN bool_or(v IS NOT DISTINCT FROM 'yes') THEN true WHEN bool_and(v IS NOT DISTINCT FROM 'no') THEN false END AS any_large,
  CASE WHEN bool_or(v = 'yes') THEN true END AS known_large FROM l GROUP BY l_orderkey""")
def tri_state_any(t: Tables) -> DataFrame:
    v = F.when(F.col("l_quantity") > 45, "yes").when(F.col("l_quantity") < 25, "no")
    rows = t.lineitem.select("l_orderkey", v.alias("v"))
    return rows.groupBy("l_orderkey").agg(statistics.assessed_any("v", "yes", "no").alias("any_large"), statistics.known_any(F.col("v") == "yes").alias("known_large"))


@query("""SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'pending' WHEN bool_or(o_orderstatus = 'O' AND o_totalprice > 300000) THEN 'large_open'
  WHEN bool_or(o_orderstatus = 'O') THEN 'open' ELSE 'done' END AS status FROM orders GROUP BY o_custkey""")
def status_rollup_precedence(t: Tables) -> DataFrame:
    s, large = F.col("o_orderstatus"), F.col("o_totalprice") > 300000
    return t.orders.groupBy("o_custkey").agg(statistics.status_by_precedence([("pending", s == "P"), ("large_open", (s == "O") & large), ("open", s == "O")], "done").alias("status"))


@query("""WITH r AS (SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tier, o_orderstatus,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS rank FROM orders WHERE regexp_matches(o_orderpriority, '^[1-9]')),
  m AS (SELECT o_custkey, min(tier) AS tier FROM r GROUP BY o_custkey)
  SELECT r.o_custkey, m.tier, arg_max(o_orderstatus, rank) AS o_orderstatus FROM r JOIN m ON r.o_custkey = m.o_custkey AND r.tier = m.tier GROUP BY r.o_custkey, m.tier""")
def source_tier_strongest(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderpriority").rlike("^[1-9]")).select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), "o_orderstatus")
    return statistics.strongest_of_best_tier(rows, ["o_custkey"], "tier", "o_orderstatus", {"F": 1, "O": 2, "P": 3})


@query("""SELECT 'rich' AS measure, count(*) FILTER (WHERE c_acctbal > 5000) AS k, count(c_acctbal) AS n FROM customer
  UNION ALL SELECT 'in_debt', count(*) FILTER (WHERE c_acctbal < 0), count(c_acctbal) FROM customer
  UNION ALL SELECT 'builder', count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), count(c_mktsegment) FROM customer""")
def cohort_counts_long(t: Tables) -> DataFrame:
    return statistics.long_counts(t.customer, {"rich": F.col("c_acctbal") > 5000, "in_debt": F.col("c_acctbal") < 0, "builder": F.col("c_mktsegment") == "BUILDING"})


@query("""SELECT user_id, CAST(ts AS DATE) AS day, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at, count(*) AS n,
  CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS only_type FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def encounter_merge(t: Tables) -> DataFrame:
    rows = t.events.groupBy("user_id", F.to_date("ts").alias("day"))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_at"), F.count(F.lit(1)).alias("n"), statistics.consensus("event_type").alias("only_type"))


@query("""SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_F, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_O, count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O')) AS other
  FROM orders GROUP BY o_custkey""")
def pivot_status_coverage(t: Tables) -> DataFrame:
    return statistics.pivot_counts(t.orders, "o_custkey", "o_orderstatus", ["F", "O"])


@query("""WITH b AS (SELECT DISTINCT p_brand FROM part), s AS (SELECT DISTINCT p_size FROM part),
  g AS (SELECT p_brand, p_size, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part WHERE p_retailprice > 1200 GROUP BY p_brand, p_size)
  SELECT b.p_brand, s.p_size, coalesce(n, 0) AS n, mean FROM b CROSS JOIN s LEFT JOIN g ON g.p_brand = b.p_brand AND g.p_size = s.p_size""")
def densified_group_summary(t: Tables) -> DataFrame:
    groups = t.part.where("p_retailprice > 1200").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean"))
    return statistics.densified(groups, statistics.grid(t.part, "p_brand", "p_size"), ["p_brand", "p_size"], ["n"])


@query("""WITH l AS (SELECT c_mktsegment AS s, o_totalprice AS v, o_orderstatus = 'F' AS f FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus IN ('F','O')),
  c AS (SELECT s, v, count(*) AS t, count(*) FILTER (WHERE f) AS t1 FROM l GROUP BY s, v),
  r AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY s ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS rank FROM c),
  a AS (SELECT s, sum(rank * t1) AS r1, sum(t1) AS n1, sum(t) AS n, sum(CAST(t AS DOUBLE) * (t * t - 1)) AS ties FROM r GROUP BY s)
  SELECT s AS c_mktsegment, CAST(n1 AS BIGINT) AS n1, CAST(n - n1 AS BIGINT) AS n0, round(CAST(r1 - n1 * (n1 + 1) / 2.0 AS DOUBLE), 4) AS u,
  round(greatest(abs(r1 - n1 * (n1 + 1) / 2.0 - n1 * (n - n1) / 2.0) - 0.5, 0) / sqrt(n1 * (n - n1) / 12.0 * ((n + 1) - ties / (CAST(n AS DOUBLE) * (n - 1)))), 6) AS z FROM a""")
def mann_whitney_u(t: Tables) -> DataFrame:
    rows = _priced(t).where("o_orderstatus in ('F', 'O')").withColumn("f", F.col("o_orderstatus") == "F")
    return statistics.mann_whitney(rows, ["c_mktsegment"], "o_totalprice", "f")


@query("""WITH g AS (SELECT p_brand, count(*) FILTER (WHERE p_size > 25 AND p_retailprice > 1400) AS a, count(*) FILTER (WHERE p_size > 25 AND p_retailprice <= 1400) AS b, count(*) FILTER (WHERE p_size <= 25 AND p_retailprice > 1400) AS c, count(*) FILTER (WHERE p_size <= 25 AND p_retailprice <= 1400) AS d FROM part GROUP BY p_brand),
  x AS (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS k FROM g),
  l AS (SELECT *, lgamma(a + b + 1) - lgamma(k + 1) - lgamma(a + b - k + 1) + lgamma(c + d + 1) - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) - lgamma(a + b + c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) AS lp FROM x),
  o AS (SELECT *, max(CASE WHEN k = a THEN lp END) OVER (PARTITION BY p_brand) AS own FROM l)
  SELECT p_brand, a, b, c, d, CASE WHEN a + b > 0 AND a + c > 0 AND c + d > 0 AND b + d > 0 THEN round(least(1.0, sum(CASE WHEN lp <= own + 1e-7 THEN exp(lp) ELSE 0 END)), 9) END AS p FROM o GROUP BY p_brand, a, b, c, d""")
def fisher_exact_guarded(t: Tables) -> DataFrame:
    """Per brand: are large parts dearer? Two-sided p, null where a margin is empty."""
    large, dear = F.col("p_size") > 25, F.col("p_retailprice") > 1400
    g = t.part.groupBy("p_brand").agg(F.count_if(large & dear).alias("a"), F.count_if(large & ~dear).alias("b"), F.count_if(~large & dear).alias("c"), F.count_if(~large & ~dear).alias("d"))
    return g.withColumn("p", F.round(statistics.fisher_exact(*[F.col(x) for x in "abcd"]), 9))


@query("""WITH l AS (SELECT c_mktsegment AS g, o_totalprice AS x, o_orderstatus = 'F' AS b FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT 'o_totalprice' AS variable, g AS "group", count(x) AS n, count(*) - count(x) AS n_missing, round(quantile_cont(x, 0.25), 4) AS q1, round(quantile_cont(x, 0.5), 4) AS median,
    round(quantile_cont(x, 0.75), 4) AS q3, CAST(NULL AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS pct FROM l GROUP BY g
  UNION ALL SELECT 'final', g, count(b), count(*) - count(b), NULL, NULL, NULL, count(*) FILTER (WHERE b), round(count(*) FILTER (WHERE b) * 100.0 / count(b), 4) FROM l GROUP BY g""")
def baseline_table(t: Tables) -> DataFrame:
    rows = _priced(t).withColumn("final", F.col("o_orderstatus") == "F")
    return statistics.baseline_table(rows, "c_mktsegment", ["o_totalprice"], ["final"])


# --- time -----------------------------------------------------------------------------------------------------------------------


@query("""WITH i AS (SELECT user_id, max(ts) AS at FROM events WHERE event_type = 'purchase' GROUP BY user_id),
  c AS (SELECT i.user_id, i.at, e.value, CAST(e.ts AS DATE) AS d FROM i JOIN events e ON e.user_id = i.user_id AND e.event_type = 'view' AND e.ts <= i.at AND date_diff('day', CAST(e.ts AS DATE), CAST(i.at AS DATE)) <= 7),
  m AS (SELECT user_id, max(d) AS d FROM c GROUP BY user_id),
  v AS (SELECT c.user_id, c.d, CASE WHEN count(DISTINCT value) = 1 THEN min(value) END AS value FROM c JOIN m ON c.user_id = m.user_id AND c.d = m.d GROUP BY c.user_id, c.d)
  SELECT i.user_id, v.d AS fact_date, v.value FROM i LEFT JOIN v ON i.user_id = v.user_id""")
def asof_lookback(t: Tables) -> DataFrame:
    index = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("at"))
    facts = t.events.where("event_type = 'view'").select("user_id", "ts", "value")
    return temporal.as_of(index, facts, ["user_id"], "user_id", "at", "ts", "value", 7).select("user_id", "fact_date", "value")


@query("""WITH i AS (SELECT user_id, max(ts) - INTERVAL 10 DAY AS at FROM events GROUP BY user_id)
  SELECT e.user_id, e.event_type, CASE WHEN count(DISTINCT value) = 1 THEN min(value) END AS value, max(CAST(e.ts AS DATE)) AS last_date, count(*) AS n_facts
  FROM events e JOIN i ON e.user_id = i.user_id WHERE e.ts <= i.at GROUP BY e.user_id, e.event_type""")
def asof_facts_unanimous(t: Tables) -> DataFrame:
    index = t.events.groupBy("user_id").agg((F.max("ts") - F.expr("interval 10 days")).alias("at"))
    return temporal.facts_at(t.events, index, "user_id", "event_type", "value", "ts", "at")


@query("""WITH i AS (SELECT l_orderkey AS k, o_custkey AS c, min(o_orderdate) AS a, max(l_shipdate) AS z FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey),
  p AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders),
  f AS (SELECT o_orderkey, count(*) AS n, min(k) AS k FROM p JOIN i ON c = o_custkey AND o_orderdate >= a AND o_orderdate <= z GROUP BY o_orderkey)
  SELECT p.o_orderkey, coalesce(n, 0) AS n_intervals, CASE WHEN n = 1 THEN k END AS interval_id FROM p LEFT JOIN f ON p.o_orderkey = f.o_orderkey""")
def interval_link_unique(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("z"))
    spans = shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_orderkey").alias("interval_id"), "o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("z").alias("z"))
    return temporal.link_in_interval(orders, spans, ["o_custkey"], "o_orderkey", "o_orderdate", "interval_id", "a", "z").select("o_orderkey", "n_intervals", "interval_id")


@query("""WITH r AS (SELECT user_id, event_id, CASE WHEN max(value) OVER w > 90 THEN 'high' WHEN count(*) FILTER (WHERE event_type = 'purchase') OVER w > 0 THEN 'bought' ELSE 'none' END AS state,
    ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
  c AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM r)
  SELECT user_id, event_id, state FROM c WHERE state IS DISTINCT FROM before""")
def running_state_changes(t: Tables) -> DataFrame:
    states = {"top": ("max", F.col("value")), "bought": ("any", F.col("event_type") == "purchase")}
    state = F.when(F.col("top") > 90, "high").when(F.col("bought"), "bought").otherwise("none")
    rows = t.events.select("user_id", "event_id", "ts", "value", "event_type")
    return scans.state_changes(rows, ["user_id"], ["ts", "event_id"], states, state).select("user_id", "event_id", "state")


@query("""WITH m AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 300 SECOND THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m)
  SELECT user_id, CAST(island AS BIGINT) AS island, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_at, count(*) AS n FROM g GROUP BY user_id, island""")
def gaps_islands_sessions(t: Tables) -> DataFrame:
    found = temporal.islands(t.events, ["user_id"], "ts", 300, ["event_id"])
    as_text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return found.select("user_id", "island", as_text("start").alias("start_at"), as_text("end").alias("end_at"), "n")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY d ASC NULLS LAST, o_orderkey) AS exam_order FROM o""")
def exam_order_row_number(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate")).alias("d"))
    return temporal.numbered(rows, "o_custkey", "d", "o_orderkey").select("o_custkey", "o_orderkey", "exam_order")


@query("""SELECT user_id, arg_max(value, (ts, event_id)) AS last_value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM events WHERE value > 20 GROUP BY user_id""")
def last_non_null_by_date(t: Tables) -> DataFrame:
    rows = t.events.withColumn("known", F.when(F.col("value") > 20, F.col("value")))
    return temporal.last_known(rows, ["user_id"], "known", ["ts", "event_id"]).withColumn("last_at", F.date_format("last_at", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, CAST(max(l_shipdate) AS DATE) + 3000 AS z FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate)
  SELECT o_orderkey, round(date_diff('day', b, z) / 365.2425, 6) AS age_exact, CAST(year(z) - year(b) - CASE WHEN (month(z), day(z)) < (month(b), day(b)) THEN 1 ELSE 0 END AS INTEGER) AS age_years FROM d""")
def age_exact_and_calendar(t: Tables) -> DataFrame:
    d = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.to_date(F.min("o_orderdate")).alias("b"), F.date_add(F.to_date(F.max("l_shipdate")), 3000).alias("z"))
    return d.select("o_orderkey", F.round(temporal.age_exact(F.col("b"), F.col("z")), 6).alias("age_exact"), temporal.age_years(F.col("b"), F.col("z")).alias("age_years"))


@query("""WITH p AS (SELECT o_custkey, year(o_orderdate) AS y, CASE WHEN o_orderpriority <> '1-URGENT' THEN month(o_orderdate) END AS m, CASE WHEN o_orderpriority > '2-HIGH' THEN day(o_orderdate) END AS d FROM orders), g AS (SELECT o_custkey, y, m, d, count(*) AS n FROM p GROUP BY ALL)
  SELECT a.o_custkey, a.y, coalesce(a.m, 0) AS m1, coalesce(a.d, 0) AS d1, coalesce(b.m, 0) AS m2, coalesce(b.d, 0) AS d2, (a.m = b.m) IS NOT FALSE AND (a.d = b.d) IS NOT FALSE AS compatible, a.n * b.n AS n_pairs FROM g a JOIN g b ON a.o_custkey = b.o_custkey AND a.y = b.y AND (coalesce(a.m, 0), coalesce(a.d, 0)) < (coalesce(b.m, 0), coalesce(b.d, 0))""")
def partial_date_compat_groups(t: Tables) -> DataFrame:
    p, at = F.col("o_orderpriority"), F.col("o_orderdate")
    dates = t.orders.select("o_custkey", F.year(at).alias("y"), F.when(p != "1-URGENT", F.month(at)).alias("m"), F.when(p > "2-HIGH", F.dayofmonth(at)).alias("d"))
    got = temporal.compatible_pairs(dates, ["o_custkey"], "y", "m", "d")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return got.select("o_custkey", "y", zero("m_a").alias("m1"), zero("d_a").alias("d1"), zero("m_b").alias("m2"), zero("d_b").alias("d2"), "compatible", "n_pairs")


# --- joins and identity ---------------------------------------------------------------------------------------------------------


@query("""SELECT c_custkey, o_orderkey, count(*) AS n_items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  WHERE c_mktsegment = 'BUILDING' GROUP BY c_custkey, o_orderkey""")
def three_way_manifest_join(t: Tables) -> DataFrame:
    c = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    return o.join(c, "c_custkey").join(items, "o_orderkey").select("c_custkey", "o_orderkey", "n_items", "quantity")


@query("""WITH c AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') SELECT o_orderkey, c_custkey, CASE WHEN c_custkey IS NULL THEN 'missing' WHEN c_acctbal < 0 THEN 'conflict' ELSE 'ok' END AS status
  FROM orders LEFT JOIN c ON o_custkey = c_custkey""")
def left_join_conflicts(t: Tables) -> DataFrame:
    c = t.customer.where("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_acctbal")
    status = F.when(F.col("c_custkey").isNull(), "missing").when(F.col("c_acctbal") < 0, "conflict").otherwise("ok")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_custkey", status.alias("status"))


@query("""SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 'available' WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') THEN 'uncertain'
  ELSE 'missing' END AS part FROM customer""")
def partition_target(t: Tables) -> DataFrame:
    with_status = lambda s: t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c_custkey"))
    return identity.partition_ids(t.customer, with_status("F"), with_status("O"), "c_custkey")


@query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 49)
  (SELECT k, 'left' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b)) UNION ALL (SELECT k, 'right' FROM (SELECT k FROM b EXCEPT SELECT k FROM a))""")
def symmetric_difference(t: Tables) -> DataFrame:
    keys = lambda p: t.lineitem.where(p).select(F.col("l_partkey").alias("k"))
    return identity.symmetric_difference(keys("l_returnflag = 'R'"), keys("l_quantity > 49"), "k")


@query("""WITH b AS (SELECT s_nationkey AS n, CAST(floor(s_acctbal / 1000) AS BIGINT) AS g, count(DISTINCT s_suppkey) AS k, min(s_suppkey) AS one FROM supplier GROUP BY 1, 2)
  SELECT c_custkey, coalesce(k, 0) AS n_candidates, CASE WHEN k IS NULL THEN 'NO_MATCH' WHEN k = 1 THEN 'MATCH' ELSE 'AMBIGUOUS' END AS status, CASE WHEN k = 1 THEN one END AS candidate
  FROM customer LEFT JOIN b ON n = c_nationkey AND g = CAST(floor(c_acctbal / 1000) AS BIGINT)""")
def key_match_cardinality(t: Tables) -> DataFrame:
    probe = t.customer.select("c_custkey", F.col("c_nationkey").alias("n"), F.floor(F.col("c_acctbal") / 1000).alias("g"))
    build = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n"), F.floor(F.col("s_acctbal") / 1000).alias("g"))
    return identity.match_cardinality(probe, build, ["n", "g"], "s_suppkey").select("c_custkey", "n_candidates", "status", "candidate")


@query("""WITH p AS (SELECT p_partkey AS k, p_size AS s, p_brand AS b, p_retailprice AS v, upper(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g'))) AS n FROM part),
  x AS (SELECT l.k AS l, r.k AS r, CASE WHEN l.n = r.n THEN 1 WHEN replace(l.n, ' ', '') = replace(r.n, ' ', '') THEN 2
    WHEN list_slice(string_split(l.n, ' '), 1, least(len(string_split(l.n, ' ')), len(string_split(r.n, ' ')))) = list_slice(string_split(r.n, ' '), 1, least(len(string_split(l.n, ' ')), len(string_split(r.n, ' ')))) THEN 3 END AS g
    FROM p l JOIN p r ON l.s = r.s AND l.b = r.b AND r.v >= 1200 WHERE l.v < 1200),
  c AS (SELECT l, g, count(DISTINCT r) AS n, min(r) AS one FROM x WHERE g IS NOT NULL GROUP BY l, g), m AS (SELECT l, min(g) AS g FROM c GROUP BY l), z AS (SELECT c.* FROM c JOIN m ON c.l = m.l AND c.g = m.g)
  SELECT k AS left_id, CASE g WHEN 1 THEN 'exact' WHEN 2 THEN 'orthography' WHEN 3 THEN 'prefix' END AS grade, coalesce(z.n, 0) AS n_matches, CASE WHEN z.n = 1 THEN one END AS right_id,
  CASE WHEN z.n IS NULL THEN 'NO_MATCH' WHEN z.n = 1 THEN 'MATCH' ELSE 'AMBIGUOUS' END AS status FROM p LEFT JOIN z ON z.l = p.k WHERE p.v < 1200""")
def graded_match_unique(t: Tables) -> DataFrame:
    side = lambda dear, name, label: t.part.where((F.col("p_retailprice") >= 1200) == F.lit(dear)).select("p_size", "p_brand", F.col("p_partkey").alias(name), F.col("p_name").alias(label))
    return identity.graded_match(side(False, "left_id", "l"), side(True, "right_id", "r"), ["p_size", "p_brand"], "left_id", "right_id", "l", "r")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS a, CAST(floor(s_acctbal / 500) AS INTEGER) + 1000 AS b FROM supplier), d AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r AS (SELECT a AS id, a AS c FROM d UNION SELECT d.b, r.c FROM r JOIN d ON d.a = r.id) SELECT id, min(c) AS component FROM r GROUP BY id""")
def connected_components_min(t: Tables) -> DataFrame:
    e = t.supplier.select(F.col("s_nationkey").alias("a"), (F.floor(F.col("s_acctbal") / 500) + 1000).cast("int").alias("b"))
    return identity.components(e, "a", "b")


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS a, n_nationkey + n_regionkey + 1 AS b FROM nation), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a, b FROM r""")
def dependency_closure(t: Tables) -> DataFrame:
    return reconcile.closure(t.nation.select(F.col("n_nationkey").alias("a"), (F.col("n_nationkey") + F.col("n_regionkey") + 1).alias("b")), "a", "b")


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS x, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 1 WHEN o_orderkey % 3 = 0 THEN make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) ELSE CAST(o_orderdate AS DATE) + 400 END AS y FROM orders)
  SELECT reason, count(*) AS n FROM (SELECT CASE WHEN x = y THEN NULL WHEN abs(date_diff('day', x, y)) = 1 THEN 'one_day' WHEN year(x) = year(y) AND month(x) = day(y) AND day(x) = month(y) THEN 'day_month_swapped'
  WHEN year(x) = year(y) THEN 'same_year' ELSE 'different_year' END AS reason FROM d) GROUP BY reason""")
def date_conflict_reasons(t: Tables) -> DataFrame:
    x, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    y = F.when(k % 2 == 0, F.date_add(x, 1)).when(k % 3 == 0, F.trunc(x, "year")).otherwise(F.date_add(x, 400))
    return t.orders.select(identity.date_conflict(x, y).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH v AS (SELECT DISTINCT p_partkey, trim(u) AS value FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS u FROM part) WHERE trim(u) <> '')
  SELECT value, count(*) AS n_owners, CAST(sum(CAST(concat('0x', substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS BIGINT)) AS BIGINT) AS owners_digest FROM v GROUP BY value""")
def split_semicolon_index(t: Tables) -> DataFrame:
    return identity.index_counts(identity.multi_value_index(t.part, "p_type", "p_partkey", " "))


@query("""WITH c AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS own, s_nationkey + CAST(floor(s_acctbal / 3000) AS INTEGER) AS other FROM supplier),
  t0 AS (SELECT s_suppkey, own AS c FROM c WHERE own IS NOT NULL), t1 AS (SELECT a.s_suppkey, b.n_nationkey AS c FROM c a JOIN nation b ON b.n_nationkey = a.other OR b.n_nationkey = a.other + a.s_suppkey % 2),
  x AS (SELECT s_suppkey, 0 AS t, count(DISTINCT c) AS n, min(c) AS c FROM t0 GROUP BY 1 UNION ALL SELECT s_suppkey, 1, count(DISTINCT c), min(c) FROM t1 GROUP BY 1),
  m AS (SELECT s_suppkey, min(t) AS t FROM x GROUP BY 1), z AS (SELECT x.* FROM x JOIN m ON x.s_suppkey = m.s_suppkey AND x.t = m.t)
  SELECT s.s_suppkey, CASE WHEN z.n = 1 THEN z.c END AS candidate, z.t AS tier, CASE WHEN z.n IS NULL THEN 'NO_MATCH' WHEN z.n = 1 THEN 'MATCH' ELSE 'AMBIGUOUS' END AS status FROM supplier s LEFT JOIN z ON s.s_suppkey = z.s_suppkey""")
def resolve_tiers(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey")).alias("own"), (F.col("s_nationkey") + F.floor(F.col("s_acctbal") / 3000)).cast("int").alias("other"))
    nation = t.nation.select(F.col("n_nationkey").alias("candidate"))
    guess = s.select("s_suppkey", F.explode(F.array_distinct(F.array("other", (F.col("other") + F.col("s_suppkey") % 2).cast("int")))).alias("candidate")).join(nation, "candidate")
    return identity.resolve_in_order(s, "s_suppkey", [s.where("own is not null").select("s_suppkey", F.col("own").alias("candidate")), guess], "candidate")


# --- loads and versions ---------------------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'),
  s AS (SELECT l_orderkey AS k, l_linestatus AS v FROM lineitem WHERE l_linenumber = 1 AND l_returnflag <> 'R'),
  a AS (SELECT k, count(*) AS n, min(v) AS v FROM c GROUP BY k), b AS (SELECT k, count(*) AS n, min(v) AS v FROM s GROUP BY k)
  SELECT a.k, a.v, CASE WHEN a.n > 1 OR b.n > 1 THEN 'ambiguous' WHEN b.n IS NULL THEN 'insert' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'skip' ELSE 'conflict' END AS status FROM a LEFT JOIN b ON a.k = b.k""")
def reconcile_plan(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    twice = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    stored = t.lineitem.where("l_linenumber = 1 and l_returnflag <> 'R'").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("v"))
    return reconcile.plan_load(o.unionByName(twice), stored, ["k"], ["v"])


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderpriority <> '5-LOW'), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS p FROM orders WHERE o_orderpriority <> '1-URGENT')
  SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'ADDED' WHEN b.k IS NULL THEN 'REMOVED' WHEN a.s IS DISTINCT FROM b.s OR a.p IS DISTINCT FROM b.p THEN 'CHANGED' ELSE 'UNCHANGED' END AS change,
  CASE WHEN a.k IS NULL OR b.k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.s IS DISTINCT FROM b.s THEN 's' END, CASE WHEN a.p IS DISTINCT FROM b.p THEN 'p' END) END AS changed_columns FROM a FULL JOIN b ON a.k = b.k""")
def snapshot_diff(t: Tables) -> DataFrame:
    side = lambda but: t.orders.where(F.col("o_orderpriority") != but).select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    k = F.col("k")
    new = side("1-URGENT").withColumn("s", F.when(k % 7 == 0, "X").otherwise(F.col("s"))).withColumn("p", F.when(k % 5 != 0, F.col("p")))
    return reconcile.snapshot_diff(side("5-LOW"), new, ["k"], ["s", "p"])


@query("""WITH a AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS s, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS b FROM customer),
  b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'OTHER' ELSE c_mktsegment END AS s, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS b FROM customer WHERE c_nationkey <> 7),
  j AS (SELECT a.s AS s, b.s AS s2, a.b AS b, b.b AS b2 FROM a LEFT JOIN b ON a.k = b.k)
  SELECT 's' AS "column", count(*) FILTER (WHERE s IS NULL AND s2 IS NOT NULL) AS filled, count(*) FILTER (WHERE s = s2) AS equal, count(*) FILTER (WHERE s <> s2) AS conflict FROM j
  UNION ALL SELECT 'b', count(*) FILTER (WHERE b IS NULL AND b2 IS NOT NULL), count(*) FILTER (WHERE b = b2), count(*) FILTER (WHERE b <> b2) FROM j""")
def fill_null_merge(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    a = t.customer.select(k.alias("k"), F.when(k % 3 != 0, F.col("c_mktsegment")).alias("s"), F.when(k % 4 != 0, F.col("c_acctbal")).alias("b"))
    b = t.customer.where("c_nationkey <> 7").select(k.alias("k"), F.when(k % 5 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("s"), F.when(k % 6 != 0, F.col("c_acctbal")).alias("b"))
    return reconcile.fill_nulls(a, b, "k", ["s", "b"])[1]


@query("""SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""")
def insert_missing(t: Tables) -> DataFrame:
    stored = t.lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return reconcile.insert_missing(t.part.select("p_partkey", "p_brand"), stored, ["p_partkey"])


@query("""WITH e AS (SELECT user_id AS m, CAST(floor(value / 10) AS INTEGER) AS v, ts, event_id, event_type FROM events),
  l AS (SELECT m, v, max((ts, event_id)) AS o, arg_max(event_type, (ts, event_id)) AS t FROM e GROUP BY m, v), g AS (SELECT * FROM l WHERE t <> 'click')
  SELECT m, arg_max(v, (o, v)) AS v, arg_max(t, (o, v)) AS event_type FROM g GROUP BY m""")
def latest_version_selection(t: Tables) -> DataFrame:
    e = t.events.select(F.col("user_id").alias("m"), F.floor(F.col("value") / 10).cast("int").alias("v"), F.struct("ts", "event_id").alias("at"), "event_type")
    return reconcile.latest_valid(e, "m", "v", "at", F.col("event_type") != "click").select("m", "v", "event_type")


@query("""WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS t, arg_max(value, (ts, event_id)) AS v FROM events GROUP BY user_id),
  a AS (SELECT user_id, v, CASE t WHEN 'click' THEN 'EDIT' WHEN 'view' THEN 'REJECT' WHEN 'purchase' THEN 'RESET' ELSE 'ACCEPT' END AS action, user_id % 4 AS h FROM l)
  SELECT c_custkey, CASE WHEN action IS NULL OR action = 'RESET' THEN c_acctbal WHEN h <> c_custkey % 3 THEN c_acctbal WHEN action = 'EDIT' THEN v WHEN action = 'REJECT' THEN NULL ELSE c_acctbal END AS shown,
  CASE WHEN action IS NULL OR action = 'RESET' THEN 'OPEN' WHEN h <> c_custkey % 3 THEN 'STALE' ELSE action END AS review_state FROM customer LEFT JOIN a ON c_custkey = user_id""")
def log_projection_overlay(t: Tables) -> DataFrame:
    log = reconcile.latest_per_key(t.events.select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"])
    kind = F.col("event_type")
    action = F.when(kind == "click", "EDIT").when(kind == "view", "REJECT").when(kind == "purchase", "RESET").otherwise("ACCEPT")
    latest = log.select(F.col("user_id").alias("c_custkey"), action.alias("action"), F.col("value").alias("new_value"), (F.col("user_id") % 4).alias("source_hash"))
    raw = t.customer.select("c_custkey", "c_acctbal", (F.col("c_custkey") % 3).alias("hash"))
    return reconcile.overlay(raw, latest, "c_custkey", "c_acctbal", "hash").select("c_custkey", "shown", "review_state")


# --- text -----------------------------------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT DISTINCT doc_id, trim(u, ' ') AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents)) SELECT line, count(*) AS n_docs FROM l WHERE line <> '' GROUP BY line HAVING count(*) >= 3""")
def line_explode_noise(t: Tables) -> DataFrame:
    return text.noise_lines(t.documents, "doc_id", "text", 3)


_HEADING = r"^[A-ZÄÖÜÉÈ][A-Za-zÄÖÜäöüßéèêçñóíá]{0,12}\.$"


@query(f"""WITH a AS (SELECT doc_id, length(text) AS n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
  b AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM a),
  h AS (SELECT * FROM b WHERE i = 1 OR regexp_matches(line, '{_HEADING}'))
  SELECT doc_id, row_number() OVER w AS section_no, CAST(pos AS BIGINT) AS "start", CAST(coalesce(lead(pos) OVER w, n) AS BIGINT) AS "end", CASE WHEN regexp_matches(line, '{_HEADING}') THEN line END AS heading FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)""")
def segment_spans_lossless(t: Tables) -> DataFrame:
    return text.sections(t.documents, "doc_id", "text", F.col("line").rlike(_HEADING))


@query("""WITH c AS (SELECT doc_id, regexp_matches(text, '(?i)licen[sc]e') AS a, regexp_matches(text, '[|]') AS b, regexp_matches(text, '[$%&#*]{3}') AS c FROM documents)
  SELECT doc_id, CASE WHEN a::INT + b::INT + c::INT = 1 THEN CASE WHEN a THEN 'licensed' WHEN b THEN 'table' ELSE 'junk' END ELSE 'unknown' END AS kind FROM c""")
def doc_type_exactly_one(t: Tables) -> DataFrame:
    rules = [("licensed", "(?i)licen[sc]e"), ("table", "[|]"), ("junk", "[$%&#*]{3}")]
    return t.documents.select("doc_id", text.only_label(F.col("text"), rules).alias("kind"))


@query("""SELECT conv_id, turn, CASE WHEN lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'))) LIKE 'the %' THEN 'the' WHEN regexp_matches(lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'))), '^(der|die|das) ') THEN 'article' WHEN role = 'system' THEN 'system' END AS label FROM conversations""")
def heading_classify_rules(t: Tables) -> DataFrame:
    label = text.first_label(text.normalized(F.col("text")), [("the", "^the "), ("article", "^(der|die|das) ")])
    return t.conversations.select("conv_id", "turn", F.coalesce(label, F.when(F.col("role") == "system", "system")).alias("label"))


@query("""WITH c AS (SELECT doc_id, trim(u, ' ') AS c FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[.;!?]+[ \\n]|\\n')) AS u FROM documents)), n AS (SELECT doc_id, lower(trim(regexp_replace(c, '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS c FROM c WHERE c <> ''),
  s AS (SELECT doc_id, CASE WHEN regexp_matches(c, '\\b(no|not|without|never|kein|keine|ohne|sans|pas|sin|ning[uú]n)\\b') THEN 'NEGATED' WHEN regexp_matches(c, '\\b(if|unless|falls|wenn|wäre|si)\\b') THEN 'CONDITIONAL'
    WHEN regexp_matches(c, '\\b(versus|vs|differential|rule out|ausschluss)\\b') THEN 'DIFFERENTIAL' WHEN regexp_matches(c, '\\b(possible|possibly|probable|suspected|verdacht|fraglich|peut|posible)\\b') THEN 'UNCERTAIN' ELSE 'ESTABLISHED' END AS state FROM n WHERE regexp_matches(c, '\\blicensed\\b'))
  SELECT doc_id, 'licence' AS concept, state, count(*) AS n FROM s GROUP BY doc_id, state""")
def assertion_cascade(t: Tables) -> DataFrame:
    return text.mention_states(t.documents, "doc_id", "text", {"licence": r"\blicensed\b"})


@query("""WITH c AS (SELECT doc_id, len(regexp_extract_all(text, 'the ')) AS a, len(regexp_extract_all(text, 'tion')) AS b FROM documents)
  SELECT doc_id, 'article' AS concept, CAST(a AS INTEGER) AS n_mentions FROM c WHERE a > 0 UNION ALL SELECT doc_id, 'suffix', CAST(b AS INTEGER) FROM c WHERE b > 0""")
def mention_extract_count(t: Tables) -> DataFrame:
    return text.mentions(t.documents, "doc_id", "text", {"article": "the ", "suffix": "tion"})


@query("""SELECT page_id, TRY_CAST(nullif(regexp_extract(url, 'page[ :=]*(-?[0-9]+(?:[.,][0-9]+)?)', 1), '') AS DOUBLE) AS page_no, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages""")
def labelled_value_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.labelled_value(F.col("url"), "page").alias("page_no"), F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"))


@query("""SELECT doc_id, sha256(lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')))) AS fingerprint FROM documents""")
def text_normalize_fingerprint(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query("""SELECT sha256(lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')))) AS fingerprint, min(doc_id) AS representative, count(*) AS n_copies FROM documents GROUP BY 1""")
def copy_groups_nested(t: Tables) -> DataFrame:
    return text.copy_groups(t.documents, "doc_id", "text")


@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'))) ORDER BY doc_id) AS i FROM documents) WHERE i = 1""")
def dedup_keep_first(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", "text")
    return text.keep_first(rows.select("doc_id", "source", text.fingerprint(F.col("text")).alias("f")), [F.col("f")], ["doc_id"]).select("doc_id", "source")


@query("""WITH r AS (SELECT DISTINCT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, lower(o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN ' ' || o_orderpriority ELSE '' END) AS t FROM orders),
  l AS (SELECT k, d, arg_max(t, (length(t), t)) AS long FROM r GROUP BY k, d), n AS (SELECT r.k, r.d, bool_and(contains(long, t)) AS exact, count(*) AS c FROM r JOIN l ON r.k = l.k AND r.d = l.d GROUP BY r.k, r.d)
  SELECT k AS o_custkey, CASE WHEN bool_and(exact) THEN count(*) END AS exact_count, count(*) AS lower_bound, CAST(sum(c) AS BIGINT) AS n_texts FROM n GROUP BY k""")
def exam_inventory_lower_bound(t: Tables) -> DataFrame:
    said = F.concat("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), "o_orderpriority")).otherwise(""))
    return text.inventory(t.orders.select("o_custkey", "o_orderdate", said.alias("said")), ["o_custkey"], "o_orderdate", "said")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50""")
def json_props_project(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k")).where("k >= 50")


# --- scores and gates -----------------------------------------------------------------------------------------------------------


@query("""WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal > 5000 END AS a, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment = 'BUILDING' END AS b, c_nationkey < 10 AS c FROM customer),
  s AS (SELECT c_custkey, (CASE WHEN a THEN 2 ELSE 0 END) + (CASE WHEN b THEN 1 ELSE 0 END) + (CASE WHEN c THEN 1 ELSE 0 END) AS lo, (CASE WHEN a IS NULL OR a THEN 2 ELSE 0 END) + (CASE WHEN b IS NULL OR b THEN 1 ELSE 0 END) + (CASE WHEN c THEN 1 ELSE 0 END) AS hi,
    (CASE WHEN a IS NULL THEN 1 ELSE 0 END) + (CASE WHEN b IS NULL THEN 1 ELSE 0 END) AS u FROM f)
  SELECT c_custkey, lo AS score_min, hi AS score_max, CASE WHEN lo = hi THEN lo END AS score, u AS n_unknown FROM s""")
def score_with_bounds(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    items = {"rich": (F.when(k % 5 != 0, F.col("c_acctbal") > 5000), 2), "builder": (F.when(k % 7 != 0, F.col("c_mktsegment") == "BUILDING"), 1), "near": (F.col("c_nationkey") < 10, 1)}
    return t.customer.select("c_custkey", *scores.score_with_bounds(items))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN value > 80 THEN 'high' WHEN value > 40 THEN 'middle' ELSE 'low' END AS class FROM events""")
def decision_table_bins(t: Tables) -> DataFrame:
    v = F.when(F.col("event_type") != "view", F.col("value"))
    return t.events.select("event_id", scores.decide([("high", v > 80), ("middle", v > 40)], "low").alias("class"))


@query("""WITH c AS (SELECT o_orderkey, o_totalprice > 150000 AS a, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus = 'F' END AS b FROM orders)
  SELECT o_orderkey, concat_ws(',', CASE WHEN a THEN 'large' END, CASE WHEN b THEN 'final' END) AS met, concat_ws(',', CASE WHEN NOT a THEN 'large' END, CASE WHEN NOT b THEN 'final' END) AS failed,
  concat_ws(',', CASE WHEN a IS NULL THEN 'large' END, CASE WHEN b IS NULL THEN 'final' END) AS unknown FROM c""")
def criteria_holds(t: Tables) -> DataFrame:
    held = {"large": F.col("o_totalprice") > 150000, "final": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus") == "F")}
    return t.orders.select("o_orderkey", *scores.criteria(held))


@query("""SELECT 'order_without_customer' AS gate, count(*) AS n_violations FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'item_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'shipped_before_ordered', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
  UNION ALL SELECT 'repeated_item', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def gate_violations(t: Tables) -> DataFrame:
    o, li = t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    same = F.col("l_orderkey") == F.col("o_orderkey")
    return scores.violations({
        "order_without_customer": o.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
        "item_without_order": li.join(o, same, "left_anti"),
        "shipped_before_ordered": li.join(o, same).where("l_shipdate < o_orderdate"),
        "repeated_item": li.groupBy("l_orderkey", "l_linenumber").count().where("count > 1"),
    })


@query("""WITH RECURSIVE r AS (SELECT DISTINCT o_custkey, concat_ws('|', o_orderpriority, o_orderstatus) AS kind FROM orders), w AS (SELECT kind, 1 / sqrt(count(*)) AS w FROM r GROUP BY kind),
  i AS (SELECT o_custkey, list(r.kind) AS kinds, list(struct_pack(kind := r.kind, w := w)) AS own FROM r JOIN w ON r.kind = w.kind GROUP BY o_custkey),
  p AS (SELECT 0 AS rank, CAST(NULL AS BIGINT) AS o_custkey, CAST([] AS VARCHAR[]) AS covered
    UNION ALL SELECT * FROM (SELECT p.rank + 1, i.o_custkey, list_concat(p.covered, i.kinds) FROM p, i WHERE p.rank < 8 AND NOT list_has_all(p.covered, i.kinds)
      ORDER BY round(list_sum(list_transform(list_filter(i.own, lambda x: NOT list_contains(p.covered, x.kind)), lambda x: x.w)), 9) DESC, i.o_custkey LIMIT 1))
  SELECT CAST(rank AS INTEGER) AS rank, o_custkey FROM p WHERE rank > 0""")
def greedy_coverage_pick(t: Tables) -> DataFrame:
    """Eight customers that cover the most kinds of orders (priority and status), rare kinds first."""
    rows = t.orders.select("o_custkey", F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("kind"))
    return scores.greedy_cover(rows, "o_custkey", "kind", 8)
