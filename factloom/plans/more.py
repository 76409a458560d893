"""Further queries: versions, logs, clauses, spans, parsing, formatting, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import clusters, identity, memo, reconcile, scores, statistics, temporal, text
from factloom.plans.catalogue import Tables, query


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN CAST(floor(c_acctbal / 10) AS BIGINT) END AS candidate FROM customer), n AS (SELECT candidate, count(*) AS n FROM c WHERE candidate IS NOT NULL GROUP BY candidate)
  SELECT c.c_custkey, c.candidate, CASE WHEN n.n > 1 THEN 'REVIEW_SHARED' WHEN c.candidate IS NULL THEN 'NO_MATCH' ELSE 'MATCH' END AS status FROM c LEFT JOIN n ON c.candidate = n.candidate""")
def demote_shared_candidates(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.floor(F.col("c_acctbal") / 10)).alias("candidate"))
    c = c.withColumn("status", F.when(F.col("candidate").isNull(), "NO_MATCH").otherwise("MATCH"))
    return identity.demote_shared(c, "candidate", "status").select("c_custkey", "candidate", "status")


@query("""SELECT o_custkey, count(*) AS n, (count(DISTINCT o_orderstatus) <= 1 AND count(DISTINCT year(o_orderdate)) <= 1) AS coherent FROM orders GROUP BY o_custkey""")
def coherent_groups(t: Tables) -> DataFrame:
    return identity.coherent_groups(t.orders.select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y")), "o_custkey", ["o_orderstatus", "y"])


@query("""WITH e AS (SELECT user_id AS m, CAST(floor(value / 20) AS INTEGER) AS v, max(ts) AS at FROM events GROUP BY 1, 2), a AS (SELECT DISTINCT user_id AS m, 2 AS act FROM events WHERE event_type = 'purchase')
  SELECT e.m, arg_max(e.v, (CASE WHEN e.v IS NOT DISTINCT FROM a.act THEN 1 ELSE 0 END, e.at, e.v)) AS v FROM e LEFT JOIN a ON e.m = a.m GROUP BY e.m""")
def active_or_latest(t: Tables) -> DataFrame:
    e = t.events.groupBy(F.col("user_id").alias("m"), F.floor(F.col("value") / 20).cast("int").alias("v")).agg(F.max("ts").alias("at"))
    active = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("m"), F.lit(2).alias("v")).distinct()
    return reconcile.active_or_latest(e, active, "m", "v", "at")


@query("""WITH RECURSIVE d AS (SELECT n_nationkey AS m, n_nationkey - n_regionkey - 1 AS on_ FROM nation), r AS (SELECT m FROM d WHERE on_ IN (3, 7) UNION SELECT d.m FROM d JOIN r ON d.on_ = r.m) SELECT m FROM r WHERE m NOT IN (3, 7)""")
def stale_modules(t: Tables) -> DataFrame:
    edges = t.nation.select(F.col("n_nationkey").alias("m"), (F.col("n_nationkey") - F.col("n_regionkey") - 1).alias("on_"))
    return reconcile.stale(edges, t.nation.where("n_nationkey in (3, 7)").select(F.col("n_nationkey").alias("m")), "m", "on_")


@query("""SELECT conv_id, turn, arg_max AS text_md5 FROM (SELECT conv_id, max(turn) AS turn, md5(arg_max(text, turn)) AS arg_max FROM conversations GROUP BY conv_id)""")
def latest_turn_per_conversation(t: Tables) -> DataFrame:
    log = reconcile.latest_per_key(t.conversations.select("conv_id", F.col("turn").alias("at"), "turn", "text"), ["conv_id"], ["at"])
    return log.select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("""WITH c AS (SELECT doc_id, trim(u, ' ') AS c FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[.;!?]+[ \\n]|\\n')) AS u FROM documents)) SELECT doc_id, count(*) AS n_clauses, max(length(c)) AS longest FROM c WHERE c <> '' GROUP BY doc_id""")
def clause_split(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.explode(text.clauses(F.col("text"))).alias("c"))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_clauses"), F.max(F.length("c")).cast("long").alias("longest"))


@query("""WITH l AS (SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS context FROM conversations) SELECT conv_id, turn, context FROM l""")
def running_context(t: Tables) -> DataFrame:
    return text.running_label(t.conversations, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn"))).select("conv_id", "turn", "context")


@query("""WITH g AS (SELECT o_custkey, list_distinct(list(o_orderstatus)) AS v FROM orders GROUP BY o_custkey) SELECT o_custkey, CASE WHEN list_contains(v, 'P') THEN 'P' WHEN list_contains(v, 'O') THEN 'O' ELSE 'none' END AS best FROM g""")
def best_by_priority(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("v")).select("o_custkey", statistics.best(F.col("v"), ["P", "O"], "none").alias("best"))


@query("""WITH k AS (SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal > 5000) AS k, count(*) AS n FROM customer GROUP BY c_mktsegment) SELECT c_mktsegment, k || '/' || n || ' (' || printf('%.1f', k * 100.0 / n) || '%)' AS share,
  CASE WHEN k * 1.0 / n / 400 < 0.001 THEN '<0.001' ELSE printf('%.3f', k * 1.0 / n / 400) END AS p FROM k""")
def formatted_shares(t: Tables) -> DataFrame:
    k = t.customer.groupBy("c_mktsegment").agg(F.count_if(F.col("c_acctbal") > 5000).alias("k"), F.count(F.lit(1)).alias("n"))
    return k.select("c_mktsegment", statistics.share_text(F.col("k"), F.col("n")).alias("share"), statistics.p_text(F.col("k") / F.col("n") / 400).alias("p"))


@query("""WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'unknown' END AS s, CAST(o_orderdate AS DATE) AS d FROM orders)
  SELECT o_orderkey, CASE WHEN s <> 'unknown' THEN d END AS parsed, CASE WHEN o_orderkey % 4 = 0 THEN d END AS strict FROM r""")
def date_formats(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    s = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd.MM.yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).otherwise("unknown")
    rows = t.orders.select("o_orderkey", s.alias("s"))
    return rows.select("o_orderkey", temporal.any_date(F.col("s")).alias("parsed"), temporal.strict_date(F.col("s")).alias("strict"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) WHEN o_orderkey % 3 = 1 THEN year(o_orderdate) ELSE year(o_orderdate) END AS year, CASE WHEN o_orderkey % 3 < 2 THEN month(o_orderdate) END AS month,
  CASE WHEN o_orderkey % 3 = 0 THEN day(o_orderdate) END AS day, CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'month' ELSE 'year' END AS "precision" FROM orders""")
def partial_dates(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    said = F.concat(F.lit("ordered in "), F.when(k == 0, F.date_format(d, "d.M.yyyy")).when(k == 1, F.date_format(d, "MM/yyyy")).otherwise(F.date_format(d, "yyyy")), F.lit(" by mail"))
    return t.orders.select("o_orderkey", temporal.partial_date(said).alias("p")).select("o_orderkey", "p.*")


@query("""WITH r AS (SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) WHEN c_custkey % 3 = 1 THEN 'nobody' ELSE '' END AS quote FROM customer)
  SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS balance, CASE WHEN c_custkey % 3 <> 0 THEN 'no_evidence' END AS flag FROM r""")
def grounded_values(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    rows = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"), F.when(k == 0, F.lower("c_name")).when(k == 1, "nobody").otherwise("").alias("quote"))
    return memo.grounded(rows, "quote", "c_name", ["balance"]).select("c_custkey", "balance", "flag")


@query("""SELECT event_id, concat_ws(',', CASE WHEN NOT (value > 10) THEN 'value' END, CASE WHEN NOT (event_type <> 'view') THEN 'kind' END) AS broken FROM events WHERE NOT (value > 10 AND event_type <> 'view')""")
def invalid_rows(t: Tables) -> DataFrame:
    bad = memo.split_valid(t.events, {"value": F.col("value") > 10, "kind": F.col("event_type") != "view"})[1]
    return bad.select("event_id", F.array_join("broken", ",").alias("broken"))


@query("""WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN floor(c_acctbal / 1000) ELSE -1 END AS lo, CASE WHEN c_custkey % 5 <> 0 THEN floor(c_acctbal / 1000) ELSE 9 END AS hi FROM customer)
  SELECT c_custkey, CASE WHEN lo = hi THEN CASE WHEN lo <= 2 THEN 'low' WHEN lo <= 6 THEN 'middle' ELSE 'high' END END AS class FROM b""")
def bounded_classes(t: Tables) -> DataFrame:
    x = F.floor(F.col("c_acctbal") / 1000)
    known = F.col("c_custkey") % 5 != 0
    return t.customer.select("c_custkey", scores.bounded_class(F.when(known, x).otherwise(-1), F.when(known, x).otherwise(9), [("low", 2), ("middle", 6), ("high", 0)]).alias("class"))


@query("""SELECT c_custkey, CAST(substr(n, 10, 1) AS INTEGER) = (3 * substr(n, 1, 1)::INT + 7 * substr(n, 2, 1)::INT + 9 * substr(n, 3, 1)::INT + 5 * substr(n, 4, 1)::INT + 8 * substr(n, 5, 1)::INT + 4 * substr(n, 6, 1)::INT + 2 * substr(n, 7, 1)::INT + substr(n, 8, 1)::INT + 6 * substr(n, 9, 1)::INT) % 11 AS valid
  FROM (SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 10, '0') AS n FROM customer)""")
def check_digits(t: Tables) -> DataFrame:
    n = F.lpad((F.col("c_custkey") * 7919).cast("string"), 10, "0")
    return t.customer.select("c_custkey", scores.checksum11(n, [3, 7, 9, 5, 8, 4, 2, 1, 6, 0], 10).alias("valid"))


@query("""WITH s AS (SELECT sha256(lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')))) AS f, source FROM documents), a AS (SELECT DISTINCT f FROM s WHERE source IN ('src0', 'src1')), b AS (SELECT DISTINCT f FROM s WHERE source NOT IN ('src0', 'src1'))
  SELECT count(*) AS n_shared FROM a JOIN b ON a.f = b.f""")
def leakage_between_groups(t: Tables) -> DataFrame:
    f = t.documents.select(text.fingerprint(F.col("text")).alias("f"), F.col("source").isin("src0", "src1").alias("held"))
    per = f.groupBy("f").agg(F.bool_or("held").alias("a"), F.bool_or(~F.col("held")).alias("b"))
    return per.agg(F.count_if(F.col("a") & F.col("b")).alias("n_shared"))


@query("""WITH a AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderkey % 3 <> 0 THEN month(o_orderdate) END AS m, CASE WHEN o_orderkey % 3 = 1 THEN day(o_orderdate) END AS d FROM orders),
  days AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y, m, d) AS n FROM (SELECT DISTINCT o_custkey, y, m, d FROM a WHERE d IS NOT NULL)),
  nd AS (SELECT o_custkey, count(*) AS nd FROM days GROUP BY o_custkey),
  fm AS (SELECT x.o_custkey, x.y, x.m, count(days.n) AS fit, min(days.n) AS one FROM (SELECT DISTINCT o_custkey, y, m FROM a WHERE m IS NOT NULL AND d IS NULL) x LEFT JOIN days ON days.o_custkey = x.o_custkey AND days.y = x.y AND days.m = x.m GROUP BY ALL),
  months AS (SELECT fm.*, CASE fit WHEN 1 THEN one WHEN 0 THEN coalesce(nd, 0) + sum(CASE WHEN fit = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY fm.o_custkey ORDER BY fm.y, fm.m) END AS n FROM fm LEFT JOIN nd ON nd.o_custkey = fm.o_custkey),
  known AS (SELECT o_custkey, y, n FROM days UNION ALL SELECT o_custkey, y, n FROM months WHERE fit = 0), nk AS (SELECT o_custkey, count(*) AS nk FROM known GROUP BY o_custkey),
  fy AS (SELECT x.o_custkey, x.y, count(known.n) AS fit, min(known.n) AS one FROM (SELECT DISTINCT o_custkey, y FROM a WHERE m IS NULL) x LEFT JOIN known ON known.o_custkey = x.o_custkey AND known.y = x.y GROUP BY ALL),
  years AS (SELECT fy.*, CASE fit WHEN 1 THEN one WHEN 0 THEN coalesce(nk, 0) + sum(CASE WHEN fit = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY fy.o_custkey ORDER BY fy.y) END AS n FROM fy LEFT JOIN nk ON nk.o_custkey = fy.o_custkey)
  SELECT a.o_custkey, a.o_orderkey, CAST(CASE WHEN a.d IS NOT NULL THEN days.n WHEN a.m IS NOT NULL THEN months.n ELSE years.n END AS BIGINT) AS cluster FROM a
  LEFT JOIN days ON days.o_custkey = a.o_custkey AND days.y = a.y AND days.m = a.m AND days.d = a.d LEFT JOIN months ON months.o_custkey = a.o_custkey AND months.y = a.y AND months.m = a.m AND a.d IS NULL
  LEFT JOIN years ON years.o_custkey = a.o_custkey AND years.y = a.y AND a.m IS NULL""")
def partial_date_clusters(t: Tables) -> DataFrame:
    """Orders of a customer grouped by dates of differing precision; held where several groups fit."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    m = t.orders.select("o_custkey", "o_orderkey", F.year(d).alias("y"), F.when(k % 3 != 0, F.month(d)).alias("m"), F.when(k % 3 == 1, F.dayofmonth(d)).alias("d"))
    return clusters.date_clusters(m, ["o_custkey"], "o_orderkey", "y", "m", "d")
