"""Further queries: binding, pairing once, alternatives of keys, first presentations, product lines, patches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import identity, reconcile, statistics, temporal, text
from factloom.plans.catalogue import Tables, query


@query("""SELECT l_orderkey, CASE WHEN bool_or(l_linestatus = 'O' AND l_quantity > 40) AND NOT bool_or(l_returnflag = 'R') THEN 'INDETERMINATE'
  ELSE arg_max(l_returnflag, CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END) END AS worst FROM lineitem GROUP BY l_orderkey""")
def worst_unless_unresolved(t: Tables) -> DataFrame:
    open_ = (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 40)
    return t.lineitem.groupBy("l_orderkey").agg(statistics.worst_unless_unresolved("l_returnflag", {"R": 3, "A": 2, "N": 1}, open_, "R").alias("worst"))


@query("""SELECT source, doc_id, n_chars, rank FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 3""")
def first_k_per_group(t: Tables) -> DataFrame:
    return statistics.first_k(t.documents.select("source", "doc_id", "n_chars"), "source", 3, [F.desc("n_chars"), F.col("doc_id")])


@query("""WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY o_custkey)
  SELECT o.o_custkey, strftime(f.d, '%Y-%m-%d') AS first_date, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) END AS value, count(*) AS n FROM orders o JOIN f ON o.o_custkey = f.o_custkey AND CAST(o_orderdate AS DATE) = f.d GROUP BY o.o_custkey, f.d""")
def first_presentation(t: Tables) -> DataFrame:
    first = temporal.first_day(t.orders, ["o_custkey"], "o_orderdate", "o_orderstatus")
    return first.withColumn("first_date", F.date_format("first_date", "yyyy-MM-dd"))


@query("""WITH e AS (SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) END AS d FROM events), i AS (SELECT DISTINCT * FROM e)
  SELECT user_id, event_type, count(*) AS n_identities, bool_or(d IS NOT NULL) AS dated FROM i WHERE d IS NOT NULL OR NOT EXISTS (SELECT 1 FROM i j WHERE j.user_id = i.user_id AND j.event_type = i.event_type AND j.d IS NOT NULL) GROUP BY user_id, event_type""")
def dated_subsumes_undated(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.to_date("ts")).alias("d"))
    return temporal.dated_identities(e, ["user_id", "event_type"], "d")


@query("""SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer ON (s_nationkey = c_nationkey AND floor(s_acctbal / 100) = floor(c_acctbal / 100)) OR (s_suppkey * 7 = c_custkey AND s_acctbal > 0)""")
def match_any_key(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 100).alias("band"), F.when(F.col("s_acctbal") > 0, F.col("s_suppkey") * 7).alias("number"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 100).alias("band"), F.col("c_custkey").alias("number"))
    return identity.match_any(s, c, "s_suppkey", "c_custkey", [["nation", "band"], ["number"]])


@query("""WITH a AS (SELECT o_custkey, o_orderpriority, o_orderkey AS f, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F'),
  b AS (SELECT o_custkey, o_orderpriority, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'O') SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority, f, o
  FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority AND a.n = b.n""")
def pair_once(t: Tables) -> DataFrame:
    side = lambda s, c: t.orders.where(F.col("o_orderstatus") == s).select("o_custkey", "o_orderpriority", F.col("o_orderkey").alias(c))
    return identity.pair_once(side("F", "f"), side("O", "o"), ["o_custkey", "o_orderpriority"], "f", "o")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 100000)""")
def without_positive_evidence(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_totalprice")
    return identity.lacking(t.customer.select("c_custkey"), o, ["c_custkey"], (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))


@query("""WITH m AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, false AS candidate FROM orders WHERE o_orderstatus = 'F'),
  r AS (SELECT * FROM m UNION ALL SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE), true FROM orders WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM m))
  SELECT o_custkey, strftime(min(d), '%Y-%m-%d') AS first_day, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS members, count(*) AS n, bool_or(candidate) AS candidate FROM r GROUP BY o_custkey""")
def families_with_candidates(t: Tables) -> DataFrame:
    side = lambda s: t.orders.where(F.col("o_orderstatus") == s)
    got = reconcile.with_candidates(side("F"), side("O"), "o_custkey", "o_orderkey", "o_orderdate")
    return got.withColumn("first_day", F.date_format("first_day", "yyyy-MM-dd"))


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nation, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS p_segment, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey + c_custkey % 2 END AS p_nation FROM customer)
  SELECT c_custkey, 'segment' AS "column", CASE WHEN segment IS NULL THEN 'fills' WHEN segment = p_segment THEN 'same' ELSE 'conflict' END AS state FROM r WHERE p_segment IS NOT NULL
  UNION ALL SELECT c_custkey, 'nation', CASE WHEN nation IS NULL THEN 'fills' WHEN nation = p_nation THEN 'same' ELSE 'conflict' END FROM r WHERE p_nation IS NOT NULL""")
def patch_conflicts(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    current = t.customer.select(k, F.when(k % 4 != 0, F.col("c_mktsegment")).alias("segment"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("nation"))
    patch = t.customer.select(k, F.when(k % 3 != 0, F.col("c_mktsegment")).alias("segment"), F.when(k % 7 != 0, F.col("c_nationkey") + k % 2).alias("nation"))
    return reconcile.patch_conflicts(current, patch, "c_custkey", ["segment", "nation"])


@query("""SELECT p_partkey, CASE WHEN p_name LIKE 'small widget%' THEN 'SW' WHEN split_part(p_name, ' ', 1) = 'small' THEN 'S' WHEN split_part(p_name, ' ', 1) = 'cold' THEN 'AMBIGUOUS' END AS code FROM part""")
def longest_alias(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.longest_alias(F.col("p_name"), [("small", "S"), ("small widget", "SW"), ("cold", "C"), ("Cold", "K")]).alias("code"))


@query("""SELECT p_partkey, p_size / 2.0 AS strength, CASE WHEN p_size % 2 = 0 THEN 'mg' ELSE 'ml' END AS unit, CASE WHEN p_size % 3 <> 0 THEN '1-0-' || (p_size % 3) END AS schedule, p_size % 5 = 0 AS as_needed FROM part""")
def product_lines(t: Tables) -> DataFrame:
    s = F.col("p_size")
    line = F.concat("p_name", F.lit(" "), F.replace(F.format_string("%.1f", s / 2), F.lit("."), F.lit(",")), F.when(s % 2 == 0, " mg ").otherwise("ml "), F.when(s % 3 != 0, F.concat(F.lit("1-0-"), (s % 3).cast("string"))).otherwise("daily"), F.when(s % 5 == 0, " if needed").otherwise(""))
    return t.part.select("p_partkey", text.dosage(line).alias("d")).select("p_partkey", "d.*")


@query("""WITH d AS (SELECT event_id, abs(value - 20) AS a, abs(value - 60) AS b, abs(value - 140) AS c FROM events WHERE value IS NOT NULL)
  SELECT event_id, CASE WHEN a <= b AND a <= c THEN 'low' WHEN b <= c THEN 'middle' ELSE 'high' END AS label, (a + b + c - least(a, b, c) - greatest(a, b, c)) - least(a, b, c) < 10 AS ambiguous FROM d""")
def nearest_column(t: Tables) -> DataFrame:
    near = text.nearest(F.col("value"), [("low", 20.0), ("middle", 60.0), ("high", 140.0)], 10.0)
    return t.events.where("value is not null").select("event_id", near.alias("n")).select("event_id", "n.*")


@query("""WITH i AS (SELECT o_custkey, o_orderkey, lower(o_orderpriority) AS x FROM orders WHERE o_orderstatus = 'F'), u AS (SELECT o_custkey, o_orderkey AS unit, lower(substr(o_orderpriority, 1, 3)) AS y FROM orders WHERE o_orderstatus <> 'F'),
  f AS (SELECT o_orderkey, count(DISTINCT unit) AS n, min(unit) AS one FROM i JOIN u ON i.o_custkey = u.o_custkey AND (contains(x, y) OR contains(y, x)) GROUP BY o_orderkey)
  SELECT i.o_orderkey, CASE WHEN n = 1 THEN one END AS unit, CASE WHEN n = 1 THEN 'MAPPED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'UNMAPPED' END AS state FROM i LEFT JOIN f ON i.o_orderkey = f.o_orderkey""")
def bind_items(t: Tables) -> DataFrame:
    items = t.orders.where("o_orderstatus = 'F'")
    units = t.orders.where("o_orderstatus <> 'F'").select("o_custkey", F.col("o_orderkey").alias("unit"), F.substring("o_orderpriority", 1, 3).alias("short"))
    return text.bind_items(items, units, ["o_custkey"], "o_orderkey", "o_orderpriority", "unit", "short")
