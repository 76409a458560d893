"""Queries of `operators.extract`: owned values, grouped evidence, conserved counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import extract
from factloom.plans.catalogue import Tables, query


@query("""WITH l AS (SELECT l_orderkey, l_linenumber || '. part ' || l_partkey AS s FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY s) AS r, count(*) OVER (PARTITION BY l_orderkey) AS c FROM l),
  o AS (SELECT *, coalesce(sum(length(s) + 1) OVER (PARTITION BY l_orderkey ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM n)
  SELECT l_orderkey, CAST(split_part(s, '.', 1) AS INTEGER) AS item_no, CAST(st AS BIGINT) AS "start", CAST(st + length(s) + CASE WHEN r < c THEN 1 ELSE 0 END AS BIGINT) AS "end" FROM o""")
def numbered_items(t: Tables) -> DataFrame:
    line = F.concat(F.col("l_linenumber").cast("string"), F.lit(". part "), F.col("l_partkey").cast("string"))
    docs = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    rows = extract.numbered_items(docs, "l_orderkey", "body")
    return rows.select("l_orderkey", "item_no", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""WITH p AS (SELECT p_partkey, p_type, p_size FROM part) SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN CASE WHEN p_size % 3 = 0 THEN NULL
  WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size % 3 = 1 THEN 'eco + std' ELSE 'eco' END WHEN p_type = 'PROMO' THEN CASE WHEN p_size % 3 = 1 THEN 'pro + std' ELSE 'pro' END ELSE 'std' END END AS generic FROM p""")
def compound_generics(t: Tables) -> DataFrame:
    name = F.concat_ws(" / ", "p_type", F.when(F.col("p_size") % 3 == 0, "unheard of").when(F.col("p_size") % 3 == 1, "Standard"))
    return t.part.select("p_partkey", extract.compound_generic(name, {"economy": "eco", "standard": "std", "promo": "pro"}).alias("generic"))


@query("""WITH p AS (SELECT p_partkey, p_retailprice AS v, CASE WHEN p_size % 4 <> 0 THEN 905 END AS lo, CASE WHEN p_size % 5 <> 0 THEN 915 END AS hi FROM part)
  SELECT p_partkey, CASE WHEN v < lo THEN 'LOW' WHEN v > hi THEN 'HIGH' WHEN v >= lo AND v <= hi THEN 'NORMAL' END AS flag FROM p""")
def reference_flags(t: Tables) -> DataFrame:
    low, high = F.when(F.col("p_size") % 4 != 0, 905), F.when(F.col("p_size") % 5 != 0, 915)
    return t.part.select("p_partkey", extract.reference_flag(F.col("p_retailprice"), low, high).alias("flag"))


@query("""WITH e AS (SELECT event_id, user_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS y, event_type FROM events), c AS (SELECT * FROM e WHERE event_type <> 'click'),
  g AS (SELECT c.event_id, c.y - h.y AS gap, min(h.event_id) AS l, max(h.event_id) AS h FROM c JOIN e h ON c.user_id = h.user_id AND h.event_type = 'click' AND c.y > h.y AND c.y - h.y <= 36000 GROUP BY 1, 2),
  b AS (SELECT event_id, arg_min(CASE WHEN l = h THEN l ELSE -1 END, gap) AS a FROM g GROUP BY event_id) SELECT c.event_id, nullif(b.a, -1) AS above FROM c LEFT JOIN b ON c.event_id = b.event_id""")
def header_above(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("y"), "event_type")
    out = extract.header_above(e.where("event_type <> 'click'"), e.where("event_type = 'click'"), ["user_id"], "event_id", "y", "event_id", "y", 36000)
    return out.select("event_id", "above")


@query("""WITH s AS (SELECT DISTINCT regexp_replace(c_name, '\\s', '', 'g') AS s FROM customer WHERE c_acctbal > 0) SELECT c_custkey FROM customer WHERE regexp_replace(c_name, '\\s', '', 'g') NOT IN (SELECT s FROM s)""")
def unseen_lines(t: Tables) -> DataFrame:
    spaced = t.customer.select("c_custkey", F.regexp_replace("c_name", "#", " # ").alias("line"))
    return extract.unseen(spaced, t.customer.where("c_acctbal > 0"), "line", "c_name").select("c_custkey")


@query("""WITH c AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.;!?]+[ \\n]|\\n'), lambda c: contains(c, 'die') AND contains(c, 'und')) AS f FROM documents)
  SELECT doc_id, len(f) AS n_owned, md5(trim(f[1], ' ')) AS quote FROM c WHERE len(f) > 0""")
def owned_clauses(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", extract.owned_clauses(F.col("text"), "die", "und").alias("f")).where(F.size("f") > 0)
    return rows.select("doc_id", F.size("f").cast("long").alias("n_owned"), F.md5(F.trim(F.col("f")[0]).cast("binary")).alias("quote"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 4) THEN CAST(o_orderdate AS DATE) END AS "date", CASE o_orderkey % 5 WHEN 1 THEN 'SEVERAL' WHEN 2 THEN 'BLOCKED' WHEN 3 THEN 'NONE' ELSE 'OWNED' END AS basis FROM orders""")
def owned_dates(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "d.M.yyyy")
    later = F.date_format(F.date_add("o_orderdate", 9), "d.M.yyyy")
    said = F.when(k == 0, F.concat(F.lit("order of "), d, F.lit("; invoice of "), later)).when(k == 1, F.concat(F.lit("order of "), d, F.lit(" and "), later))
    said = said.when(k == 2, F.concat(F.lit("order planned for "), d)).when(k == 3, F.concat(F.lit("invoice of "), d)).otherwise(F.concat(F.lit("order "), d, F.lit("; order planned for "), later, F.lit("; order "), d))
    return t.orders.select("o_orderkey", extract.owned_date(said, "order", "planned").alias("o")).select("o_orderkey", "o.*")


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN (p_size + 0.5) * 1000 END AS value, CASE p_size % 5 WHEN 0 THEN 'VALID' WHEN 1 THEN 'VALID' WHEN 2 THEN 'COMPARATOR' WHEN 3 THEN 'UNIT' ELSE 'NONE' END AS status FROM part""")
def unit_values(t: Tables) -> DataFrame:
    k, n = F.col("p_size") % 5, F.col("p_size").cast("string")
    line = F.when(k == 0, F.concat(F.lit("weight "), n, F.lit(",5 g"))).when(k == 1, F.concat(F.lit("its weight "), n, F.lit(".5 kg"))).when(k == 2, F.concat(F.lit("weight <"), n, F.lit(" g"))).when(k == 3, F.concat(F.lit("weight "), n, F.lit(" stone"))).otherwise("not weighed")
    return t.part.select("p_partkey", extract.unit_value(line, "weight", {"g": 1.0, "kg": 1000.0}).alias("u")).select("p_partkey", "u.*")


@query("""WITH p AS (SELECT p_partkey, p_size % 6 AS k, p_size % 31 AS n FROM part) SELECT p_partkey, 0 AS place, CASE WHEN k IN (0, 1) THEN n END AS score,
  CASE k WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'ACCEPTED' WHEN 2 THEN 'RANGE' WHEN 3 THEN 'PERCENT' WHEN 4 THEN 'OTHER_SCALE' ELSE 'NO_NUMBER' END AS reason FROM p UNION ALL SELECT p_partkey, 1, NULL, 'OUTSIDE' FROM p""")
def adjacent_scores(t: Tables) -> DataFrame:
    k, n = F.col("p_size") % 6, (F.col("p_size") % 31).cast("string")
    said = F.when(k == 0, F.concat(F.lit("TEST "), n, F.lit("/30"))).when(k == 1, F.concat(F.lit("TEST: "), n)).when(k == 2, F.concat(F.lit("TEST "), n, F.lit("-30"))).when(k == 3, F.concat(F.lit("TEST "), n, F.lit(" %"))).when(k == 4, F.concat(F.lit("TEST "), n, F.lit("/20"))).otherwise("TEST planned")
    docs = t.part.select("p_partkey", F.concat(said, F.lit(", then TEST 99")).alias("body"))
    return extract.adjacent_scores(docs, "p_partkey", "body", "TEST", 30)


@query("""SELECT p_partkey, trim(CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN p_type ELSE p_name END) AS head, CASE WHEN p_type = 'ECONOMY' AND p_size > 25 THEN 'EXCLUDED' WHEN p_type = 'ECONOMY' THEN 'CANDIDATE' WHEN p_retailprice > 910 THEN 'AMBIGUOUS' ELSE 'EXCLUDED' END AS status,
  CASE WHEN p_type = 'ECONOMY' AND p_size > 25 THEN 'too large' WHEN p_type = 'ECONOMY' THEN 'cheap' WHEN p_retailprice > 910 THEN 'dear' ELSE 'no rule' END AS reason FROM part""")
def status_with_reason(t: Tables) -> DataFrame:
    k, cheap = F.col("p_size") % 3, F.col("p_type") == "ECONOMY"
    label = F.when(k == 0, F.concat_ws(", ", "p_type", "p_name")).when(k == 1, F.concat_ws(" : ", "p_type", "p_brand")).otherwise(F.col("p_name"))
    rules = [("EXCLUDED", "too large", cheap & (F.col("p_size") > 25)), ("CANDIDATE", "cheap", cheap), ("AMBIGUOUS", "dear", F.col("p_retailprice") > 910)]
    return t.part.select("p_partkey", extract.head_of_label(label).alias("head"), extract.decide_with_reason(rules, ("EXCLUDED", "no rule")).alias("d")).select("p_partkey", "head", "d.*")


@query("""WITH x(t, level, node) AS (VALUES ('ECONOMY', 0, 'goods'), ('ECONOMY', 1, 'cheap'), ('PROMO', 0, 'goods'), ('PROMO', 1, 'offers'), ('PROMO', 2, 'week')) SELECT p_partkey, level, node FROM part LEFT JOIN x ON p_type = t""")
def taxonomy_levels(t: Tables) -> DataFrame:
    return extract.with_taxonomy(t.part.select("p_partkey", "p_type"), "p_type", {"ECONOMY": ["goods", "cheap"], "PROMO": ["goods", "offers", "week"]}).select("p_partkey", "level", "node")


@query("""WITH l AS (SELECT l_partkey, min(s_nationkey) FILTER (WHERE l_quantity > 49 AND l_returnflag = 'R') AS a, max(s_nationkey) FILTER (WHERE l_quantity > 49 AND l_returnflag = 'R') AS b FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey)
  SELECT p_partkey, CASE WHEN a = b THEN a END AS s_nationkey, CASE WHEN a IS NULL THEN 'UNLINKED' WHEN a = b THEN 'OWNED' ELSE 'REFERENCE_ONLY' END AS state FROM part LEFT JOIN l ON p_partkey = l_partkey""")
def unique_owner_links(t: Tables) -> DataFrame:
    links = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    owner = F.when((F.col("l_quantity") > 49) & (F.col("l_returnflag") == "R"), F.col("s_nationkey"))  # owners of other lines are unknown
    links = links.select(F.col("l_partkey").alias("p_partkey"), owner.alias("s_nationkey"))
    return extract.unique_owner(t.part.select("p_partkey"), links, "p_partkey", "s_nationkey")


@query("""WITH o AS (SELECT o_custkey, count(*) AS n_orders, bool_or(o_orderstatus = 'P') AS any_open, round(max(o_totalprice), 2) AS dearest FROM orders GROUP BY o_custkey),
  e AS (SELECT user_id, count(*) AS n_events, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY user_id)
  SELECT c_custkey, c_mktsegment, n_orders, any_open, dearest, n_events, types FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id""")
def wide_row_per_entity(t: Tables) -> DataFrame:
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    per_order = [F.count(F.lit(1)).alias("n_orders"), F.bool_or(F.col("o_orderstatus") == "P").alias("any_open"), F.round(F.max("o_totalprice"), 2).alias("dearest")]
    per_event = [F.count(F.lit(1)).alias("n_events"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types")]
    return extract.wide(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", [(orders, per_order), (events, per_event)])


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'LOST' WHEN '1-URGENT' THEN 'REPEATED' END AS state FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT') UNION ALL SELECT -1, 'INVENTED'""")
def conservation_check(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey")
    invented = t.spark.range(1).select(F.lit(-1).cast("long").alias("o_orderkey"))
    part = lambda p: t.orders.where(p).select("o_orderkey")
    return extract.conserved(o, part("o_orderpriority <> '3-MEDIUM'").unionByName(part("o_orderpriority = '1-URGENT'")).unionByName(invented), "o_orderkey")


@query("""SELECT p_brand, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS l_returnflag, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS p_type, count(*) AS n, count(DISTINCT l_orderkey) AS n_sources,
  CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def group_exposures(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_returnflag", F.to_date("l_shipdate").alias("day")).join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return extract.exposures(rows, ["p_brand"], ["l_returnflag", "p_type"], "l_orderkey", "day")


@query("""SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 'look' ELSE event_type END AS event_type, count(*) AS n FROM events GROUP BY ALL""")
def relabel_and_regroup(t: Tables) -> DataFrame:
    return extract.relabelled(t.events, "event_type", {"click": "look", "view": "look"}).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT conv_id, bool_or(length(text) > 200) AS "any", bool_and(length(text) > 200) AS "all", arg_max(role, turn) AS last_status, count(*) AS n FROM conversations GROUP BY conv_id""")
def segments_rolled_up(t: Tables) -> DataFrame:
    return extract.rolled_up(t.conversations, ["conv_id"], F.length("text") > 200, ["turn"], "role")


@query("""WITH r AS (SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank, o_orderstatus AS v FROM orders), m AS (SELECT o_custkey, min(rank) AS rank FROM r GROUP BY o_custkey)
  SELECT m.o_custkey, m.rank, CASE WHEN min(v) = max(v) THEN min(v) END AS value, CASE WHEN min(v) = max(v) THEN 'AGREED' ELSE 'CONFLICT' END AS state FROM m JOIN r ON m.o_custkey = r.o_custkey AND m.rank = r.rank GROUP BY m.o_custkey, m.rank""")
def ranked_evidence(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"), "o_orderstatus")
    return extract.ranked_value(rows, ["o_custkey"], "rank", "o_orderstatus")


@query("""SELECT event_id, CASE WHEN event_id % 77 = 0 THEN 'k,size' WHEN event_id % 7 = 0 THEN 'k' ELSE 'size' END AS differs FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""")
def replay_check(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    stored = t.events.select("event_id", "props", F.when(F.col("event_id") % 7 == 0, -1).otherwise(k).alias("k"), F.when(F.col("event_id") % 11 != 0, F.length("props")).alias("size"))
    return extract.replay_mismatches(stored, {"k": k, "size": F.length("props")}).select("event_id", "differs")


@query("""SELECT o_orderkey, 'O!=' || o_orderstatus AS flag FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'""")
def flags_to_append(t: Tables) -> DataFrame:
    stored = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("state"))
    found = stored.withColumn("state", F.lit("O"))
    there = t.orders.where("o_orderpriority = '5-LOW'").select("o_orderkey", F.concat(F.lit("O!="), "o_orderstatus").alias("flag"))
    return extract.new_flags(found, stored, "o_orderkey", "state", there)


@query("""SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS INTEGER) AS place, turn, role FROM conversations""")
def nested_rows(t: Tables) -> DataFrame:
    return extract.unnested(extract.nested(t.conversations, "conv_id", ["turn", "role"], ["turn", "role"], "turns"), "conv_id", "turns")


@query("""WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o, bool_or(o_orderstatus = 'P') AS p FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey)
  SELECT o_custkey, CASE WHEN f AND o THEN 'mixed' WHEN f THEN 'final' WHEN o THEN 'open' ELSE 'pending' END AS pattern FROM s""")
def pattern_of_findings(t: Tables) -> DataFrame:
    per = t.orders.where("o_totalprice > 300000").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s"))
    return per.select("o_custkey", extract.pattern_of(F.col("s"), [("mixed", ["F", "O"]), ("final", ["F"]), ("open", ["O"])], "pending").alias("pattern"))


@query("""SELECT o_custkey, o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_review, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'P')) AS n_queue FROM orders GROUP BY ALL""")
def module_queues(t: Tables) -> DataFrame:
    return extract.queues(t.orders, ["o_custkey", "o_orderpriority"], F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P")


@query("""WITH r AS (SELECT s_nationkey, s_name, CAST(floor(s_acctbal / 2000) AS BIGINT) AS rank FROM supplier), m AS (SELECT s_nationkey, max(rank) AS rank, count(DISTINCT s_name) AS n_sources FROM r GROUP BY s_nationkey)
  SELECT m.s_nationkey, max(r.s_name) AS s_name, m.rank, m.n_sources FROM m JOIN r ON m.s_nationkey = r.s_nationkey AND m.rank = r.rank GROUP BY m.s_nationkey, m.rank, m.n_sources""")
def representative_source(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_nationkey", "s_name", F.floor(F.col("s_acctbal") / 2000).alias("rank"))
    return extract.representative(rows, ["s_nationkey"], "s_name", "rank")
