"""Queries of sources and sinks, inference, gates, reviews and grouping. What a source operator writes and reads back is the rows of a table, so SQL can say it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text_udfs
from factloom.operators import clusters, gates, inference, memo, reconcile
from factloom.plans.catalogue import Tables, query
from factloom.sources import external, tables
from factloom.sources.work import new_path, written

# --- sources and sinks ----------------------------------------------------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def csv_with_contract(t: Tables) -> DataFrame:
    path = new_path(t.spark, "csv")
    tables.write_csv([t.customer.select("c_custkey", "c_name"), t.customer.where("false").select("c_nationkey")], f"{path}/empty")
    tables.write_csv([t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")], f"{path}/all")
    return tables.read_csv(t.spark, f"{path}/all", ["c_custkey", "c_name", "c_nationkey"], key=["c_custkey"])


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type = 'click' AS is_click FROM events""")
def typed_cells(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "props", F.when(F.col("event_type") == "click", "True").otherwise("False").alias("flag"))
    got = tables.typed_cells(rows, ["props", "flag"])
    return got.select("event_id", F.try_variant_get("props_json", "$.k", "int").alias("k"), F.col("flag_bool").alias("is_click"))


def _region_files(t: Tables) -> DataFrame:
    """A scanned folder with one text file for each region: its nations, a line each."""
    path = new_path(t.spark, "files")
    text = F.concat(F.array_join(F.array_sort(F.collect_list("n_name")), "\n"), F.lit("\n"))
    files = t.nation.groupBy("n_regionkey").agg(F.encode(text, "UTF-8").alias("content"))
    for key in sorted(r[0] for r in t.region.select("r_regionkey").collect()):  # a handful of folders
        external.write_files(files.where(F.col("n_regionkey") == key).select(F.lit("nations.txt").alias("name"), "content"), f"{path}/region{key}", "name", "content")
    return tables.scan_folder(t.spark, path, "*.txt")


_FILES = "SELECT 'region' || n_regionkey AS folder, string_agg(n_name, chr(10) ORDER BY n_name) || chr(10) AS content FROM nation GROUP BY n_regionkey"


@query(f"""WITH f AS ({_FILES}) SELECT folder, CAST(length(content) AS BIGINT) AS length, sha256(content) AS sha256 FROM f""")
def folder_scan(t: Tables) -> DataFrame:
    return _region_files(t).select("folder", "length", "sha256")


@query(f"""WITH f AS ({_FILES}) SELECT folder, CAST(1 AS BIGINT) AS n_files, CAST(length(content) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS n_distinct, 'OK' AS status FROM f""")
def folder_totals(t: Tables) -> DataFrame:
    return tables.folder_totals(_region_files(t))


@query("""SELECT 'region1' AS folder, 'ADDED' AS change UNION ALL SELECT 'gone', 'REMOVED' UNION ALL SELECT 'region2', 'CHANGED'""")
def freeze_differences(t: Tables) -> DataFrame:
    files = _region_files(t)
    old = files.where("folder <> 'region1'").select(F.col("folder").alias("path"), F.when(F.col("folder") == "region2", "x").otherwise(F.col("sha256")).alias("sha256"))
    manifest = tables.freeze(old.unionByName(old.where("path = 'region0'").withColumn("path", F.lit("gone"))))
    return tables.changed_since(manifest, files.select(F.col("folder").alias("path"), "sha256")).select(F.col("path").alias("folder"), "change")


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'known ' ELSE 'new ' END || p_type AS parsed FROM part""")
def parse_or_reuse(t: Tables) -> DataFrame:
    files = t.part.select("p_partkey", "p_type", F.sha2(F.col("p_type"), 256).alias("sha256"))
    cache = files.where("p_type = 'ECONOMY'").select("sha256", F.lit("v1").alias("parser"), F.lit("known ECONOMY").alias("parsed")).distinct()
    other = cache.withColumn("parser", F.lit("v0")).withColumn("parsed", F.lit("of another parser"))
    fresh = lambda f: f.select("sha256", F.concat(F.lit("new "), "p_type").alias("parsed"))
    return tables.reuse_or_parse(files, cache.unionByName(other), fresh, "v1").select("p_partkey", "parsed")


@query("""SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'utf-16' WHEN 1 THEN 'utf-8' ELSE 'windows-1252' END AS encoding, CASE n_nationkey % 3 WHEN 0 THEN ';' WHEN 1 THEN '|' ELSE ',' END AS separator, CASE n_nationkey % 3 WHEN 2 THEN 'Größe€' ELSE 'Größe' END || n_name AS label FROM nation""")
def encoding_trial(t: Tables) -> DataFrame:
    path, k = new_path(t.spark, "encoded"), F.col("n_nationkey") % 3
    line = lambda s, label: F.concat(F.lit(f"key{s}label\r\n"), F.col("n_nationkey").cast("string"), F.lit(s), F.lit(label), F.col("n_name"), F.lit("\r\n"))
    western = F.concat(F.encode(F.concat(F.lit("key,label\r\n"), F.col("n_nationkey").cast("string"), F.lit(",Größe")), "ISO-8859-1"), F.lit(b"\x80"), F.encode(F.col("n_name"), "ISO-8859-1"))
    content = F.when(k == 0, F.encode(line(";", "Größe"), "UTF-16")).when(k == 1, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode(line("|", "Größe"), "UTF-8"))).otherwise(western)
    external.write_files(t.nation.select(F.concat(F.lit("n"), "n_nationkey", F.lit(".csv")).alias("name"), content.alias("content")), path, "name", "content")
    rows = external.read_delimited(t.spark, path)
    return rows.select(F.col("cells")["key"].cast("int").alias("n_nationkey"), "encoding", "separator", F.col("cells")["label"].alias("label"))


@query("""SELECT n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS INTEGER) AS row_no, n_name, n_nationkey FROM nation""")
def workbook_round_trip(t: Tables) -> DataFrame:
    path = new_path(t.spark, "workbooks")
    books = external.workbooks(t.nation, "n_regionkey", ["n_name", "n_nationkey", "n_regionkey"], ["n_name"])
    external.write_files(books.select(F.concat(F.lit("r"), "n_regionkey", F.lit(".xlsx")).alias("name"), "content"), path, "name", "content")
    c = F.col("cells")
    return external.read_workbooks(t.spark, path).select(c["n_regionkey"].cast("int").alias("n_regionkey"), "row_no", c["n_name"].alias("n_name"), c["n_nationkey"].cast("int").alias("n_nationkey"))


_RULES = """
- {label: cheap, pattern: '^(ECONOMY|PROMO)', priority: 1}
- {label: plain, pattern: '^STANDARD', priority: 2}
"""


@query("""SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap' WHEN p_type = 'STANDARD' THEN 'plain' ELSE 'other' END AS label FROM part""")
def rules_from_yaml(t: Tables) -> DataFrame:
    from factloom.operators import text

    rules = external.rules_from_yaml(_RULES, {"label": str, "pattern": str, "priority": int}, ["label"])
    ordered = [(r["label"], r["pattern"]) for r in sorted(rules, key=lambda r: r["priority"])]
    return t.part.select("p_partkey", text.first_label(F.col("p_type"), ordered, "other").alias("label"))


@query("""SELECT n_nationkey, n_name FROM nation""")
def jdbc_round_trip(t: Tables) -> DataFrame:
    """Through a database. A local session has one embedded in its process, reached by JDBC as servers are from everywhere; on a cluster each process would have another
    one, so there the tables are in database files, which tasks write and read in the shared folder."""
    nation = t.nation.select(F.col("n_nationkey").alias("K"), F.col("n_name").alias("NAME"))
    if _in_one_process(t.spark):
        url = f"jdbc:derby:memory:{new_path(t.spark, 'db').rsplit('-', 1)[-1]};create=true"
        external.write_jdbc(nation, url, "NATIONS", connections=2)
        got = external.read_jdbc(t.spark, url, "NATIONS", split_on="K", parts=4)
    else:
        path = new_path(t.spark, "sqlite")
        external.write_sqlite(nation, path, "NATIONS")
        got = external.read_sqlite(t.spark, path, "NATIONS", nation.schema)
    return written(got.select(F.col("K").alias("n_nationkey"), F.col("NAME").alias("n_name")), "jdbc")


def _in_one_process(spark: SparkSession) -> bool:
    """local, local[n] and local[n, m]; local-cluster has executors of their own."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


@query("""SELECT r_regionkey, r_name FROM region""")
def published_version(t: Tables) -> DataFrame:
    root, rows = new_path(t.spark, "published"), t.region.select("r_regionkey", "r_name")
    external.publish(rows.where("r_regionkey = 0"), root, "v1", expected=None)
    external.publish(rows, root, "v2", expected="v1")
    return external.current(t.spark, root)


@query("""SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey""")
def replaced_table(t: Tables) -> DataFrame:
    path = new_path(t.spark, "replaced")
    external.replace_table(t.nation.select("n_regionkey").limit(1), path)
    external.replace_table(t.nation.select("n_regionkey"), path)
    return t.spark.read.parquet(path).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE WHEN doc_id IS NULL OR coalesce(trim(d.text), '') = '' THEN 'FAILED' WHEN l.doc_id IS NULL THEN 'UNSAVED' ELSE 'SAVED' END AS status, count(*) AS n FROM (SELECT doc_id, CASE WHEN source <> 'src0' THEN text END AS text FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY 1""")
def page_snapshot(t: Tables) -> DataFrame:
    saved = t.labels.select("doc_id", F.col("doc_id").alias("document_id"))
    rows = external.snapshot(t.documents.select("doc_id", "text", "source"), saved, "doc_id", F.col("source") == "src0")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE WHEN html LIKE '%<table%' THEN 'FAILED' ELSE 'OK' END AS status, count(*) AS n FROM pages GROUP BY 1""")
def parse_status(t: Tables) -> DataFrame:
    return external.parse_status(t.pages, F.contains("html", F.lit("<table")))[1]


# --- grouping and reviews -------------------------------------------------------------------------------------------------------


@query("""SELECT user_id, event_id, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY floor(value / 50)) AS INTEGER) AS row_no FROM events WHERE value IS NOT NULL""")
def visual_rows(t: Tables) -> DataFrame:
    tokens = t.events.where("value is not null").select("user_id", "event_id", (F.floor(F.col("value") / 50) * 1000 + F.col("event_id") % 3).cast("double").alias("y"))
    return clusters.visual_rows(tokens, ["user_id"], "event_id", "y", 10.0)


@query("""SELECT DISTINCT o_custkey, CAST(o_orderkey % 7 * 10 AS BIGINT) AS a, CAST(o_orderkey % 7 * 10 + 10 AS BIGINT) AS z FROM orders""")
def spans_without_overlaps(t: Tables) -> DataFrame:
    at = F.col("o_orderkey") % 7 * 10
    whole = t.orders.select("o_custkey", at.alias("a"), (at + 10).alias("z"))
    return clusters.without_overlaps(whole.unionByName(t.orders.select("o_custkey", (at + 1).alias("a"), (at + 9).alias("z"))), ["o_custkey"], "a", "z")


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN true WHEN p_type = 'PROMO' THEN false ELSE p_type = 'STANDARD' END AS similar FROM part""")
def similar_texts(t: Tables) -> DataFrame:
    other = F.when(F.col("p_type") == "ECONOMY", "an ECONOMY part").when(F.col("p_type") == "PROMO", "quite different").when(F.col("p_type") == "STANDARD", "STANDARQ").otherwise("1234")
    return t.part.select("p_partkey", (text_udfs.similarity(F.col("p_type"), other) >= 0.85).alias("similar"))


@query("""SELECT c_custkey, k AS key, CASE k WHEN 'a' THEN CASE WHEN c_acctbal > 5000 THEN 'edited' ELSE c_mktsegment END ELSE 'piece' END AS value, CASE k WHEN 'a' THEN CASE WHEN c_acctbal > 5000 THEN 'EDITED' WHEN c_acctbal < 0 THEN 'REJECTED' ELSE 'ACCEPTED' END ELSE 'OPEN' END AS state
  FROM customer, (VALUES ('a'), ('c')) v(k) WHERE k = 'a' OR c_acctbal > 5000""")
def review_replay(t: Tables) -> DataFrame:
    items = t.customer.select("c_custkey", F.explode(F.array(F.struct(F.lit("a").alias("key"), F.col("c_mktsegment").alias("value")), F.struct(F.lit("b").alias("key"), F.lit("x").alias("value")))).alias("i")).select("c_custkey", "i.*")
    event = lambda at, action, key, new, value: F.struct(F.lit(at).alias("at"), F.lit(action).alias("action"), F.lit(key).alias("key"), F.lit(new).cast("string").alias("new_key"), F.lit(value).cast("string").alias("value"))
    rich = F.array(event(1, "MERGE", "b", "a", None), event(2, "ACCEPT", "a", None, None), event(3, "SPLIT", "a", "c", "piece"), event(4, "EDIT", "a", None, "edited"), event(5, "EDIT", "zz", None, "nothing"))
    poor, usual = F.array(event(1, "MERGE", "b", "a", None), event(2, "REJECT", "a", None, None)), F.array(event(1, "MERGE", "b", "a", None), event(2, "ACCEPT", "a", None, None), event(3, "SPLIT", "a", "a", None))
    log = t.customer.select("c_custkey", F.explode(F.when(F.col("c_acctbal") > 5000, rich).when(F.col("c_acctbal") < 0, poor).otherwise(usual)).alias("e")).select("c_custkey", "e.*")
    return clusters.replay(items, log, "c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS version FROM customer""")
def pointer_moves(t: Tables) -> DataFrame:
    modules = t.customer.select("c_custkey", "c_mktsegment")
    entries = modules.select("c_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"), (F.col("c_mktsegment") != "MACHINERY").alias("valid"))
    expected = F.when(F.col("c_mktsegment") == "FURNITURE", 7).otherwise(1)
    requests = modules.where("c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')").select("c_custkey", F.lit(2).alias("version"), expected.alias("expected_version"))
    return reconcile.promote(entries, requests, modules.select("c_custkey", F.lit(1).alias("version")), "c_custkey", "version")


# --- inference ------------------------------------------------------------------------------------------------------------------

_WORDS = "first string, last string, words int"


@query("""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE '{"echo": "' || p_type || '"}' END AS answer, CASE WHEN p_type = 'PROMO' THEN false ELSE true END AS valid FROM part""")
def memoized_calls(t: Tables) -> DataFrame:
    """Distinct requests are asked once; one that is known isn't asked, one whose answers stay invalid is flagged."""
    requests = t.part.select("p_partkey", "p_type")
    cache = t.spark.createDataFrame([("ECONOMY",)], "p_type string").select(memo.request_key("parts", F.col("p_type")).alias("key"), F.lit('{"echo": "ECONOMY"}').alias("answer"), F.lit(True).alias("valid"))
    out, _ = memo.answered(requests, "p_type", "parts", cache, memo.echo_stub, lambda a: ~F.contains(a, F.lit("PROMO")))
    return out.select("p_partkey", F.when(F.col("valid"), F.col("answer")).alias("answer"), "valid")


@query("""WITH d AS (SELECT conv_id, turn, role, string_split(text, chr(10))[1] AS episode FROM conversations), e AS (SELECT conv_id * 1000 + turn AS id, role, trim(regexp_replace(episode, '[ \\t]+', ' ', 'g')) AS episode FROM d)
  SELECT id, CAST(i AS INTEGER) AS place, i = 0 AND episode <> '' AS grounded, CASE WHEN i = 0 AND episode <> '' THEN string_split(episode, ' ')[1] END AS first, CASE WHEN i = 0 AND episode <> '' THEN string_split(episode, ' ')[-1] END AS last, CASE WHEN i = 0 AND episode <> '' THEN CAST(len(string_split(episode, ' ')) AS INTEGER) END AS words FROM e, (VALUES (0), (1)) v(i)""")
def two_pass_inference(t: Tables) -> DataFrame:
    docs = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    detect = lambda body: F.array(F.get(F.split(body, "\n"), F.lit(0)), F.lit("an episode that nobody wrote"))
    got = inference.two_pass(docs, "id", "text", detect, inference.backend("words"), _WORDS)
    return got.select("id", "place", "grounded", "answer.first", "answer.last", "answer.words")


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN split_part(p_name, ' ', 1) END AS colour, CASE WHEN p_size > 25 THEN p_size END AS size, concat_ws(',', CASE p_type WHEN 'PROMO' THEN 'colour:NO_EVIDENCE' WHEN 'STANDARD' THEN 'colour:NOT_IN_SOURCE' WHEN 'ECONOMY' THEN NULL ELSE 'colour:VALUE_NOT_IN_EVIDENCE' END, CASE WHEN p_size <= 25 THEN 'size:NOT_IN_SOURCE' END) AS flags FROM part""")
def field_abstention(t: Tables) -> DataFrame:
    first, kind = F.split("p_name", " ")[0], F.col("p_type")
    colour = F.when(kind.isin("PROMO", "STANDARD", "ECONOMY"), first).otherwise("ultraviolet")
    quote = F.when(kind == "PROMO", " ").when(kind == "STANDARD", F.concat(first, F.lit(" nowhere"))).otherwise(first)
    rows = t.part.select("p_partkey", "p_name", colour.alias("colour"), quote.alias("colour_quote"), F.col("p_size").alias("size"), F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("elsewhere").alias("size_quote"))
    return inference.supported_fields(rows, "p_name", {"colour": "colour_quote", "size": "size_quote"}).select("p_partkey", "colour", "size", "flags")


_ITEMS = "span int, kind string, value double"


def _answers(t: Tables) -> tuple[DataFrame, DataFrame]:
    item = lambda span, kind, value: F.concat(F.lit('{"span": '), span, F.lit(f', "kind": "{kind}", "value": '), value, F.lit("}"))
    v = F.col("p_size").cast("string")
    raw = F.when(F.col("p_type") == "PROMO", "no list").otherwise(F.concat(F.lit("["), item(F.lit("1"), "length", v), F.lit(","), item(F.lit("9"), "length", v), F.lit(","), item(F.lit("2"), "colour", F.lit("-1")), F.lit("]")))
    spans = t.part.select("p_partkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("span"))
    rules = lambda c: {"KIND": c("kind").isin("length", "width"), "RANGE": c("value").between(0, 30)}
    return inference.validated_items(t.part.select("p_partkey", raw.alias("raw")), "p_partkey", "raw", _ITEMS, rules, spans, "span")


@query("""SELECT p_partkey, 0 AS place, 1 AS span, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_type <> 'PROMO' AND p_size <= 30""")
def validated_items(t: Tables) -> DataFrame:
    return _answers(t)[0].select("p_partkey", "place", "item.span", "item.value")


@query("""SELECT p_partkey, CAST(NULL AS INTEGER) AS place, 'SHAPE' AS reasons FROM part WHERE p_type = 'PROMO' UNION ALL SELECT p_partkey, 0, 'RANGE' FROM part WHERE p_type <> 'PROMO' AND p_size > 30
  UNION ALL SELECT p_partkey, 1, CASE WHEN p_size > 30 THEN 'PROVENANCE,RANGE' ELSE 'PROVENANCE' END FROM part WHERE p_type <> 'PROMO' UNION ALL SELECT p_partkey, 2, 'KIND,RANGE' FROM part WHERE p_type <> 'PROMO'""")
def rejected_items(t: Tables) -> DataFrame:
    return _answers(t)[1].select("p_partkey", "place", "reasons")


@query("""SELECT s_suppkey, 2 AS attempt, '{"first": "Supplier", "last": "' || s_nationkey || '", "words": 2}' AS answer FROM supplier WHERE s_acctbal >= 0 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_acctbal < 0""")
def retained_attempts(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("Supplier "), "s_nationkey")).otherwise("alone").alias("request"))
    return inference.attempts(rows, "s_suppkey", "request", [inference.failing_stub, inference.word_stub], lambda a: F.get_json_object(a, "$.words").cast("int") == 2)[0]


@query("""SELECT CAST(a AS INTEGER) AS attempt, v AS valid, count(*) AS n FROM (SELECT 1 AS a, false AS v FROM supplier UNION ALL SELECT 2, s_acctbal >= 0 FROM supplier) GROUP BY ALL""")
def all_attempts(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("Supplier "), "s_nationkey")).otherwise("alone").alias("request"))
    log = inference.attempts(rows, "s_suppkey", "request", [inference.failing_stub, inference.word_stub], lambda a: F.get_json_object(a, "$.words").cast("int") == 2)[1]
    return log.groupBy("attempt", "valid").agg(F.count(F.lit(1)).alias("n"))


def _summaries(sent: list[tuple]) -> dict:
    """A stand-in for a summarizing model: the length of each text; a batch with a text of three letters loses its last key."""
    got = {k: str(len(text)) for k, text in sent}
    if any(text == "two" for _, text in sent):
        got.pop(sent[-1][0])
    return got


@query("""WITH n AS (SELECT o_custkey, o_orderkey, o_orderpriority AS p, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 8 AS b FROM orders), c AS (SELECT *, bool_and(p <> '1-URGENT') OVER (PARTITION BY o_custkey, b) AS complete FROM n)
  SELECT o_orderkey, CASE WHEN complete THEN CAST(length(p) AS VARCHAR) END AS summary, complete FROM c""")
def batched_summaries(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "two").otherwise(F.col("o_orderpriority")).alias("text"))
    return inference.batched(rows, "o_custkey", "o_orderkey", "text", 8, _summaries)


# --- gates ----------------------------------------------------------------------------------------------------------------------


@query("""SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2""")
def value_distributions(t: Tables) -> DataFrame:
    return gates.distributions(t.orders.withColumn("year", F.year("o_orderdate")), ["o_orderstatus", "o_orderpriority", "year"])


@query("""SELECT 'positive_price' AS gate, count(*) FILTER (WHERE NOT (l_extendedprice > 0)) AS n_violations, count(*) FILTER (WHERE NOT (l_extendedprice > 0)) = 0 AS passed FROM lineitem UNION ALL SELECT 'small_quantity', count(*) FILTER (WHERE l_quantity > 40), count(*) FILTER (WHERE l_quantity > 40) = 0 FROM lineitem
  UNION ALL SELECT 'known_flag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) = 0 FROM lineitem""")
def named_gates(t: Tables) -> DataFrame:
    return gates.named_gates(t.lineitem, {"positive_price": F.col("l_extendedprice") > 0, "small_quantity": F.col("l_quantity") <= 40, "known_flag": F.col("l_returnflag").isin("A", "N", "R")})


@query("""WITH g AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_acctbal >= 0), e AS (SELECT c_custkey AS k, CASE WHEN c_nationkey < 5 THEN 'other' ELSE c_mktsegment END AS v FROM customer WHERE c_nationkey < 20)
  SELECT coalesce(e.k, g.k) AS k, CASE WHEN e.k IS NULL THEN 'UNEXPECTED' WHEN g.k IS NULL THEN 'MISSING' WHEN e.v = g.v THEN 'MET' ELSE 'DIFFERENT' END AS state FROM e FULL JOIN g ON e.k = g.k""")
def expected_facts(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"), "c_acctbal", "c_nationkey")
    expected = rows.where("c_nationkey < 20").select("k", F.when(F.col("c_nationkey") < 5, "other").otherwise(F.col("v")).alias("v"))
    return gates.expectations(rows.where("c_acctbal >= 0").select("k", "v"), expected, ["k"], "v", closed=True)


@query("""SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_changed, count(*) FILTER (WHERE c_acctbal < 0) = 0 AS intact FROM customer GROUP BY c_mktsegment""")
def artifact_integrity(t: Tables) -> DataFrame:
    stored = t.customer.withColumn("stored", gates.artifact_digest(["c_custkey", "c_name"]))
    now = stored.withColumn("c_name", F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit("x"))).otherwise(F.col("c_name")))
    return gates.integrity(now, ["c_mktsegment"], "stored", ["c_custkey", "c_name"])


@query("""SELECT count(*) AS n, CAST(sum(CAST(concat('0x', substr(sha256('n_nationkey=' || length(CAST(n_nationkey AS VARCHAR)) || ':' || n_nationkey || '|n_name=' || length(n_name) || ':' || n_name), 1, 12)) AS BIGINT)) AS VARCHAR) AS digest FROM nation""")
def frozen_design(t: Tables) -> DataFrame:
    return gates.frozen(t.nation, ["n_nationkey", "n_name"])


@query("""WITH a AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS v FROM orders WHERE o_totalprice > 50000), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority <> '2-HIGH' THEN CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END END AS v FROM orders WHERE o_totalprice < 400000)
  SELECT CASE WHEN a.k IS NULL THEN 'ADDED' WHEN b.k IS NULL THEN 'REMOVED' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'SAME' WHEN a.v IS NULL THEN 'GAINED' WHEN b.v IS NULL THEN 'LOST' ELSE 'CHANGED' END AS change, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""")
def version_gates(t: Tables) -> DataFrame:
    k, s, p, price = F.col("o_orderkey").alias("k"), F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    old = t.orders.where(price > 50000).select(k, F.when(p != "1-URGENT", s).alias("v"))
    new = t.orders.where(price < 400000).select(k, F.when(p != "2-HIGH", F.when(price > 300000, "X").otherwise(s)).alias("v"))
    return gates.version_gates(old, new, ["k"], "v")


@query("""SELECT DISTINCT c_mktsegment AS gate, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS violation FROM customer""")
def golden_rows(t: Tables) -> DataFrame:
    """Balances read back from their texts, a gate for each segment; what one of them expects isn't so."""
    from factloom.operators import instruments

    said = F.regexp_replace(F.col("c_acctbal").cast("decimal(20,2)").cast("string"), "[.]", ",")
    computed = t.customer.select(F.col("c_mktsegment").alias("gate"), "c_custkey", F.abs(instruments.exact_number(F.regexp_replace(said, "-", ""))).cast("decimal(20,2)").alias("balance"))
    wrong = (F.col("c_mktsegment") == "BUILDING").cast("int")
    expected = t.customer.select(F.col("c_mktsegment").alias("gate"), "c_custkey", (F.abs("c_acctbal") + wrong).cast("decimal(20,2)").alias("balance"))
    return gates.golden(computed, expected, "gate")


@query("""WITH n AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
  SELECT 'orphans' AS gate, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_violations UNION ALL SELECT 'too_few', (SELECT count(*) FROM n WHERE n < 3) UNION ALL SELECT 'too_many', (SELECT count(*) FROM n WHERE n > 15)""")
def cardinality_gates(t: Tables) -> DataFrame:
    return gates.cardinalities(t.customer, t.orders, "c_custkey", "o_custkey", 3, 15)


@query("""SELECT coalesce(k.kind, r.kind) AS kind, r.kind IS NOT NULL AS registered, coalesce(n, 0) AS n FROM (SELECT kind, count(*) AS n FROM clicks GROUP BY kind) k FULL JOIN (VALUES ('click'), ('view'), ('teleport')) r(kind) ON k.kind = r.kind""")
def module_registry(t: Tables) -> DataFrame:
    return gates.registry(t.clicks, "kind", ["click", "view", "teleport"])
