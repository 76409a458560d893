"""Queries of report extractors. Reports are rendered from table columns, and the SQL states the facts that were rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import assertions, extract, reconcile, reports
from factloom.plans.catalogue import Tables, query

CONCEPTS = {"HEMORRHAGE": r"\w*blutung\w*", "ISCHEMIA": r"isch[äa]mi\w*", "EDEMA": r"ödem\w*", "FEVER": r"\bfever\b", "EPILEPSY": r"\bepilepsy\b", "MASS": r"raumforderung\w*", "TUMOR": r"\btumor\w*"}
# What a priority or a status says, and the mentions in it: concept, state, scope, qualified.
PRIORITY = {
    "1-URGENT": ("Kein Hinweis auf Blutung oder Ischämie.", [("HEMORRHAGE", "ABSENT", "CURRENT", False), ("ISCHEMIA", "ABSENT", "CURRENT", False)]),
    "2-HIGH": ("Verdacht auf Ödem, jedoch keine Blutung.", [("EDEMA", "UNCERTAIN", "CURRENT", False), ("HEMORRHAGE", "ABSENT", "CURRENT", False)]),
    "3-MEDIUM": ("Z.n. Blutung. Ödem ist nicht auszuschließen.", [("HEMORRHAGE", "PRESENT", "HISTORICAL", False), ("EDEMA", "UNCERTAIN", "CURRENT", False)]),
    "4-NOT SPECIFIED": ("No fever but known epilepsy.", [("FEVER", "ABSENT", "CURRENT", False), ("EPILEPSY", "PRESENT", "HISTORICAL", False)]),
    "5-LOW": ("Falls Ischämie auftritt, Kontrolle. Keine größere Raumforderung.", [("ISCHEMIA", "CONDITIONAL", "HYPOTHETICAL", False), ("MASS", "ABSENT", "CURRENT", True)]),
}
STATUS = {
    "F": ("Ischämie nicht nachweisbar; frische Blutung links.", [("ISCHEMIA", "ABSENT", "CURRENT", False), ("HEMORRHAGE", "PRESENT", "CURRENT", True)]),
    "O": ("Fragestellung: Blutung?", [("HEMORRHAGE", "CONTEXT_ONLY", "CURRENT", False)]),
    "P": ("Tumor wurde ausgeschlossen. Mutter mit Tumor.", [("TUMOR", "ABSENT", "CURRENT", False), ("TUMOR", "FAMILY", "CURRENT", False)]),
}


def _said(column: str, table: dict) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, (sentence, *_) in table.items():
        out = out.when(F.col(column) == value, sentence)
    return out


def _values(table: dict) -> str:
    """The mentions of a table as SQL values (key, concept, state, scope, qualified)."""
    return "VALUES " + ", ".join(f"('{k}', '{c}', '{s}', '{w}', {q})" for k, (_, own) in table.items() for c, s, w, q in own)


_FACTS = f"""p(k, concept, state, scope, qualified) AS ({_values(PRIORITY)}), s(k, concept, state, scope, qualified) AS ({_values(STATUS)}),
  m AS (SELECT o_orderkey, p.* EXCLUDE (k) FROM orders JOIN p ON o_orderpriority = p.k UNION ALL SELECT o_orderkey, s.* EXCLUDE (k) FROM orders JOIN s ON o_orderstatus = s.k)"""


def _reports(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.concat_ws(" ", _said("o_orderpriority", PRIORITY), _said("o_orderstatus", STATUS)).alias("body"))


@query(f"""WITH {_FACTS} SELECT o_orderkey, concept, state, scope, qualified, count(*) AS n FROM m GROUP BY ALL""")
def scoped_assertions(t: Tables) -> DataFrame:
    found = assertions.mentions(_reports(t), "o_orderkey", "body", CONCEPTS)
    return found.groupBy("o_orderkey", "concept", "state", "scope", "qualified").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_FACTS} SELECT o_orderkey, string_agg(DISTINCT concept, ',' ORDER BY concept) AS negatives FROM m WHERE state = 'ABSENT' AND NOT qualified GROUP BY o_orderkey""")
def negative_findings(t: Tables) -> DataFrame:
    return assertions.negative_findings(assertions.mentions(_reports(t), "o_orderkey", "body", CONCEPTS), "o_orderkey")


@query(f"""WITH {_FACTS} SELECT o_orderkey, CASE WHEN concept IN ('FEVER', 'EPILEPSY') OR state IN ('CONTEXT_ONLY', 'FAMILY', 'CONDITIONAL') OR (state = 'ABSENT' AND qualified) THEN 'rejected' WHEN state = 'PRESENT' THEN 'finding' WHEN state = 'ABSENT' THEN 'negative' ELSE 'uncertain' END AS kind, concept, count(*) AS n FROM m GROUP BY ALL""")
def report_findings(t: Tables) -> DataFrame:
    found = assertions.mentions(_reports(t), "o_orderkey", "body", CONCEPTS)
    return assertions.findings_by_kind(found, "o_orderkey", ["HEMORRHAGE", "ISCHEMIA", "EDEMA", "MASS", "TUMOR"])


@query("""SELECT c_custkey, i AS place, CASE i WHEN 0 THEN 0 WHEN 1 THEN length(c_name) + 36 ELSE length(c_name) + 56 END AS "start", CASE i WHEN 0 THEN length(c_name) + 35 WHEN 1 THEN length(c_name) + 55 ELSE length(c_name) + 56 + length(c_mktsegment) END AS "end"
  FROM customer, (VALUES (0), (1), (2)) v(i)""")
def sentence_spans(t: Tables) -> DataFrame:
    body = F.concat("c_name", F.lit(" kam am 3.5.2020 z.B. zu Dr. Meier. Kontrolle; dann ca.\n"), "c_mktsegment")
    rows = t.customer.select("c_custkey", F.posexplode(assertions.sentence_spans(body)).alias("place", "s"))
    return rows.select("c_custkey", "place", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"))


@query("""SELECT p_partkey, i AS place, CASE i WHEN 0 THEN p_name || ';' WHEN 1 THEN p_type || ', aber' ELSE p_brand || '.' END AS clause FROM part, (VALUES (0), (1), (2)) v(i)""")
def clause_spans(t: Tables) -> DataFrame:
    body = F.concat("p_name", F.lit("; "), "p_type", F.lit(", aber "), "p_brand", F.lit("."))
    rows = t.part.withColumn("body", body).select("p_partkey", "body", F.posexplode(assertions.clause_spans(F.col("body"))).alias("place", "s"))
    return rows.select("p_partkey", "place", F.substr("body", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("clause"))


@query("""SELECT l_returnflag, l_linestatus, CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'ACUTE' WHEN 'AO' THEN 'INTERVAL_NEW' WHEN 'RF' THEN 'CHRONIC' WHEN 'RO' THEN 'CONFLICT' WHEN 'NF' THEN 'SUBACUTE' END AS age, count(*) AS n FROM lineitem GROUP BY ALL""")
def lesion_ages(t: Tables) -> DataFrame:
    said = F.when(F.col("l_returnflag") == "A", F.when(F.col("l_linestatus") == "F", "frische Blutung").otherwise("neu aufgetretene Läsion")).when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "F", "alter Infarkt").otherwise("akute und chronische Anteile"))
    said = said.otherwise(F.when(F.col("l_linestatus") == "F", "subakuter Infarkt").otherwise("Infarkt"))
    rows = t.lineitem.withColumn("age", assertions.lesion_age(said))
    return rows.groupBy("l_returnflag", "l_linestatus", "age").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'SEARCH' WHEN 'view' THEN 'SEARCH' WHEN 'purchase' THEN 'RISK_CONTEXT' ELSE 'ASSERTION' END AS observation_type, CASE event_type WHEN 'click' THEN 'HOLTER' WHEN 'view' THEN 'ECG' ELSE 'OTHER' END AS modality FROM events""")
def observation_types(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    said = F.when(kind == "click", "Im Holter kein Vorhofflimmern").when(kind == "view", "EKG unauffällig").when(kind == "purchase", "erhöhtes Risiko").otherwise("bekanntes Vorhofflimmern")
    state = F.when(kind == "purchase", "UNCERTAIN").when(kind == "click", "ABSENT").otherwise("PRESENT")
    return t.events.select("event_id", *assertions.observation(said, state))


# --- extractors -----------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'HEMOGLOBIN' WHEN 'O' THEN 'CREATININE' END AS analyte, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS VARCHAR) || ',5' END AS value, CASE o_orderstatus WHEN 'F' THEN 'g/dL' WHEN 'O' THEN 'mg/dL' END AS unit,
    10.0 AS low, CAST(o_custkey AS DOUBLE) AS high, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN_LABEL' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'NO_VALUE' END, CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN_UNIT' END) AS issues
  FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT'""")
def measurement_rows(t: Tables) -> DataFrame:
    q, flag = F.col("o_custkey"), F.col("o_orderstatus")
    word = lambda x, w: F.struct(F.lit(x).alias("x"), w.alias("word"))
    said = F.array(word(300, F.concat(F.lit("10-"), q)), word(10, F.when(flag == "F", "Hämoglobin").when(flag == "O", "Kreatinin").otherwise("Seite")), word(200, F.when(flag == "F", "g/dL").when(flag == "O", "mg/dL").otherwise("von")), word(100, F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(q, F.lit(",5"))).otherwise("folgt")))
    tokens = t.orders.select("o_orderkey", F.lit(1).alias("row"), F.explode(said).alias("w")).select("o_orderkey", "row", "w.*")
    got = reports.measurements(tokens, ["o_orderkey"], "row", "x", "word", {"hämoglobin": "HEMOGLOBIN", "kreatinin": "CREATININE"}, ["g/dL", "mg/dL"])
    return got.select("o_orderkey", "analyte", "value", "unit", F.col("reference.low").cast("double").alias("low"), F.col("reference.high").cast("double").alias("high"), "issues")


@query("""SELECT o_orderkey, i AS study_no, CASE i WHEN 1 THEN 'CT' ELSE CASE WHEN o_orderstatus = 'F' THEN 'MRI' ELSE 'PET' END END AS modality, CASE i WHEN 1 THEN 'BRAIN' ELSE CASE WHEN o_orderstatus = 'F' THEN 'SPINE' ELSE 'OTHER' END END AS region,
  CASE i WHEN 1 THEN CAST(o_orderdate AS DATE) ELSE CAST(o_orderdate AS DATE) + 3 END AS study_date, NOT (i = 2 AND o_orderpriority = '1-URGENT') AS performed FROM orders, (VALUES (1), (2)) v(i)""")
def study_discovery(t: Tables) -> DataFrame:
    day = lambda n: F.date_format(F.date_add("o_orderdate", n), "d.M.yyyy")
    second = F.when(F.col("o_orderstatus") == "F", "MRT Wirbelsäule vom ").otherwise("PET Ganzkörper vom ")
    body = F.concat(F.lit("Sehr geehrte Kollegen\nCT Schädel vom "), day(0), F.lit("\nunauffällig\n"), second, day(3), F.lit("\n"), F.when(F.col("o_orderpriority") == "1-URGENT", "Untersuchung abgebrochen").otherwise("regelrecht"))
    return reports.studies(t.orders.withColumn("body", body), "o_orderkey", "body").select("o_orderkey", "study_no", "modality", "region", "study_date", "performed")


def _stroke_notes(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "d.M.yyyy")
    second = F.when(F.col("o_orderstatus") == "F", "\nTIA\nmRS 3\n").otherwise("\nIntrazerebrale Blutung\nBei Entlassung mRS 3, NIHSS 50\n")
    body = F.concat(F.lit("NIHSS 1\nIschämischer Infarkt am "), day, F.lit("\nBei Aufnahme NIHSS "), F.col("o_custkey") % 20, F.when(F.col("o_orderpriority") == "1-URGENT", "\nLyse\nMoCA 20").otherwise("\nMoCA 20"), second)
    return t.orders.withColumn("body", body)


@query("""SELECT o_orderkey, CAST(1 AS BIGINT) AS event_no, 'ISCHEMIC_STROKE' AS kind, CAST(o_orderdate AS DATE) AS event_date, o_orderpriority = '1-URGENT' AS lysis FROM orders
  UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderstatus = 'F' THEN 'TIA' ELSE 'HEMORRHAGE' END, NULL, false FROM orders""")
def stroke_events(t: Tables) -> DataFrame:
    events, _ = reports.events_with_scales(_stroke_notes(t), "o_orderkey", "body")
    return events.select("o_orderkey", "event_no", "kind", "event_date", "lysis")


@query("""SELECT o_orderkey, CAST(0 AS BIGINT) AS event_no, 'NIHSS' AS scale, CAST(NULL AS VARCHAR) AS timepoint, 1 AS value, true AS review FROM orders
  UNION ALL SELECT o_orderkey, 1, 'NIHSS', 'ADMISSION', CAST(o_custkey % 20 AS INTEGER), false FROM orders UNION ALL SELECT o_orderkey, 1, 'MoCA', 'ADMISSION', 20, false FROM orders
  UNION ALL SELECT o_orderkey, 2, 'mRS', CASE WHEN o_orderstatus <> 'F' THEN 'DISCHARGE' END, 3, o_orderstatus = 'F' FROM orders UNION ALL SELECT o_orderkey, 2, 'NIHSS', 'DISCHARGE', NULL, true FROM orders WHERE o_orderstatus <> 'F'""")
def scale_assessments(t: Tables) -> DataFrame:
    return reports.events_with_scales(_stroke_notes(t), "o_orderkey", "body")[1]


@query("""SELECT p_partkey, 0 AS place, 'MMSE' AS test, CASE WHEN p_size <= 30 THEN p_size END AS score, CASE WHEN p_size <= 30 THEN 'ACCEPTED' ELSE 'OUTSIDE' END AS reason FROM part
  UNION ALL SELECT p_partkey, 1, 'MoCA', NULL, CASE p_type WHEN 'ECONOMY' THEN 'RANGE' WHEN 'STANDARD' THEN 'PERCENT' WHEN 'PROMO' THEN 'PLANNED' ELSE 'OTHER_SCALE' END FROM part UNION ALL SELECT p_partkey, 2, 'MMSE', NULL, 'NO_NUMBER' FROM part""")
def test_passages(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    second = F.when(kind == "ECONOMY", "20-24").when(kind == "STANDARD", "80 %").when(kind == "PROMO", "geplant für 2 Wochen").otherwise("20/28")
    body = F.concat(F.lit("Im MMSE vom 3.4.1997 "), "p_size", F.lit("/30 Punkte. Der MoCA "), second, F.lit(". MMSE nicht möglich. Danach 12 Tage."))
    return reports.test_passages(t.part.withColumn("body", body), "p_partkey", "body", ["MMSE", "MoCA"], 30)


test_passages.__test__ = False  # no test of pytest


@query("""SELECT s_suppkey, 'ICA' AS vessel, 'LEFT' AS side, CAST(s_nationkey * 5 AS INTEGER) AS stenosis, CAST(NULL AS BOOLEAN) AS occlusion, true AS plaque, s_nationkey * 10.0 AS psv, false AS review FROM supplier WHERE s_nationkey * 5 <= 100
  UNION ALL SELECT s_suppkey, 'ICA', 'LEFT', NULL, NULL, true, s_nationkey * 10.0, false FROM supplier WHERE s_nationkey * 5 > 100
  UNION ALL SELECT s_suppkey, v, s, NULL, NULL, CAST(NULL AS BOOLEAN), NULL, true FROM supplier, (VALUES ('CCA'), ('MCA')) a(v), (VALUES ('LEFT'), ('RIGHT')) b(s)
  UNION ALL SELECT s_suppkey, 'BASILAR', 'MIDLINE', CASE WHEN s_acctbal < 0 THEN 100 END, CASE WHEN s_acctbal < 0 THEN true END, NULL, NULL, false FROM supplier UNION ALL SELECT s_suppkey, 'VERTEBRAL', 'UNKNOWN', NULL, NULL, false, NULL, true FROM supplier""")
def vessel_findings(t: Tables) -> DataFrame:
    body = F.concat(F.lit("Duplex\nACI links: Plaque, Stenose "), F.col("s_nationkey") * 5, F.lit(" %, PSV "), F.format_string("%.1f", F.col("s_nationkey") / 10.0), F.lit(" m/s\nACC und ACM bds 40 %\nA. basilaris "), F.when(F.col("s_acctbal") < 0, "Verschluss").otherwise("kein Verschluss"), F.lit("\nVertebralis ohne Plaque"))
    return reports.vessel_rows(t.supplier.withColumn("body", body), "s_suppkey", "body").drop("line_no")


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'PAUSED' WHEN '2-HIGH' THEN 'STOPPED' WHEN '3-MEDIUM' THEN 'STARTED' ELSE 'NOT_STARTED' END AS action, CASE o_orderpriority WHEN '1-URGENT' THEN 'BLEEDING' WHEN '2-HIGH' THEN 'INTERVENTION' END AS reason,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS "day", o_orderpriority = '3-MEDIUM' AS planned FROM orders""")
def treatment_decisions(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    said = F.when(p == "1-URGENT", F.concat(F.lit("Antikoagulation wurde am "), F.date_format("o_orderdate", "d.M.yyyy"), F.lit(" wegen Blutung pausiert."))).when(p == "2-HIGH", "Die Antikoagulation vor dem Eingriff abgesetzt.").when(p == "3-MEDIUM", "Antikoagulation sollte begonnen werden.").otherwise("Antikoagulation nicht begonnen.")
    body = F.concat(F.lit("Aufnahme wegen Sturz. "), said, F.lit(" Kontrolle am 1.1.2000."))
    return reports.decisions(t.orders.withColumn("body", body), "o_orderkey", "body", "(?i)antikoagul").drop("place")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderdate AS DATE) WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) END AS "day",
  CASE o_orderpriority WHEN '1-URGENT' THEN 'DIRECT' WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'PROCEDURE_DATE' WHEN 'O' THEN 'SEVERAL_DATES' ELSE 'DIRECT' END WHEN '3-MEDIUM' THEN 'PARTIAL_DATE' WHEN '4-NOT SPECIFIED' THEN 'BEFORE_DISEASE' ELSE CASE WHEN o_orderstatus = 'F' THEN 'NOT_ADJACENT' ELSE 'NONE' END END AS relation FROM orders""")
def owned_disease_dates(t: Tables) -> DataFrame:
    p, s, day = F.col("o_orderpriority"), F.col("o_orderstatus"), F.date_format("o_orderdate", "d.M.yyyy")
    high = F.when(s == "F", F.concat(F.lit("Epilepsie, MRT vom "), day)).when(s == "O", F.concat(F.lit("Epilepsie seit "), day, F.lit(" oder "), day)).otherwise(F.concat(F.lit("Epilepsie links (ED "), day, F.lit(")")))
    said = F.when(p == "1-URGENT", F.concat(F.lit("Bekannte Epilepsie seit "), day)).when(p == "2-HIGH", high).when(p == "3-MEDIUM", F.concat(F.lit("Epilepsie seit "), F.year("o_orderdate")))
    said = said.when(p == "4-NOT SPECIFIED", F.concat(F.lit("Am "), day, F.lit(" Sturz bei Epilepsie"))).when(s == "F", F.concat(F.lit("Epilepsie und Infarkt am "), day)).otherwise("Epilepsie")
    return t.orders.select("o_orderkey", reports.owned_date(said, "(?i:epilepsie)", r"\b(?:MRT|Biopsie|Kontrolle)\b", r"\b(?:am|seit|vom|links|rechts|ED|Erstdiagnose)\b", r"(?:Erstdiagnose|seit)(?: am)?").alias("r")).select("o_orderkey", "r.*")


@query("""WITH r AS (SELECT o_custkey, 'status' AS field, o_orderstatus AS value, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank, o_orderkey AS source FROM orders UNION ALL SELECT o_custkey, 'year', CAST(year(o_orderdate) AS VARCHAR), CASE WHEN o_totalprice > 200000 THEN 1 ELSE 2 END, o_orderkey FROM orders),
  m AS (SELECT o_custkey, field, min(rank) AS rank FROM r GROUP BY ALL)
  SELECT r.o_custkey, r.field, CASE WHEN min(value) = max(value) THEN min(value) END AS value, CASE WHEN min(value) = max(value) THEN 'PATCH' ELSE 'CONFLICT' END AS state, r.rank, count(DISTINCT source) AS n_sources FROM r JOIN m ON r.o_custkey = m.o_custkey AND r.field = m.field AND r.rank = m.rank GROUP BY r.o_custkey, r.field, r.rank""")
def field_patches(t: Tables) -> DataFrame:
    says = F.array(F.struct(F.lit("status").alias("field"), F.col("o_orderstatus").alias("value"), F.substring("o_orderpriority", 1, 1).cast("int").alias("rank")), F.struct(F.lit("year").alias("field"), F.year("o_orderdate").cast("string").alias("value"), F.when(F.col("o_totalprice") > 200000, 1).otherwise(2).alias("rank")))
    rows = t.orders.select("o_custkey", F.col("o_orderkey").alias("source"), F.explode(says).alias("e")).select("o_custkey", "source", "e.*")
    return reports.field_patch(rows, "o_custkey", "field", "value", "rank", "source")


@query("""WITH m AS (SELECT o_custkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'stroke' WHEN '2' THEN 'stroke' WHEN '3' THEN 'epilepsy' ELSE lower(o_orderpriority) END AS disease, CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 3 ELSE 1 END AS r, CAST(o_orderdate AS DATE) AS d FROM orders)
  SELECT o_custkey, disease, CASE max(r) WHEN 4 THEN 'PRESENT' WHEN 3 THEN 'UNCERTAIN' ELSE 'ABSENT' END AS state, min(d) AS first_day, count(*) AS n_mentions, count(DISTINCT d) AS n_days FROM m GROUP BY ALL""")
def disease_identities(t: Tables) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "PRESENT").when(F.col("o_orderstatus") == "O", "UNCERTAIN").otherwise("ABSENT")
    rows = t.orders.select("o_custkey", "o_orderpriority", state.alias("state"), F.to_date("o_orderdate").alias("day"))
    return reports.disease_identities(rows, "o_custkey", "o_orderpriority", [("stroke", "^[12]-"), ("epilepsy", "^3-")], "state", "day")


@query("""SELECT p_partkey, i AS level, CASE i WHEN 0 THEN CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap' ELSE 'UNCLASSIFIED' END ELSE lower(p_type) END AS node FROM part, (VALUES (0), (1)) v(i) WHERE i = 0 OR p_type IN ('ECONOMY', 'PROMO')""")
def label_taxonomy(t: Tables) -> DataFrame:
    return reports.taxonomy_levels(t.part, "p_partkey", "p_type", [("^ECO", ["cheap", "economy"]), ("^PRO", ["cheap", "promo"])])


@query("""WITH c AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN DATE '1950-02-03' ELSE make_date(CAST(1940 + o_custkey % 40 AS INTEGER), 5, 6) END AS d, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS tier FROM orders),
  m AS (SELECT o_custkey, min(tier) FILTER (WHERE d IS NOT NULL) AS tier FROM c GROUP BY o_custkey)
  SELECT m.o_custkey, CASE WHEN min(d) = max(d) THEN min(d) END AS birth_date, CASE WHEN min(d) IS NULL THEN 'UNREADABLE' WHEN min(d) = max(d) THEN 'LINKED' ELSE 'CONFLICT' END AS status, m.tier FROM m LEFT JOIN c ON m.o_custkey = c.o_custkey AND m.tier = c.tier GROUP BY m.o_custkey, m.tier""")
def birth_date_candidates(t: Tables) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "P", "unbekannt").when(F.col("o_orderpriority") == "1-URGENT", "3.2.1950").otherwise(F.concat((F.lit(1940) + F.col("o_custkey") % 40).cast("string"), F.lit("-05-06")))
    tier = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    return reports.birth_dates(t.orders.select("o_custkey", raw.alias("raw"), tier.alias("tier")), "o_custkey", "raw", "tier")


@query("""WITH h AS (SELECT doc_id, len(regexp_extract_all(text, 'the ')) AS a, len(regexp_extract_all(text, '[0-9]{4}')) AS b, len(regexp_extract_all(text, 'qqqq')) AS c FROM documents)
  SELECT 'article' AS rule, count(*) FILTER (WHERE a > 0) AS n_docs, CAST(sum(a) AS BIGINT) AS n_hits, min(doc_id) FILTER (WHERE a > 0) AS example FROM h UNION ALL SELECT 'digits', count(*) FILTER (WHERE b > 0), CAST(sum(b) AS BIGINT), min(doc_id) FILTER (WHERE b > 0) FROM h
  UNION ALL SELECT 'never', count(*) FILTER (WHERE c > 0), CAST(sum(c) AS BIGINT), min(doc_id) FILTER (WHERE c > 0) FROM h""")
def rule_table_statistics(t: Tables) -> DataFrame:
    return reports.rule_hits(t.documents, "doc_id", "text", [("article", "the "), ("digits", "[0-9]{4}"), ("never", "qqqq")])


@query("""SELECT o_orderpriority, v AS variable, count(*) FILTER (WHERE s AND e) AS k, count(*) FILTER (WHERE s AND e IS NOT NULL) AS n FROM (
    SELECT o_orderpriority, 'dear_final' AS v, o_totalprice > 200000 AS s, o_orderstatus = 'F' AS e FROM orders UNION ALL SELECT o_orderpriority, 'dear_early', o_totalprice > 200000, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) < 1998 END FROM orders
    UNION ALL SELECT o_orderpriority, 'all_final', true, o_orderstatus = 'F' FROM orders UNION ALL SELECT o_orderpriority, 'all_early', true, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) < 1998 END FROM orders) GROUP BY ALL""")
def exposure_variables(t: Tables) -> DataFrame:
    early = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate") < 1998)
    return reports.crossed_flags(t.orders, ["o_orderpriority"], {"dear": F.col("o_totalprice") > 200000, "all": F.lit(True)}, {"final": F.col("o_orderstatus") == "F", "early": early})


@query("""WITH s AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'F' THEN 'CT' ELSE 'MRI' END AS kind FROM orders), n AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS nd, CASE WHEN o_orderpriority <= '2-HIGH' THEN 'CT' ELSE 'MRI' END AS kind, 'note ' || o_orderkey AS body FROM orders WHERE o_orderpriority <> '5-LOW'),
  f AS (SELECT o_orderkey, count(*) AS c, min(CASE WHEN n.kind = 'CT' THEN 'CCT ' ELSE 'MRT ' END || body) AS one FROM s JOIN n ON s.o_custkey = n.o_custkey AND s.kind = n.kind AND abs(date_diff('day', s.d, n.nd)) <= 30 GROUP BY o_orderkey)
  SELECT s.o_orderkey, coalesce(c, 0) AS n_notes, CASE WHEN c = 1 THEN one END AS evidence FROM s LEFT JOIN f ON s.o_orderkey = f.o_orderkey""")
def literal_scan_evidence(t: Tables) -> DataFrame:
    scans = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"), F.when(F.col("o_orderstatus") == "F", "CT").otherwise("MRI").alias("kind"))
    said = F.when(F.col("o_orderpriority") <= "2-HIGH", "CCT note ").when(F.col("o_orderpriority") == "5-LOW", "other ").otherwise("MRT note ")
    notes = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("nd"), F.concat(said, "o_orderkey").alias("body"))
    got = reports.literal_evidence(scans, notes, "o_custkey", "o_orderkey", "d", "kind", "nd", "body", {"CT": r"\bCCT\b", "MRI": r"\bMRT\b"}, 30)
    return got.select("o_orderkey", "n_notes", "evidence")


def _recordings(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    said = F.when(p == "1-URGENT", "Spikes links temporal, jedoch keine Verlangsamung.").when(p == "2-HIGH", "Theta-Verlangsamung beidseits; Sharp Waves rechts.").otherwise("Kein Herd.")
    base = F.concat(F.lit("Grundrhythmus "), F.when(F.col("o_orderstatus") == "F", "8-9/s, reaktiv. ").when(F.col("o_orderstatus") == "O", "10 Hz, nicht reaktiv. ").otherwise("wechselnd. "))
    return t.orders.withColumn("body", F.concat(base, said))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 8 WHEN 'O' THEN 10 END AS background_low, CASE o_orderstatus WHEN 'F' THEN 9 WHEN 'O' THEN 10 END AS background_high, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS reactive FROM orders""")
def recording_values(t: Tables) -> DataFrame:
    return reports.recording_findings(_recordings(t), "o_orderkey", "body")[0]


@query("""SELECT o_orderkey, 'EPILEPTIFORM' AS kind, 'LEFT' AS side, true AS focal FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_orderkey, 'SLOWING', 'BILATERAL', false FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT o_orderkey, 'EPILEPTIFORM', 'RIGHT', false FROM orders WHERE o_orderpriority = '2-HIGH'""")
def recording_findings(t: Tables) -> DataFrame:
    return reports.recording_findings(_recordings(t), "o_orderkey", "body")[1].drop("place")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus || ' b c d e f g h i j' WHEN o_orderpriority = '2-HIGH' THEN o_orderstatus || ' b c d e f g h' ELSE lower(o_orderpriority) END AS t FROM orders),
  g AS (SELECT o_custkey, lower(t) AS t, min(o_orderkey) AS id FROM r GROUP BY ALL),
  l AS (SELECT a.o_custkey, a.t, coalesce((SELECT arg_max(b.id, length(b.t)) FROM g b WHERE b.o_custkey = a.o_custkey AND length(b.t) > length(a.t) AND contains(b.t, a.t)), a.id) AS leader FROM g a)
  SELECT r.o_custkey, r.o_orderkey, l.leader FROM r JOIN l ON r.o_custkey = l.o_custkey AND lower(r.t) = l.t""")
def copy_clusters(t: Tables) -> DataFrame:
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    body = F.when(p == "1-URGENT", F.concat(s, F.lit(" b c d e  f g h i j"))).when(p == "2-HIGH", F.concat(s, F.lit(" b c d e f g h "))).otherwise(p)
    return reports.copy_clusters(t.orders.withColumn("body", body), "o_custkey", "o_orderkey", "body")


@query("""WITH o AS (SELECT o_custkey, count(*) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_order FROM orders GROUP BY o_custkey), l AS (SELECT o_custkey, count(*) AS n_items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
  e AS (SELECT user_id, count(*) AS n_events, count(DISTINCT event_type) AS n_types FROM events GROUP BY user_id), c AS (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id), d AS (SELECT doc_id, count(*) AS n_docs, max(lang) AS lang FROM documents GROUP BY doc_id),
  b AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id), p AS (SELECT page_id, count(*) AS n_pages FROM pages GROUP BY page_id), s AS (SELECT s_suppkey, count(*) AS n_suppliers FROM supplier GROUP BY s_suppkey)
  SELECT c_custkey, n_name, r_name, n_orders, last_order, n_items, quantity, n_events, n_types, n_turns, n_docs, d.lang, quality, n_pages, n_suppliers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey LEFT JOIN e ON c_custkey = user_id LEFT JOIN c ON c_custkey = conv_id LEFT JOIN d ON c_custkey = d.doc_id LEFT JOIN b ON c_custkey = b.doc_id LEFT JOIN p ON c_custkey = page_id LEFT JOIN s ON c_custkey = s_suppkey""")
def ten_table_star(t: Tables) -> DataFrame:
    key, n = "c_custkey", F.count(F.lit(1))
    on = lambda df, c: df.withColumn(key, F.col(c).cast("long"))
    base = t.customer.select(key, "c_nationkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(key, "n_name", "r_name")
    items = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return extract.wide(base, key, [
        (on(t.orders, "o_custkey"), [n.alias("n_orders"), F.max(F.to_date("o_orderdate")).alias("last_order")]),
        (on(items, "o_custkey"), [n.alias("n_items"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")]),
        (on(t.events, "user_id"), [n.alias("n_events"), F.count_distinct("event_type").alias("n_types")]),
        (on(t.conversations, "conv_id"), [n.alias("n_turns")]), (on(t.documents, "doc_id"), [n.alias("n_docs"), F.max("lang").alias("lang")]),
        (on(t.labels, "doc_id"), [F.max("quality").alias("quality")]), (on(t.pages, "page_id"), [n.alias("n_pages")]), (on(t.supplier, "s_suppkey"), [n.alias("n_suppliers")]),
    ])


@query("""WITH r AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS review FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id), s AS (SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id)
  SELECT c_custkey, c_mktsegment, review, CASE WHEN review IS NULL THEN 'UNREVIEWED' WHEN review = 'purchase' THEN 'ACCEPTED' ELSE 'REVIEWED' END AS review_state, coalesce(n, 0) AS n, kinds FROM customer LEFT JOIN r ON c_custkey = r.user_id LEFT JOIN s ON c_custkey = s.user_id""")
def reviews_and_summaries(t: Tables) -> DataFrame:
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    reviews = reconcile.latest_per_key(events.where("event_type in ('click', 'purchase')").select("c_custkey", "ts", "event_id", F.col("event_type").alias("review")), ["c_custkey"], ["ts", "event_id"])
    out = extract.wide(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", [(reviews, [F.max("review").alias("review")]), (events, [F.count(F.lit(1)).alias("n"), F.count_distinct("event_type").alias("kinds")])])
    state = F.when(F.col("review").isNull(), "UNREVIEWED").when(F.col("review") == "purchase", "ACCEPTED").otherwise("REVIEWED")
    return out.withColumn("review_state", state).withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
