"""Queries of the clinical instruments. Their inputs are rendered from the driver tables (three-valued flags from digits of prices, texts from columns); the SQL
decides from the same inputs in its own way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import instruments
from factloom.plans.catalogue import Tables, query


def _flags(names: list[str], first: int = 1) -> str:
    """Three-valued flags: digits of the order's price in base three."""
    return ", ".join(f"CASE CAST(floor(o_totalprice / {3 ** (i + first)}) AS BIGINT) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS {n}" for i, n in enumerate(names))


def _orders(t: Tables, sql: str) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", *_split(sql))


def _split(sql: str) -> list[str]:
    """Top-level parts of a select list."""
    out, depth, part = [], 0, ""
    for c in sql:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


_AGE = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 40 + CAST(floor(o_totalprice) AS INTEGER) % 50 END AS age"


@query("""WITH n AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '-' || p_size WHEN p_size % 5 = 1 THEN p_size || ',5' WHEN p_size % 5 = 2 THEN p_size || '.25' WHEN p_size % 5 = 3 THEN '' || p_size ELSE 'x' || p_size END AS raw,
    CASE WHEN p_size % 4 = 0 THEN '10 - 20,5' WHEN p_size % 4 = 1 THEN '> 30' WHEN p_size % 4 = 2 THEN '<=40' ELSE 'none' END AS ref, p_size FROM part),
  v AS (SELECT p_partkey, CASE p_size % 5 WHEN 1 THEN p_size + 0.5 WHEN 2 THEN p_size + 0.25 WHEN 3 THEN p_size + 0.0 END AS x, CASE p_size % 4 WHEN 0 THEN 10.0 WHEN 1 THEN 30.0 END AS low, CASE p_size % 4 WHEN 0 THEN 20.5 WHEN 2 THEN 40.0 END AS high, p_size % 4 = 1 AS strict FROM n)
  SELECT p_partkey, CAST(x AS DOUBLE) AS value, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, CASE WHEN x IS NULL OR (low IS NULL AND high IS NULL) THEN 'UNKNOWN' WHEN x < low OR (x = low AND strict) THEN 'LOW' WHEN x > high THEN 'HIGH' ELSE 'NORMAL' END AS flag FROM v""")
def measured_against_reference(t: Tables) -> DataFrame:
    s = F.col("p_size")
    raw = F.when(s % 5 == 0, F.concat(F.lit("-"), s)).when(s % 5 == 1, F.concat(s, F.lit(",5"))).when(s % 5 == 2, F.concat(s, F.lit(".25"))).when(s % 5 == 3, s.cast("string")).otherwise(F.concat(F.lit("x"), s))
    ref = F.when(s % 4 == 0, "10 - 20,5").when(s % 4 == 1, "> 30").when(s % 4 == 2, "<=40").otherwise("none")
    rows = t.part.select("p_partkey", instruments.exact_number(raw).alias("x"), ref.alias("t"), instruments.reference_range(ref).alias("r"))
    flag = instruments.against_reference(F.col("x"), F.col("r.low"), F.col("r.high"), F.col("t"))
    return rows.select("p_partkey", F.col("x").cast("double").alias("value"), F.col("r.low").cast("double").alias("low"), F.col("r.high").cast("double").alias("high"), flag.alias("flag"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, l_linenumber % 7 AS k FROM lineitem),
  b AS (SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN q WHEN 1 THEN NULL WHEN 2 THEN q * 60 WHEN 3 THEN NULL WHEN 4 THEN q WHEN 6 THEN 180 END AS low, CASE k WHEN 0 THEN q WHEN 1 THEN q WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN q + 5 WHEN 6 THEN 180 END AS high,
    CASE k WHEN 0 THEN 'EXACT' WHEN 1 THEN 'APPROXIMATE' WHEN 2 THEN 'APPROXIMATE' WHEN 4 THEN 'RANGE' WHEN 6 THEN 'APPROXIMATE' END AS kind FROM d)
  SELECT l_orderkey, l_linenumber, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, kind, CASE WHEN low IS NULL OR high IS NULL THEN 'UNKNOWN' WHEN high < 1 THEN '<1 min' WHEN low >= 1 AND high < 6 THEN '1–5 min' WHEN low >= 6 AND high < 31 THEN '6–30 min'
    WHEN low >= 31 AND high < 61 THEN '31–60 min' WHEN low >= 61 AND high < 181 THEN '1–3 h' WHEN low >= 181 AND high < 1441 THEN '3–24 h' WHEN low >= 1441 THEN '>24 h' ELSE 'UNKNOWN' END AS bin FROM b""")
def stated_durations(t: Tables) -> DataFrame:
    q, k = F.col("l_quantity").cast("int"), F.col("l_linenumber") % 7
    said = F.when(k == 0, F.concat(F.lit("Dauer "), q, F.lit(" Minuten"))).when(k == 1, F.concat(F.lit("bis zu "), q, F.lit(" Min."))).when(k == 2, F.concat(F.lit("seit "), q, F.lit(" Stunden")))
    said = said.when(k == 3, F.concat(q, F.lit(" Minuten, dann 2 Tage"))).when(k == 4, F.concat(q, F.lit("-"), q + 5, F.lit(" min"))).when(k == 5, F.lit("kurz")).otherwise("etwa drei Stunden")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", instruments.duration_minutes(said).alias("d"))
    return rows.select("l_orderkey", "l_linenumber", "d.low", "d.high", "d.kind", instruments.duration_bin(F.col("d.low"), F.col("d.high")).alias("bin"))


_STROKE = _flags(["c", "h", "d", "s2", "v"]) + ", " + _AGE + ", o_orderpriority <> '5-LOW' AS af"


@query(f"""WITH f AS (SELECT o_orderkey, {_STROKE} FROM orders), p AS (SELECT *, CASE WHEN age >= 75 THEN 2 WHEN age >= 65 THEN 1 WHEN age IS NOT NULL THEN 0 END AS a,
    [CAST(c AS INTEGER), CAST(h AS INTEGER), CAST(d AS INTEGER), 2 * CAST(s2 AS INTEGER), CAST(v AS INTEGER)] AS x FROM f),
  s AS (SELECT *, x[1] + x[2] + x[3] + x[4] + x[5] + a AS score, coalesce(list_sum(x), 0) + coalesce(a, 0) AS low,
    coalesce(list_sum(x), 0) + coalesce(a, 2) + (x[1] IS NULL)::INTEGER + (x[2] IS NULL)::INTEGER + (x[3] IS NULL)::INTEGER + 2 * (x[4] IS NULL)::INTEGER + (x[5] IS NULL)::INTEGER AS high FROM p)
  SELECT o_orderkey, CASE WHEN af THEN score END AS score, CASE WHEN af THEN CAST(low AS INTEGER) END AS score_min, CASE WHEN af THEN CAST(high AS INTEGER) END AS score_max,
    CASE WHEN af THEN concat_ws(',', CASE WHEN c IS NULL THEN 'C' END, CASE WHEN h IS NULL THEN 'H' END, CASE WHEN d IS NULL THEN 'D' END, CASE WHEN s2 IS NULL THEN 'S2' END, CASE WHEN v IS NULL THEN 'V' END, CASE WHEN a IS NULL THEN 'A' END) END AS missing,
    CASE WHEN NOT af THEN NULL WHEN score = 0 THEN 'LOW_RISK' WHEN score = 1 THEN 'CONSIDER_OAC' WHEN score IS NOT NULL THEN 'OAC_RECOMMENDED' WHEN low >= 2 THEN 'OAC_RECOMMENDED_FROM_MINIMUM_CONFIRMED_SCORE' ELSE 'RECOMMENDATION_RANGE_UNCERTAIN' END AS advice FROM s""")
def stroke_risk_bounds(t: Tables) -> DataFrame:
    f = _orders(t, _STROKE)
    return f.select("o_orderkey", *instruments.stroke_risk(F.col("age"), {k: F.col(k.lower()) for k in ("C", "H", "D", "S2", "V")}, F.col("af")))


_BLEED = _flags(["male", "history", "bleeding", "antiplatelet"]) + ", " + _AGE + ", CASE WHEN o_orderpriority <> '1-URGENT' THEN 10 + CAST(floor(o_totalprice / 7) AS INTEGER) % 6 END AS hb, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 34 + CAST(floor(o_totalprice / 11) AS INTEGER) % 9 END AS hct, CASE WHEN o_orderpriority <> '2-HIGH' THEN 40 + CAST(floor(o_totalprice / 13) AS INTEGER) % 40 END AS egfr"


@query(f"""WITH f AS (SELECT o_orderkey, {_BLEED} FROM orders), c AS (SELECT *, CASE WHEN male THEN hb < 13 WHEN NOT male THEN hb < 12 END AS a, CASE WHEN male THEN hct < 40 WHEN NOT male THEN hct < 36 END AS b FROM f),
  p AS (SELECT o_orderkey, CAST(age >= 75 AS INTEGER) AS p1, CASE WHEN a OR b OR history THEN 2 WHEN NOT history AND (a IS NOT NULL OR b IS NOT NULL) THEN 0 END AS p2, 2 * CAST(bleeding AS INTEGER) AS p3, CAST(antiplatelet AS INTEGER) AS p4, CAST(egfr < 60 AS INTEGER) AS p5 FROM c)
  SELECT o_orderkey, p1 + p2 + p3 + p4 + p5 AS score, CASE WHEN p1 + p2 + p3 + p4 + p5 IS NULL THEN 'NOT_ASSESSABLE' WHEN p1 + p2 + p3 + p4 + p5 <= 2 THEN 'LOW' WHEN p1 + p2 + p3 + p4 + p5 = 3 THEN 'INTERMEDIATE' ELSE 'HIGH' END AS category,
    concat_ws(',', CASE WHEN p1 IS NULL THEN 'age' END, CASE WHEN p2 IS NULL THEN 'anemia' END, CASE WHEN p3 IS NULL THEN 'bleeding_history' END, CASE WHEN p4 IS NULL THEN 'antiplatelet' END, CASE WHEN p5 IS NULL THEN 'renal' END) AS missing FROM p""")
def bleeding_risk(t: Tables) -> DataFrame:
    c = F.col
    return _orders(t, _BLEED).select("o_orderkey", *instruments.bleeding_risk(c("age"), c("male"), c("hb"), c("hct"), c("history"), c("bleeding"), c("antiplatelet"), c("egfr")))


_STATUS = _flags(["applicable", "previous"]) + ", " + _AGE + ", CASE o_orderpriority WHEN '1-URGENT' THEN 'NCSE_IN_COMA' WHEN '2-HIGH' THEN 'GENERALIZED_CONVULSIVE' WHEN '3-MEDIUM' THEN 'FOCAL' WHEN '5-LOW' THEN 'other' END AS seizure, CASE CAST(floor(o_totalprice / 17) AS BIGINT) % 4 WHEN 0 THEN 'AWAKE' WHEN 1 THEN 'STUPOROUS' WHEN 2 THEN 'COMATOSE' END AS conscious"


@query(f"""WITH f AS (SELECT o_orderkey, {_STATUS} FROM orders), p AS (SELECT o_orderkey, applicable, 2 * CAST(age >= 65 AS INTEGER) AS p1, 1 - CAST(previous AS INTEGER) AS p2, CASE seizure WHEN 'NCSE_IN_COMA' THEN 2 WHEN 'GENERALIZED_CONVULSIVE' THEN 1 WHEN 'FOCAL' THEN 0 END AS p3, CASE WHEN conscious = 'AWAKE' THEN 0 WHEN conscious IS NOT NULL THEN 1 END AS p4 FROM f)
  SELECT o_orderkey, CASE WHEN applicable THEN p1 + p2 + p3 + p4 END AS score, CASE WHEN applicable IS NOT true THEN 'NOT_APPLICABLE' WHEN p1 + p2 + p3 + p4 IS NULL THEN 'NOT_ASSESSABLE' WHEN p1 + p2 + p3 + p4 <= 2 THEN 'FAVORABLE_STESS' ELSE 'HIGHER_RISK_STESS' END AS interpretation,
    CASE WHEN applicable THEN concat_ws(',', CASE WHEN p1 IS NULL THEN 'age' END, CASE WHEN p2 IS NULL THEN 'previous_seizures' END, CASE WHEN p3 IS NULL THEN 'seizure_type' END, CASE WHEN p4 IS NULL THEN 'consciousness' END) END AS missing FROM p""")
def status_severity(t: Tables) -> DataFrame:
    c = F.col
    return _orders(t, _STATUS).select("o_orderkey", *instruments.status_severity(c("applicable"), c("age"), c("previous"), c("seizure"), c("conscious")))


_COUNT = "CASE WHEN CAST(floor(o_totalprice / {d}) AS BIGINT) % 5 < 4 THEN CAST(floor(o_totalprice / {d}) AS BIGINT) % 5 % 3 END AS {n}"
_MRI = ", ".join([
    "CASE CAST(floor(o_totalprice / 3) AS BIGINT) % 7 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS presentation", "CASE CAST(floor(o_totalprice / 9) AS BIGINT) % 7 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS mri_adequate",
    "CASE CAST(floor(o_totalprice / 27) AS BIGINT) % 7 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS blood_sensitive", "CASE CAST(floor(o_totalprice / 81) AS BIGINT) % 5 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS counts_complete",
    _flags(["pvs", "wmh"], 5), *[f"CASE CAST(floor(o_totalprice / {d}) AS BIGINT) % 9 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS {n}" for n, d in (("deep_ich", 5), ("deep_cmb", 15), ("alternative", 45), ("pathology_only", 135))],
    *[_COUNT.format(d=d, n=n) for n, d in (("lobar_ich", 2), ("lobar_cmb", 10), ("css_foci", 50))], "CASE o_orderpriority WHEN '1-URGENT' THEN 'AUTOPSY' WHEN '2-HIGH' THEN 'BIOPSY' END AS pathology", _AGE])
_CT = _flags(["mri_available"], 7) + ", " + ", ".join(f"CASE CAST(floor(o_totalprice / {d}) AS BIGINT) % 6 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS {n}" for n, d in (("ct_available", 4), ("ct_lobar", 8), ("spontaneous", 16), ("context", 32))) + ", " + _flags(["projections", "subarachnoid", "e4"], 1)
_MRI_SQL = """CASE WHEN presentation AND pathology_only AND pathology = 'AUTOPSY' THEN 'DEFINITE' WHEN presentation AND pathology_only AND pathology = 'BIOPSY' THEN 'PROBABLE_WITH_PATHOLOGY'
    WHEN age < 50 OR NOT presentation OR alternative OR deep_ich OR deep_cmb THEN 'DOES_NOT_MEET'
    WHEN age IS NULL OR presentation IS NULL OR mri_adequate IS NOT true OR blood_sensitive IS NOT true OR deep_ich IS NULL OR deep_cmb IS NULL OR alternative IS NULL THEN 'NOT_ASSESSABLE'
    WHEN n >= 2 OR (n >= 1 AND (pvs OR wmh)) THEN 'PROBABLE' WHEN counts_complete IS NOT true OR lobar_ich IS NULL OR lobar_cmb IS NULL OR css_foci IS NULL THEN 'NOT_ASSESSABLE'
    WHEN n = 1 OR pvs OR wmh THEN 'POSSIBLE' WHEN pvs IS NULL OR wmh IS NULL THEN 'NOT_ASSESSABLE' ELSE 'DOES_NOT_MEET' END"""
_CT_SQL = """CASE WHEN mri_available THEN 'NOT_APPLICABLE' WHEN mri_available IS NULL THEN 'NOT_ASSESSABLE' WHEN NOT ct_available OR NOT ct_lobar OR NOT spontaneous OR NOT context THEN 'NOT_APPLICABLE'
    WHEN ct_available IS NULL OR ct_lobar IS NULL OR spontaneous IS NULL OR context IS NULL THEN 'NOT_ASSESSABLE'
    WHEN e4 AND subarachnoid THEN 'HIGH_PROBABILITY' WHEN projections IS NULL OR subarachnoid IS NULL THEN 'NOT_ASSESSABLE'
    WHEN projections AND subarachnoid THEN 'HIGH_PROBABILITY' WHEN e4 IS NULL AND (projections OR subarachnoid) THEN 'INTERMEDIATE_OR_UNCERTAIN' WHEN e4 IS NULL THEN 'LOW_PROBABILITY'
    WHEN projections THEN 'NOT_ASSESSABLE' WHEN subarachnoid OR e4 THEN 'INTERMEDIATE_OR_UNCERTAIN' ELSE 'LOW_PROBABILITY' END"""
_MRI_KEYS = ("age", "presentation", "mri_adequate", "blood_sensitive", "lobar_ich", "lobar_cmb", "css_foci", "counts_complete", "pvs", "wmh", "deep_ich", "deep_cmb", "alternative", "pathology", "pathology_only")
_CT_KEYS = {"mri_available": "mri_available", "ct_available": "ct_available", "lobar_ich": "ct_lobar", "spontaneous": "spontaneous", "context": "context", "projections": "projections", "subarachnoid": "subarachnoid", "e4": "e4"}


@query(f"""WITH f AS (SELECT o_orderkey, {_MRI} FROM orders), s AS (SELECT *, coalesce(lobar_ich, 0) + coalesce(lobar_cmb, 0) + coalesce(css_foci, 0) AS n FROM f), c AS (SELECT *, {_MRI_SQL} AS classification FROM s)
  SELECT o_orderkey, classification, CASE WHEN classification <> 'NOT_ASSESSABLE' THEN '' WHEN age IS NULL OR presentation IS NULL OR mri_adequate IS NOT true OR blood_sensitive IS NOT true OR deep_ich IS NULL OR deep_cmb IS NULL OR alternative IS NULL THEN
    concat_ws(',', CASE WHEN age IS NULL THEN 'UNKNOWN_AGE' END, CASE WHEN presentation IS NULL THEN 'UNKNOWN_PRESENTATION' END, CASE WHEN mri_adequate IS NULL THEN 'UNKNOWN_MRI_ADEQUATE' END, CASE WHEN blood_sensitive IS NULL THEN 'UNKNOWN_BLOOD_SENSITIVE' END,
      CASE WHEN deep_ich IS NULL THEN 'UNKNOWN_DEEP_ICH' END, CASE WHEN deep_cmb IS NULL THEN 'UNKNOWN_DEEP_CMB' END, CASE WHEN alternative IS NULL THEN 'UNKNOWN_ALTERNATIVE' END, CASE WHEN mri_adequate = false THEN 'INADEQUATE_MRI' END, CASE WHEN blood_sensitive = false THEN 'NO_BLOOD_SENSITIVE_SEQUENCE' END)
    WHEN counts_complete IS NOT true THEN 'INCOMPLETE_COUNTS' WHEN lobar_ich IS NULL OR lobar_cmb IS NULL OR css_foci IS NULL THEN 'UNKNOWN_COUNT' ELSE 'UNKNOWN_WHITE_MATTER' END AS holds FROM c""")
def mri_criteria(t: Tables) -> DataFrame:
    return _orders(t, _MRI).select("o_orderkey", instruments.mri_criteria({k: F.col(k) for k in _MRI_KEYS}).alias("r")).select("o_orderkey", "r.*")


@query(f"""WITH f AS (SELECT o_orderkey, {_CT} FROM orders) SELECT o_orderkey, {_CT_SQL} AS classification,
  mri_available IS NOT DISTINCT FROM false AND ct_available IS true AND ct_lobar IS true AND spontaneous IS true AND context IS true AS applicable,
  CASE WHEN mri_available IS NOT DISTINCT FROM false THEN CASE WHEN e4 IS NOT NULL THEN 'ORIGINAL' WHEN projections IS NOT NULL AND subarachnoid IS NOT NULL THEN 'SIMPLIFIED' ELSE 'UNKNOWN' END ELSE 'UNKNOWN' END AS version FROM f""")
def ct_criteria(t: Tables) -> DataFrame:
    return _orders(t, _CT).select("o_orderkey", instruments.ct_criteria({k: F.col(c) for k, c in _CT_KEYS.items()}).alias("r")).select("o_orderkey", "r.classification", "r.applicable", "r.version")


@query(f"""WITH f AS (SELECT o_orderkey, {_MRI}, {_CT} FROM orders), s AS (SELECT *, coalesce(lobar_ich, 0) + coalesce(lobar_cmb, 0) + coalesce(css_foci, 0) AS n FROM f), c AS (SELECT *, {_MRI_SQL} AS mri, {_CT_SQL} AS ct FROM s),
  k AS (SELECT *, CASE WHEN (mri_adequate IS true) <> (mri_available IS true) THEN 'CONFLICT' WHEN mri_available THEN 'MRI' WHEN mri_available = false AND ct_available AND ct_lobar AND spontaneous AND context THEN 'CT' ELSE 'NONE' END AS framework FROM c)
  SELECT framework, CASE framework WHEN 'MRI' THEN mri WHEN 'CT' THEN ct WHEN 'NONE' THEN 'NOT_ASSESSABLE' END AS classification, count(*) AS n FROM k GROUP BY 1, 2""")
def imaging_framework(t: Tables) -> DataFrame:
    rows = _orders(t, _MRI + ", " + _CT)
    mri, ct = instruments.mri_criteria({k: F.col(k) for k in _MRI_KEYS}), instruments.ct_criteria({k: F.col(c) for k, c in _CT_KEYS.items()})
    routed = rows.withColumn("m", mri).withColumn("c", ct).select(instruments.imaging_framework(F.col("mri_adequate"), F.col("mri_available"), F.col("m"), F.col("c"), strict=False).alias("r"))
    return routed.groupBy("r.framework", "r.classification").agg(F.count(F.lit(1)).alias("n"))


_EPISODE = _flags(["asserted", "resolved", "spreading", "recurrent", "stereotyped", "positive", "negative"]) + ", CASE CAST(floor(o_totalprice) AS BIGINT) % 8 WHEN 0 THEN 'PERSISTENT' WHEN 1 THEN 'PROGRESSIVE' WHEN 2 THEN 'MIXED' WHEN 3 THEN 'FLUCTUATING_WITHOUT_CLEAR_RESOLUTION' WHEN 4 THEN NULL ELSE 'TRANSIENT_FULLY_RESOLVED' END AS course, CASE o_orderstatus WHEN 'F' THEN 'FOCAL' WHEN 'O' THEN 'NONFOCAL' END AS focality, CASE o_orderpriority WHEN '1-URGENT' THEN 'COGNITIVE' WHEN '2-HIGH' THEN 'MOTOR' WHEN '3-MEDIUM' THEN 'SENSORY' END AS domain, CASE WHEN CAST(floor(o_totalprice / 6) AS BIGINT) % 4 > 0 THEN CAST(floor(o_totalprice / 6) AS BIGINT) % 2000 END AS minutes"


@query(f"""WITH f AS (SELECT o_orderkey, {_EPISODE} FROM orders), g AS (SELECT *, course IN ('PERSISTENT', 'PROGRESSIVE', 'MIXED', 'FLUCTUATING_WITHOUT_CLEAR_RESOLUTION') AS lasting, course = 'TRANSIENT_FULLY_RESOLVED' AND resolved AS gone, focality = 'FOCAL' AND domain IN ('MOTOR', 'SENSORY') AS typical FROM f)
  SELECT o_orderkey, CASE WHEN asserted IS NOT true THEN 'UNCLASSIFIABLE' WHEN lasting THEN 'NEGATIVE' WHEN gone AND (minutes > 1440 OR focality = 'NONFOCAL') THEN 'NEGATIVE' WHEN gone AND typical AND (spreading OR (recurrent AND stereotyped) OR (positive AND negative)) THEN 'STRONG' WHEN gone AND typical THEN 'POSSIBLE' ELSE 'UNCLASSIFIABLE' END AS screen,
    CASE WHEN asserted IS NOT true THEN 'UNCLASSIFIABLE' WHEN lasting THEN CASE WHEN course = 'MIXED' THEN 'UNCLASSIFIABLE' WHEN course = 'PROGRESSIVE' AND domain = 'COGNITIVE' THEN 'PROGRESSIVE_COGNITIVE' WHEN focality = 'FOCAL' THEN 'PERSISTENT_FOCAL' WHEN course LIKE 'FLUCT%' THEN 'UNCLASSIFIABLE' ELSE 'PERSISTENT_OTHER' END
      WHEN gone AND minutes > 1440 THEN 'UNCLASSIFIABLE' WHEN gone AND focality = 'NONFOCAL' THEN 'TRANSIENT_ATYPICAL' WHEN gone AND typical THEN CASE WHEN spreading OR (recurrent AND stereotyped) OR (positive AND negative) THEN 'TYPICAL' ELSE 'POSSIBLE' END ELSE 'UNCLASSIFIABLE' END AS phenotype,
    CASE WHEN positive AND negative THEN 'MIXED' WHEN positive THEN 'POSITIVE' WHEN negative THEN 'NEGATIVE' ELSE 'UNKNOWN' END AS polarity FROM g""")
def transient_episodes(t: Tables) -> DataFrame:
    c = F.col
    own = instruments.transient_episode(*[c(x) for x in ("asserted", "course", "resolved", "focality", "domain", "minutes", "minutes", "spreading", "recurrent", "stereotyped", "positive", "negative")])
    return _orders(t, _EPISODE).select("o_orderkey", *own)


_FACT_NO = "CASE CAST(l_quantity AS INTEGER) % 12 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(instruments.FUNCTION_FACTS)) + " END"
_FACTS = f"l_orderkey, {_FACT_NO} AS fact, CASE l_returnflag WHEN 'R' THEN 'PRESENT' WHEN 'A' THEN 'ABSENT' ELSE CASE WHEN l_linenumber > 3 THEN 'UNKNOWN' ELSE 'PRESENT' END END AS state"
_HAS = {f: f"(bool_or(fact = '{f}' AND state = 'PRESENT') IS true AND bool_or(fact = '{f}' AND state = 'ABSENT') IS NOT true)" for f in instruments.FUNCTION_FACTS}
_NOT = {f: f"(bool_or(fact = '{f}' AND state = 'ABSENT') IS true AND bool_or(fact = '{f}' AND state = 'PRESENT') IS NOT true)" for f in instruments.FUNCTION_FACTS}
_BOTH = " OR ".join(f"(bool_or(fact = '{f}' AND state = 'PRESENT') IS true AND bool_or(fact = '{f}' AND state = 'ABSENT') IS true)" for f in instruments.FUNCTION_FACTS)


@query(f"""WITH f AS (SELECT {_FACTS} FROM lineitem), r AS (SELECT l_orderkey, CASE WHEN {_BOTH} OR ({_HAS['walking_independent']} AND ({_HAS['walking_human_assistance']} OR {_HAS['bedbound']})) OR ({_HAS['independent_ADL']} AND {_HAS['needs_ADL_help']}) THEN 'CONFLICT'
    WHEN {_HAS['bedbound']} OR {_HAS['constant_nursing']} THEN 'BEDBOUND' WHEN {_HAS['walking_human_assistance']} OR {_HAS['needs_ADL_help']} OR {_HAS['unable_independent_walking']} THEN CASE WHEN {_NOT['bedbound']} AND {_NOT['constant_nursing']} THEN 'HELP4' ELSE 'HELP' END
    WHEN {_NOT['usual_activities_possible']} AND {_HAS['own_affairs_independent']} THEN 'OWN_AFFAIRS' WHEN {_HAS['walking_independent']} AND {_HAS['unspecified_help']} THEN 'SOME_HELP' WHEN {_HAS['symptoms_present']} AND {_HAS['usual_activities_possible']} THEN 'SYMPTOMS'
    WHEN {_HAS['no_symptoms']} THEN 'NO_SYMPTOMS' ELSE 'INSUFFICIENT' END AS rule FROM f GROUP BY l_orderkey)
  SELECT l_orderkey, CASE rule WHEN 'BEDBOUND' THEN 5 WHEN 'HELP4' THEN 4 WHEN 'HELP' THEN 4 WHEN 'OWN_AFFAIRS' THEN 2 WHEN 'SOME_HELP' THEN 2 WHEN 'SYMPTOMS' THEN 1 WHEN 'NO_SYMPTOMS' THEN 0 END AS low,
    CASE rule WHEN 'BEDBOUND' THEN 5 WHEN 'HELP4' THEN 4 WHEN 'HELP' THEN 5 WHEN 'OWN_AFFAIRS' THEN 2 WHEN 'SOME_HELP' THEN 3 WHEN 'SYMPTOMS' THEN 1 WHEN 'NO_SYMPTOMS' THEN 0 END AS high,
    CASE rule WHEN 'BEDBOUND' THEN 5 WHEN 'HELP4' THEN 4 WHEN 'OWN_AFFAIRS' THEN 2 WHEN 'SYMPTOMS' THEN 1 WHEN 'NO_SYMPTOMS' THEN 0 END AS score, replace(rule, 'HELP4', 'HELP') AS rule FROM r""")
def functional_scale(t: Tables) -> DataFrame:
    return instruments.functional_scale(t.lineitem.selectExpr(*_split(_FACTS)), "l_orderkey", "fact", "state")


@query("""WITH i AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS at, max(o_orderpriority) AS adm FROM orders GROUP BY o_custkey), v AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, floor(o_totalprice / 100000) AS v, o_orderstatus AS u, o_orderpriority AS va FROM orders),
  n AS (SELECT i.o_custkey, i.at, v.v, v.u, v.d, CASE WHEN v.d = i.at THEN 0 WHEN v.va = i.adm THEN 1 ELSE 2 END AS t FROM i JOIN v ON i.o_custkey = v.o_custkey AND v.d <= i.at AND date_diff('day', v.d, i.at) <= 365),
  b AS (SELECT o_custkey, min(t) AS t FROM n GROUP BY o_custkey), l AS (SELECT n.o_custkey, n.t, max(d) AS d FROM n JOIN b ON n.o_custkey = b.o_custkey AND n.t = b.t GROUP BY n.o_custkey, n.t)
  SELECT n.o_custkey, CASE WHEN count(DISTINCT (n.v, n.u)) = 1 THEN min(n.v) END AS value, CASE WHEN count(DISTINCT (n.v, n.u)) = 1 THEN min(n.u) END AS unit,
    CASE WHEN count(DISTINCT (n.v, n.u)) = 1 THEN CASE min(n.t) WHEN 0 THEN 'INDEX_DATE' WHEN 1 THEN 'SAME_ADMISSION_PRIOR' ELSE 'PRIOR_LOOKBACK' END END AS basis FROM n JOIN l ON n.o_custkey = l.o_custkey AND n.t = l.t AND n.d = l.d GROUP BY n.o_custkey""")
def value_before_index(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    index = t.orders.groupBy("o_custkey").agg(F.max(day).alias("at"), F.max("o_orderpriority").alias("adm"))
    values = t.orders.select("o_custkey", day.alias("d"), F.floor(F.col("o_totalprice") / 100000).cast("double").alias("value"), F.col("o_orderstatus").alias("unit"), F.col("o_orderpriority").alias("va"))
    return instruments.value_before(index, values, "o_custkey", "at", "adm", "d", "value", "unit", "va", 365).select("o_custkey", "value", "unit", "basis")


_SHAPE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'DAY' WHEN '2-HIGH' THEN 'MONTH' WHEN '3-MEDIUM' THEN 'YEAR' WHEN '4-NOT SPECIFIED' THEN 'ADMISSION_PROXY' ELSE 'UNKNOWN' END AS p"


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderstatus = 'P' WHEN '2-HIGH' THEN o_orderstatus <> 'F' WHEN '3-MEDIUM' THEN true WHEN '4-NOT SPECIFIED' THEN true ELSE true END AS broken FROM orders""")
def dated_record_shapes(t: Tables) -> DataFrame:
    at, s = F.to_date("o_orderdate"), F.col("o_orderstatus")
    rows = t.orders.withColumn("p", F.expr(_SHAPE[: -len(" AS p")]))
    urgent, high = F.col("p") == "DAY", F.col("p") == "MONTH"
    basis = F.when(urgent & (s != "P"), "EXPLICIT_DISEASE_DATE").when(high, "EXPLICIT_MONTH_YEAR").otherwise("OTHER")
    broken = instruments.dated_shape_broken(F.col("p"), F.year(at), F.when(high & (s != "F"), None).otherwise(F.month(at)), F.when(urgent, at), F.lit(None).cast("date"), basis)
    return rows.select("o_orderkey", broken.alias("broken"))
