"""Clinical instruments as column expressions: numbers and references, durations, dated facts, scores with bounds, imaging criteria, functional scales.

Unknown inputs stay unknown: an instrument whose result could still go either way gives null and names what is missing. Weights, cut-offs and category
names are those of the published instruments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unknown(parts: dict[str, Column]) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(c.isNull(), name) for name, c in parts.items()])), ",")


def _total(parts: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a + b, parts.values())


def _points(flag: Column, weight: int) -> Column:
    """weight, 0 or null for a three-valued flag."""
    return F.when(flag, weight).when(~flag, 0)


# --- numbers --------------------------------------------------------------------------------------------------------------------


def exact_number(raw: Column) -> Column:
    """The non-negative decimal that a text states with point or comma; null for anything else. Never a floating point number."""
    return F.when(raw.rlike(r"^\+?\d+([.,]\d+)?$"), F.replace(F.ltrim(raw, F.lit("+")), F.lit(","), F.lit(".")).try_cast("decimal(38,10)"))


def reference_range(text: Column) -> Column:
    """struct(low, high): two numbers with a dash are both ends, one number behind > or ≥ is the low end, behind < or ≤ the high end; else null."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit(".")).try_cast("decimal(38,10)"))
    two, one = (F.size(numbers) == 2) & text.rlike("[-–]"), F.size(numbers) == 1
    low = F.when(two, F.get(numbers, F.lit(0))).when(one & text.rlike(r"^\s*[>≥]"), F.get(numbers, F.lit(0)))
    high = F.when(two, F.get(numbers, F.lit(1))).when(one & text.rlike(r"^\s*[<≤]"), F.get(numbers, F.lit(0)))
    return F.struct(low.alias("low"), high.alias("high"))


def against_reference(value: Column, low: Column, high: Column, text: Column) -> Column:
    """LOW, NORMAL, HIGH, or UNKNOWN without a value or reference; a value equal to an end is outside only where the reference is strict (> or <)."""
    strict = lambda sign: F.coalesce(text.rlike(rf"^\s*{sign}[^=]"), F.lit(False))
    below, above = (value < low) | ((value == low) & strict(">")), (value > high) | ((value == high) & strict("<"))
    return F.when(value.isNull() | (low.isNull() & high.isNull()), "UNKNOWN").when(below, "LOW").when(above, "HIGH").otherwise("NORMAL")


# Minutes of the units of time, by how their names begin, and the numbers that are written as words.
UNITS = {"sek": 1 / 60, "sec": 1 / 60, "min": 1.0, "st": 60.0, "hour": 60.0, "tag": 1440.0, "day": 1440.0}
NUMBER_WORDS = {"ein": 1, "eine": 1, "einer": 1, "one": 1, "zwei": 2, "two": 2, "drei": 3, "three": 3, "vier": 4, "fünf": 5, "zehn": 10}


def duration_minutes(text: Column) -> Column:
    """struct(low, high, kind) of the only quantity with a unit of time; null without or with several.

    `seit`, `mindestens`, `mehr als`, `>` give a lower bound only; `weniger als`, `unter`, `bis zu`, `<` an upper bound only.
    """
    number, unit = r"(?:\d+(?:[.,]\d+)?|" + "|".join(NUMBER_WORDS) + ")", r"(?:Sek|Sec|Min|Std|Stund|Hour|Tag|Day)[a-zA-Z]*"
    pattern = rf"(?i)(?<![\w.,])({number})(?:\s*(?:-|–|bis)\s*({number}))?\s*({unit})"
    part = lambda g: F.regexp_extract(text, pattern, g)
    words = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    value = lambda c: F.coalesce(F.try_element_at(words, F.lower(c)).cast("double"), F.replace(c, F.lit(","), F.lit(".")).try_cast("double"))
    scale = reduce(lambda out, u: F.when(F.startswith(F.lower(part(3)), F.lit(u[0])), u[1]).otherwise(out), reversed(UNITS.items()), F.lit(None).cast("double"))
    low, high = value(part(1)) * scale, F.when(part(2) != "", value(part(2)) * scale).otherwise(value(part(1)) * scale)
    before = F.regexp_extract(text, rf"(?is)^(.*?)(?<![\w.,]){number}(?:\s*(?:-|–|bis)\s*{number})?\s*{unit}", 1)
    least, most = before.rlike(r"(?i)\bseit\b|mindestens|mehr\s+als|>\s*$"), before.rlike(r"(?i)weniger\s+als|unter|bis\s+zu|<\s*$")
    kind = F.when(part(2) != "", "RANGE").when(least | most | before.rlike(r"(?i)ca\.?|etwa|ungefähr"), "APPROXIMATE").otherwise("EXACT")
    ends = F.struct(F.when(most & ~least, None).otherwise(low).alias("low"), F.when(least, None).otherwise(high).alias("high"), kind.alias("kind"))
    return F.when((F.regexp_count(text, F.lit(pattern)) == 1) & (high >= low), ends)


# Names of the bins, first minute, first minute beyond.
DURATION_BINS = [("<1 min", 0, 1), ("1–5 min", 1, 6), ("6–30 min", 6, 31), ("31–60 min", 31, 61), ("1–3 h", 61, 181), ("3–24 h", 181, 1441), (">24 h", 1441, None)]


def duration_bin(low: Column, high: Column) -> Column:
    """The bin that holds both ends, else UNKNOWN."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, a, b in DURATION_BINS:
        out = out.when((low >= a) & ((high < b) if b else F.lit(True)) & high.isNotNull(), name)
    return out.otherwise("UNKNOWN")


# --- dated facts ----------------------------------------------------------------------------------------------------------------


def fact_at(value: Column, day: Column, sourced: Column, index: Column) -> Column:
    """A fact that is dated, sourced and not later than the index; else null."""
    return F.when((day <= index) & sourced, value)


def value_before(index: DataFrame, values: DataFrame, key: str, index_day: str, admission: str, day: str, value: str, unit: str, value_admission: str, lookback: int) -> DataFrame:
    """index with the value and unit to use and the basis: of values in the look-back those of the index day, else of the same admission, else any; of these the
    latest day; several differing values there give null. One equi-join on the key and buckets of the look-back, two aggregations."""
    days = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    span = max(1, lookback)
    left = index.select(key, F.col(index_day).alias("__at"), F.col(admission).alias("__adm")).withColumn("__b", F.floor(F.datediff("__at", F.lit("1970-01-01").cast("date")) / span).cast("int"))
    left = left.withColumn("__bucket", F.explode(F.array(F.col("__b"), F.col("__b") - 1)))
    right = values.where(F.col(value) >= 0).select(key, F.col(day).alias("__d"), F.col(value).alias("__v"), F.col(unit).alias("__u"), F.col(value_admission).alias("__va")).withColumn("__bucket", F.floor(F.datediff("__d", F.lit("1970-01-01").cast("date")) / span).cast("int"))
    near = left.join(right, [key, "__bucket"]).where((F.col("__d") <= F.col("__at")) & (F.datediff("__at", "__d") <= lookback))
    tier = F.when(F.col("__d") == F.col("__at"), 0).when(F.col("__va") == F.col("__adm"), 1).otherwise(2)
    pair = F.struct("__v", "__u")
    by_day = near.groupBy(key, "__at", tier.alias("__t"), "__d").agg(F.min(pair).alias("__l"), F.max(pair).alias("__h"))
    best = by_day.groupBy(key, "__at").agg(F.max_by(F.struct("__t", "__l", "__h"), F.struct((-F.col("__t")).alias("t"), F.col("__d").alias("d"))).alias("m"))
    agreed = F.col("m.__l") == F.col("m.__h")
    basis = F.when(F.col("m.__t") == 0, "INDEX_DATE").when(F.col("m.__t") == 1, "SAME_ADMISSION_PRIOR").otherwise("PRIOR_LOOKBACK")
    found = best.select(F.col(key).alias("__k"), F.col("__at").alias("__i"), F.when(agreed, F.col("m.__l.__v")).alias(value), F.when(agreed, F.col("m.__l.__u")).alias(unit), F.when(agreed, basis).alias("basis"))
    return index.join(found, (F.col(key) == F.col("__k")) & (F.col(index_day) == F.col("__i")), "left").drop("__k", "__i")


def dated_shape_broken(precision: Column, year: Column, month: Column, day: Column, proxy: Column, basis: Column) -> Column:
    """Whether a dated record breaks the shape of its precision (DAY, MONTH, YEAR, ADMISSION_PROXY, UNKNOWN)."""
    none = lambda *cs: reduce(lambda a, b: a & b, [c.isNull() for c in cs])
    ok = (
        F.when(precision == "DAY", day.isNotNull() & (F.year(day) == year) & (F.month(day) == month) & proxy.isNull() & (basis == "EXPLICIT_DISEASE_DATE"))
        .when(precision == "MONTH", day.isNull() & year.isNotNull() & month.isNotNull() & proxy.isNull() & (basis == "EXPLICIT_MONTH_YEAR"))
        .when(precision == "YEAR", none(day, month, proxy) & year.isNotNull() & (basis == "EXPLICIT_YEAR"))
        .when(precision == "ADMISSION_PROXY", none(day, year, month) & proxy.isNotNull() & (basis == "CURRENT_ADMISSION_PROXY"))
        .when(precision == "UNKNOWN", none(day, year, month, proxy) & (basis == "UNKNOWN"))
    )
    in_range = F.coalesce(year.between(1, 9999), F.lit(True)) & F.coalesce(month.between(1, 12), F.lit(True))
    return ~F.coalesce(ok & in_range, F.lit(False))


# --- scores ---------------------------------------------------------------------------------------------------------------------


def stroke_risk(age: Column, flags: dict[str, Column], applicable: Column) -> list[Column]:
    """Stroke risk in atrial fibrillation without the sex category: flags C, H, D, V (1 point each) and S2 (2), age from 65 (1) and from 75 on (2).

    score (null where anything is unknown), score_min and score_max (the age bands exclude each other), missing, advice. Not applicable: all null.
    """
    parts = {k: _points(flags[k], 2 if k == "S2" else 1) for k in ("C", "H", "D", "S2", "V")}
    band = F.when(age >= 75, 2).when(age >= 65, 1).when(age.isNotNull(), 0)
    low = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in parts.values()]) + F.coalesce(band, F.lit(0))
    high = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(2 if k == "S2" else 1)) for k, c in parts.items()]) + F.coalesce(band, F.lit(2))
    score = _total(parts) + band
    advice = F.when(score == 0, "LOW_RISK").when(score == 1, "CONSIDER_OAC").when(score > 1, "OAC_RECOMMENDED").when(low >= 2, "OAC_RECOMMENDED_FROM_MINIMUM_CONFIRMED_SCORE").otherwise("RECOMMENDATION_RANGE_UNCERTAIN")
    own = {"score": score, "score_min": low, "score_max": high, "missing": _unknown({**parts, "A": band}), "advice": advice}
    return [F.when(applicable, c).alias(k) for k, c in own.items()]


def bleeding_risk(age: Column, male: Column, hemoglobin: Column, hematocrit: Column, anemia_history: Column, bleeding: Column, antiplatelet: Column, egfr: Column) -> list[Column]:
    """Bleeding score: age from 75 on 1, anemia 2, bleeding history 2, antiplatelet 1, eGFR below 60 1. score, category, missing.

    Anemia is present with one low value (hemoglobin g/dL below 13 in men, 12 in women; hematocrit % below 40, 36) or a history; it is absent only where the
    history is denied and a value was measured, none of them low.
    """
    low_hb = F.when(male.isNotNull(), hemoglobin < F.when(male, 13).otherwise(12))
    low_hct = F.when(male.isNotNull(), hematocrit < F.when(male, 40).otherwise(36))
    measured = low_hb.isNotNull() | low_hct.isNotNull()
    false = F.lit(False)
    some = F.coalesce(low_hb, false) | F.coalesce(low_hct, false) | F.coalesce(anemia_history, false)
    anemia = F.when(some, 2).when((~anemia_history) & measured, 0)
    parts = {"age": _points(age >= 75, 1), "anemia": anemia, "bleeding_history": _points(bleeding, 2), "antiplatelet": _points(antiplatelet, 1), "renal": _points(egfr < 60, 1)}
    score = _total(parts)
    category = F.when(score.isNull(), "NOT_ASSESSABLE").when(score <= 2, "LOW").when(score == 3, "INTERMEDIATE").otherwise("HIGH")
    return [score.alias("score"), category.alias("category"), _unknown(parts).alias("missing")]


# Points of the seizure types and of the states of consciousness.
SEIZURE_POINTS = {"FOCAL": 0, "FOCAL_IMPAIRED_AWARENESS": 0, "GENERALIZED_CONVULSIVE": 1, "NCSE_IN_COMA": 2}
CONSCIOUSNESS_POINTS = {"AWAKE": 0, "SOMNOLENT": 0, "CONFUSED": 0, "STUPOROUS": 1, "COMATOSE": 1}


def status_severity(applicable: Column, age: Column, previous: Column, seizure: Column, consciousness: Column) -> list[Column]:
    """Severity of status epilepticus: age from 65 on 2, no previous seizures 1, seizure type, consciousness. score, interpretation, missing."""
    of = lambda table, c: F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
    parts = {"age": _points(age >= 65, 2), "previous_seizures": _points(~previous, 1), "seizure_type": of(SEIZURE_POINTS, seizure), "consciousness": of(CONSCIOUSNESS_POINTS, consciousness)}
    score = _total(parts)
    said = F.when(score.isNull(), "NOT_ASSESSABLE").when(score <= 2, "FAVORABLE_STESS").otherwise("HIGHER_RISK_STESS")
    return [F.when(applicable, score).alias("score"), F.when(applicable, said).otherwise("NOT_APPLICABLE").alias("interpretation"), F.when(applicable, _unknown(parts)).alias("missing")]


# --- imaging criteria -----------------------------------------------------------------------------------------------------------


def mri_criteria(f: dict[str, Column]) -> Column:
    """struct(classification, holds) of the MRI criteria (version 2.0, 2022) for cerebral amyloid angiopathy.

    Keys: age, presentation, mri_adequate, blood_sensitive, lobar_ich, lobar_cmb, css_foci (counts), counts_complete, pvs, wmh, deep_ich, deep_cmb,
    alternative, pathology (AUTOPSY, BIOPSY or null), pathology_only.
    """
    counts = [f[k] for k in ("lobar_ich", "lobar_cmb", "css_foci")]
    lesions = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in counts])
    true = lambda c: F.coalesce(c, F.lit(False))
    white = true(f["pvs"]) | true(f["wmh"])
    needed = {k: f[k] for k in ("age", "presentation", "mri_adequate", "blood_sensitive", "deep_ich", "deep_cmb", "alternative")}
    holds = F.array_compact(F.array(*[F.when(c.isNull(), f"UNKNOWN_{k.upper()}") for k, c in needed.items()], F.when(~f["mri_adequate"], "INADEQUATE_MRI"), F.when(~f["blood_sensitive"], "NO_BLOOD_SENSITIVE_SEQUENCE")))
    out = lambda c, h=None: F.struct(F.lit(c).alias("classification"), (F.lit("") if h is None else h).alias("holds"))
    confirmed = true(f["presentation"]) & true(f["pathology_only"])
    excluded = true(f["age"] < 50) | true(~f["presentation"]) | true(f["alternative"]) | true(f["deep_ich"]) | true(f["deep_cmb"])
    return (
        F.when(confirmed & true(f["pathology"] == "AUTOPSY"), out("DEFINITE"))
        .when(confirmed & true(f["pathology"] == "BIOPSY"), out("PROBABLE_WITH_PATHOLOGY"))
        .when(excluded, out("DOES_NOT_MEET"))
        .when(F.size(holds) > 0, out("NOT_ASSESSABLE", F.array_join(holds, ",")))
        .when((lesions >= 2) | ((lesions >= 1) & white), out("PROBABLE"))
        .when(~true(f["counts_complete"]), out("NOT_ASSESSABLE", F.lit("INCOMPLETE_COUNTS")))
        .when(reduce(lambda a, b: a | b, [c.isNull() for c in counts]), out("NOT_ASSESSABLE", F.lit("UNKNOWN_COUNT")))
        .when((lesions == 1) | white, out("POSSIBLE"))
        .when(f["pvs"].isNull() | f["wmh"].isNull(), out("NOT_ASSESSABLE", F.lit("UNKNOWN_WHITE_MATTER")))
        .otherwise(out("DOES_NOT_MEET"))
    )


def ct_criteria(f: dict[str, Column]) -> Column:
    """struct(applicable, version, classification, holds) of the CT criteria: the original rule where the genotype is known, else the simplified one.

    Keys: mri_available, ct_available, lobar_ich, spontaneous, context, projections, subarachnoid, e4 (all three-valued). An adequate or unresolved MRI comes first.
    """
    gates = [f[k] for k in ("ct_available", "lobar_ich", "spontaneous", "context")]
    no, open_ = reduce(lambda a, b: a | b, [F.coalesce(~c, F.lit(False)) for c in gates]), reduce(lambda a, b: a | b, [c.isNull() for c in gates])
    p, s, e = f["projections"], f["subarachnoid"], f["e4"]
    known = p.isNotNull() & s.isNotNull()
    version = F.when(e.isNotNull(), "ORIGINAL").when(known, "SIMPLIFIED").otherwise("UNKNOWN")
    out = lambda a, v, c, h: F.struct(F.lit(a).alias("applicable"), v.alias("version"), F.lit(c).alias("classification"), F.lit(h).alias("holds"))
    unknown = F.lit("UNKNOWN")
    rated = lambda c: out(True, version, c, "")
    return (
        F.when(f["mri_available"], out(False, unknown, "NOT_APPLICABLE", "ADEQUATE_MRI"))
        .when(f["mri_available"].isNull(), out(False, unknown, "NOT_ASSESSABLE", "UNKNOWN_MRI"))
        .when(no, out(False, version, "NOT_APPLICABLE", ""))
        .when(open_, out(False, version, "NOT_ASSESSABLE", "APPLICABILITY"))
        .when(F.coalesce(e & s, F.lit(False)), rated("HIGH_PROBABILITY"))
        .when(~known, out(True, version, "NOT_ASSESSABLE", "UNKNOWN_CT_MORPHOLOGY"))
        .when(p & s, rated("HIGH_PROBABILITY"))
        .when(e.isNull() & (p | s), rated("INTERMEDIATE_OR_UNCERTAIN"))
        .when(e.isNull(), rated("LOW_PROBABILITY"))
        .when(p, out(True, version, "NOT_ASSESSABLE", "PROJECTIONS_WITHOUT_SUBARACHNOID"))
        .when(s | e, rated("INTERMEDIATE_OR_UNCERTAIN"))
        .otherwise(rated("LOW_PROBABILITY"))
    )


def imaging_framework(mri_adequate: Column, mri_available: Column, mri: Column, ct: Column, strict: bool = True) -> Column:
    """struct(framework, classification): the MRI criteria where adequate MRI is there, else the CT criteria where they apply, else NONE.

    The two statements on MRI must agree: with strict a contradiction is an error, without it CONFLICT.
    """
    adequate, available = F.coalesce(mri_adequate, F.lit(False)), F.coalesce(mri_available, F.lit(False))
    out = lambda name, c: F.struct(F.lit(name).alias("framework"), c.alias("classification"))
    conflict = F.raise_error(F.lit("statements on MRI contradict each other")).cast("struct<framework:string,classification:string>") if strict else out("CONFLICT", F.lit(None).cast("string"))
    return F.when(adequate != available, conflict).when(available, out("MRI", mri["classification"])).when(ct["applicable"], out("CT", ct["classification"])).otherwise(out("NONE", F.lit("NOT_ASSESSABLE")))


# --- episodes and functional scale ----------------------------------------------------------------------------------------------


def transient_episode(asserted: Column, course: Column, resolved: Column, focality: Column, domain: Column, low: Column, high: Column, spreading: Column, recurrent: Column, stereotyped: Column, positive: Column, negative: Column) -> list[Column]:
    """screen, phenotype and symptom polarity of a transient focal episode, by a decision table. Flags are three-valued; unknown ones support nothing."""
    true = lambda c: F.coalesce(c, F.lit(False))
    mixed, focal = true(positive) & true(negative), true(focality == "FOCAL")
    lasting = course.isin("PERSISTENT", "PROGRESSIVE", "MIXED", "FLUCTUATING_WITHOUT_CLEAR_RESOLUTION")
    transient = (course == "TRANSIENT_FULLY_RESOLVED") & true(resolved)
    too_long = true(low > 1440) | true(high > 1440)
    typical = focal & domain.isin("SENSORY", "MOTOR", "LANGUAGE", "VISUAL")
    strong = true(spreading) | (true(recurrent) & true(stereotyped)) | mixed
    says = lambda screen, phenotype: F.struct(F.lit(screen).alias("screen"), F.lit(phenotype).alias("phenotype"))
    table = (
        F.when(~true(asserted), says("UNCLASSIFIABLE", "UNCLASSIFIABLE"))
        .when(lasting & (course == "MIXED"), says("NEGATIVE", "UNCLASSIFIABLE"))
        .when(lasting & (course == "PROGRESSIVE") & (domain == "COGNITIVE"), says("NEGATIVE", "PROGRESSIVE_COGNITIVE"))
        .when(lasting & focal, says("NEGATIVE", "PERSISTENT_FOCAL"))
        .when(lasting & (course != "FLUCTUATING_WITHOUT_CLEAR_RESOLUTION"), says("NEGATIVE", "PERSISTENT_OTHER"))
        .when(lasting, says("NEGATIVE", "UNCLASSIFIABLE"))
        .when(transient & too_long, says("NEGATIVE", "UNCLASSIFIABLE"))
        .when(transient & (focality == "NONFOCAL"), says("NEGATIVE", "TRANSIENT_ATYPICAL"))
        .when(transient & typical & strong, says("STRONG", "TYPICAL"))
        .when(transient & typical, says("POSSIBLE", "POSSIBLE"))
        .otherwise(says("UNCLASSIFIABLE", "UNCLASSIFIABLE"))
    )
    polarity = F.when(mixed, "MIXED").when(true(positive), "POSITIVE").when(true(negative), "NEGATIVE").otherwise("UNKNOWN")
    return [table["screen"].alias("screen"), table["phenotype"].alias("phenotype"), polarity.alias("polarity")]


#: Facts of the functional scale.
FUNCTION_FACTS = ("bedbound", "constant_nursing", "walking_human_assistance", "needs_ADL_help", "unable_independent_walking", "usual_activities_possible", "own_affairs_independent", "walking_independent", "independent_ADL", "unspecified_help", "symptoms_present", "no_symptoms")


def functional_scale(facts: DataFrame, key: str, fact: str, state: str) -> DataFrame:
    """key, low, high, score, rule from fact states PRESENT, ABSENT, UNKNOWN: states of a fact that contradict each other make a conflict, an unknown fact supports
    nothing, and a range gives no score."""
    one = lambda f: F.when(F.col("__f") == f, F.when(F.col("__s") != "UNKNOWN", F.col("__s")))
    rows = facts.select(key, F.col(fact).alias("__f"), F.col(state).alias("__s"))
    wide = rows.groupBy(key).agg(*[F.min(one(f)).alias(f"l_{f}") for f in FUNCTION_FACTS], *[F.max(one(f)).alias(f"h_{f}") for f in FUNCTION_FACTS])
    has = lambda f, s: F.coalesce((F.col(f"l_{f}") == s) & (F.col(f"h_{f}") == s), F.lit(False))
    yes, no = (lambda f: has(f, "PRESENT")), (lambda f: has(f, "ABSENT"))
    differs = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"l_{f}") != F.col(f"h_{f}"), F.lit(False)) for f in FUNCTION_FACTS])
    clash = (yes("walking_independent") & (yes("walking_human_assistance") | yes("bedbound"))) | (yes("independent_ADL") & yes("needs_ADL_help"))
    help_ = yes("walking_human_assistance") | yes("needs_ADL_help") | yes("unable_independent_walking")
    out = lambda low, high, rule: F.struct(F.lit(low).cast("int").alias("low"), F.lit(high).cast("int").alias("high"), F.lit(rule).alias("rule"))
    table = (
        F.when(differs | clash, out(None, None, "CONFLICT"))
        .when(yes("bedbound") | yes("constant_nursing"), out(5, 5, "BEDBOUND"))
        .when(help_ & no("bedbound") & no("constant_nursing"), out(4, 4, "HELP"))
        .when(help_, out(4, 5, "HELP"))
        .when(no("usual_activities_possible") & yes("own_affairs_independent"), out(2, 2, "OWN_AFFAIRS"))
        .when(yes("walking_independent") & yes("unspecified_help"), out(2, 3, "SOME_HELP"))
        .when(yes("symptoms_present") & yes("usual_activities_possible"), out(1, 1, "SYMPTOMS"))
        .when(yes("no_symptoms"), out(0, 0, "NO_SYMPTOMS"))
        .otherwise(out(None, None, "INSUFFICIENT"))
    )
    return wide.select(key, table.alias("r")).select(key, "r.low", "r.high", F.when(F.col("r.low") == F.col("r.high"), F.col("r.low")).alias("score"), "r.rule")
