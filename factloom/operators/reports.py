"""Extractors of report types: measurements out of tokens, studies, events with scales, test passages, vessels, treatment decisions, owned dates, patches.

All are rule tables over lines and clauses. What an extractor rejects stays as a row with the reason; a value that several things could own has no owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import assertions, instruments, text

DATE = r"(?<!\d)(\d{1,2}\.\d{1,2}\.\d{4})(?!\d)"


def _day(found: Column) -> Column:
    return F.try_to_date(F.nullif(found, F.lit("")), "d.M.yyyy")


def _first(value: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    return F.coalesce(text.first_label(value, rules), F.lit(default).cast("string"))


# --- measurements ---------------------------------------------------------------------------------------------------------------


def measurements(tokens: DataFrame, keys: list[str], row: str, x: str, word: str, analytes: dict[str, str], units: list[str]) -> DataFrame:
    """keys, row, analyte, value (text), unit, reference (struct), issues of each table row with a number or a known label.

    tokens are words with their place: keys (document, page), row (a visual row, see clusters.visual_rows) and x. From left to right a row holds a label, one
    value, a unit and a reference. issues: UNKNOWN_LABEL, NO_VALUE, SEVERAL_VALUES, UNKNOWN_UNIT, comma-joined.
    """
    words = F.transform(F.array_sort(F.collect_list(F.struct(x, word))), lambda s: s[word])
    rows = tokens.groupBy(*keys, row).agg(words.alias("__w"))
    known = F.create_map(*[F.lit(v) for pair in analytes.items() for v in pair])
    number = lambda w: w.rlike(r"^[+-]?\d+([.,]\d+)?$")
    numbers, first = F.filter("__w", number), F.lower(F.get("__w", F.lit(0)))
    analyte, unit = F.try_element_at(known, first), F.get(F.filter("__w", lambda w: w.isin(units)), F.lit(0))
    range_ = F.get(F.filter("__w", lambda w: w.rlike(r"^([<>≤≥]=?\d|\d+([.,]\d+)?[-–]\d)")), F.lit(0))
    issues = F.array_compact(F.array(F.when(analyte.isNull(), "UNKNOWN_LABEL"), F.when(F.size(numbers) == 0, "NO_VALUE"), F.when(F.size(numbers) > 1, "SEVERAL_VALUES"), F.when(unit.isNull(), "UNKNOWN_UNIT")))
    out = rows.where(analyte.isNotNull() | (F.size(numbers) > 0))
    value = F.when(F.size(numbers) == 1, F.get(numbers, F.lit(0)))
    return out.select(*keys, row, analyte.alias("analyte"), value.alias("value"), unit.alias("unit"), instruments.reference_range(range_).alias("reference"), F.array_join(issues, ",").alias("issues"))


# --- studies --------------------------------------------------------------------------------------------------------------------

# Kinds of studies and body regions by the words of a header.
MODALITIES = [("MRI", r"(?i)\b(?:MRT|MRI)\b|kernspin"), ("CTA", r"(?i)CT-?Angio|\bCTA\b"), ("CT", r"(?i)\bCCT\b|\bCT\b"), ("PET", r"(?i)\bPET\b"), ("DSA", r"(?i)\bDSA\b|subtraktionsangio")]
REGIONS = [("SPINE", r"(?i)wirbel|\bLWS\b|\bBWS\b|\bHWS\b"), ("BRAIN", r"(?i)schädel|cra?niell|hirn|brain|kopf"), ("HEAD_NECK", r"(?i)hals|neck|carotis")]
NOT_PERFORMED = r"(?i)abgebrochen|nicht\s+(?:durchgeführt|erfolgt)|not\s+performed"


def studies(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, study_no, modality, region, study_date, start, end, performed: a study begins at a header line (kind of study and a date) and ends at the next one."""
    header = F.col("line").rlike(r"(?i)^\s*(?:C?CT|MRT|MRI|PET|DSA|CTA|CT-Angio\w*)\b.*\d{1,2}\.\d{1,2}\.\d{4}")
    found = text.sections(docs, key, body, header).where("heading is not null")
    rows = found.join(docs.select(F.col(key).alias("__k"), F.col(body).alias("__b")), F.col(key) == F.col("__k"))
    own = F.substr("__b", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    no = F.row_number().over(Window.partitionBy(key).orderBy("start"))
    return rows.select(key, no.alias("study_no"), _first(F.col("heading"), MODALITIES, "OTHER").alias("modality"), _first(F.col("heading"), REGIONS, "OTHER").alias("region"), _day(F.regexp_extract("heading", DATE, 1)).alias("study_date"), "start", "end", (~own.rlike(NOT_PERFORMED)).alias("performed"))


# --- events and scales ----------------------------------------------------------------------------------------------------------

# Kinds of events, times of assessment, highest values of the scales.
EVENTS = [("ISCHEMIC_STROKE", r"(?i)isch[äa]m\w*\s+(?:infarkt|insult|stroke)"), ("HEMORRHAGE", r"(?i)(?:intra[cz]erebral|intra[cz]raniell)\w*\s+blutung"), ("TIA", r"\bTIA\b|(?i)transitorische.*attacke")]
TIMES = [("PRE_EVENT", r"(?i)prämorbid|prä-|vor\s+(?:ereignis|aufnahme)"), ("DISCHARGE", r"(?i)entlassung|verleg"), ("ADMISSION", r"(?i)aufnahme|initial"), ("FOLLOWUP", r"(?i)kontrolle|follow|nach\s+3\s+monaten")]
HIGHEST = {"NIHSS": 42, "mRS": 6, "MoCA": 30}
TREATMENTS = {"lysis": r"(?i)lyse\b|alteplase|tenecteplase", "thrombectomy": r"(?i)thrombektomie"}


def events_with_scales(docs: DataFrame, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Events (key, event_no, kind, event_date and a flag for each treatment named up to the next event) and assessments (key, event_no, scale, timepoint, value, review).

    A heading opens an event and clears the time; a time marker holds for its line and those after it in the event; a value beyond the scale is null and to be reviewed,
    and so is one without a time. Lines before the first event belong to event 0, which is none. A document is a row, so nothing is shuffled or sorted.
    """
    line = lambda x: F.struct(x.alias("line"), text.first_label(x, EVENTS).alias("kind"), text.first_label(x, TIMES).alias("time"))
    # through explode, so that the lines are labelled once and not in each expression that reads them
    rows = docs.select(key, F.explode(F.array(F.transform(F.split(body, "\n"), line))).alias("__l")).where("__l IS NOT NULL")
    heads = F.filter(F.transform("__l", lambda x, i: F.when(x["kind"].isNotNull(), i)), lambda i: i.isNotNull())
    rows = rows.select(key, "__l", F.concat(F.array(F.lit(0)), heads).alias("__heads"))
    rows = rows.select(key, "__l", "__heads", F.posexplode("__heads").alias("__no", "__a"))
    until = F.coalesce(F.get("__heads", F.col("__no") + 1), F.size("__l"))
    # the lines of one event, in a row
    rows = rows.select(key, F.col("__no").cast("bigint").alias("event_no"), F.slice("__l", F.col("__a") + 1, until - F.col("__a")).alias("__own"))
    head, named = F.get("__own", F.lit(0)), lambda p: lambda x: x.rlike(p)
    flags = [F.exists(F.transform("__own", lambda x: x["line"]), named(p)).alias(name) for name, p in TREATMENTS.items()]
    events = rows.where("event_no > 0").select(key, "event_no", head["kind"].alias("kind"), _day(F.regexp_extract(head["line"], DATE, 1)).alias("event_date"), *flags)
    # a time in the heading itself is that of the event, not of an assessment
    times = F.filter(F.transform("__own", lambda x, i: F.struct(i.alias("i"), F.when(x["kind"].isNull(), x["time"]).alias("time"))), lambda x: x["time"].isNotNull())
    said = rows.select(key, "event_no", "__own", times.alias("__times")).select(key, "event_no", "__times", F.posexplode("__own").alias("__i", "__x"))
    said = said.select(key, "event_no", "__times", "__i", F.col("__x.line").alias("line")).where(F.col("line").rlike(rf"\b(?:{'|'.join(HIGHEST)})\b[\s:=]*\d"))
    timepoint = F.try_element_at(F.filter("__times", lambda x: x["i"] <= F.col("__i")), F.lit(-1))["time"]
    scores = F.array_compact(F.array(*[F.when(F.col("line").rlike(rf"\b{s}\b[\s:=]*\d"), F.struct(F.lit(s).alias("scale"), F.regexp_extract("line", rf"\b{s}\b[\s:=]*(\d{{1,2}})(?!\d)", 1).try_cast("int").alias("v"), F.lit(top).alias("top"))) for s, top in HIGHEST.items()]))
    said = said.select(key, "event_no", timepoint.alias("timepoint"), F.explode(scores).alias("s"))
    fits = F.col("s.v") <= F.col("s.top")
    return events, said.select(key, "event_no", "s.scale", "timepoint", F.when(fits, F.col("s.v")).alias("value"), (F.col("timepoint").isNull() | ~F.coalesce(fits, F.lit(False))).alias("review"))


# --- test passages --------------------------------------------------------------------------------------------------------------


def test_passages(docs: DataFrame, key: str, body: str, aliases: list[str], top: int) -> DataFrame:
    """key, place, test, score, reason of every occurrence of a test's name, with its passage up to the next name, sentence end or line end.

    Dates in a passage are no numbers. A score is the only number of the passage, `n` or `n/top`. reason: ACCEPTED, PLANNED, PERCENT, RANGE, NO_NUMBER,
    SEVERAL_NUMBERS, OTHER_SCALE, OUTSIDE.
    """
    names = "|".join(aliases)
    bare = F.regexp_replace(F.col(body), DATE, " ")
    # a stop between digits ends nothing; what follows a name up to the next name is cut out by marking names first
    marked = F.regexp_replace(bare, rf"\b({names})\b", "\u0001$1\u0002")
    hits = F.regexp_extract_all(marked, F.lit("\u0001([^\u0001]*)"), F.lit(1))
    rows = docs.select(key, F.posexplode(hits).alias("place", "__h"))
    test, passage = F.regexp_extract("__h", "^(.*?)\u0002", 1), F.regexp_extract("__h", "(?s)\u0002(.*?)(?:[.!?](?:\\s|$)|\n|$)", 1)
    rows = rows.select(key, "place", test.alias("test"), passage.alias("__p"))
    numbers = F.regexp_extract_all("__p", F.lit(r"(\d+(?:\s*/\s*\d+)?)"), F.lit(1))
    one = F.get(numbers, F.lit(0))
    score, scale = F.regexp_extract(one, r"^(\d+)", 1).try_cast("int"), F.regexp_extract(one, r"/\s*(\d+)", 1).try_cast("int")
    reason = (
        F.when(F.col("__p").rlike(r"(?i)geplant|planned|ausständig"), "PLANNED").when(F.size(numbers) == 0, "NO_NUMBER").when(F.col("__p").rlike(r"\d\s*%"), "PERCENT")
        .when(F.col("__p").rlike(r"\d\s*[-–]\s*\d"), "RANGE").when(F.size(numbers) > 1, "SEVERAL_NUMBERS").when(scale != top, "OTHER_SCALE").when(score > top, "OUTSIDE").otherwise("ACCEPTED")
    )
    return rows.select(key, "place", "test", F.when(reason == "ACCEPTED", score).alias("score"), reason.alias("reason"))


# --- vessels --------------------------------------------------------------------------------------------------------------------

# Vessels by their names.
VESSELS = [("ICA", r"(?i)\bACI\b|\bICA\b|carotis interna"), ("CCA", r"(?i)\bACC\b|\bCCA\b|carotis communis"), ("VERTEBRAL", r"(?i)vertebralis"), ("MCA", r"(?i)\bACM\b|\bMCA\b|cerebri media"), ("BASILAR", r"(?i)basilaris")]


def vessel_rows(exams: DataFrame, key: str, body: str) -> DataFrame:
    """key, line_no, vessel, side, stenosis (per cent), occlusion, plaque, psv (cm/s), review: a row for each vessel and side that a line names.

    A number in a line with several vessels belongs to none of them, and such a line is to be reviewed, as one without a side is. Denials are no findings.
    """
    rows = text.lines(exams, key, body).withColumn("__v", text.labels(F.col("line"), VESSELS)).where(F.size("__v") > 0)
    line, several, denied = F.col("line"), F.size("__v") > 1, F.col("line").rlike(r"(?i)kein|ohne|\bno\b")
    both, left, right = line.rlike(r"(?i)\bbds\b|beidseit|bilateral"), line.rlike(r"(?i)\blinks\b|\bli\b|\bleft\b"), line.rlike(r"(?i)\brechts\b|\bre\b|\bright\b")
    sides = F.when(both | (left & right), F.array(F.lit("LEFT"), F.lit("RIGHT"))).when(left, F.array(F.lit("LEFT"))).when(right, F.array(F.lit("RIGHT"))).otherwise(F.array(F.lit("UNKNOWN")))
    closed = F.when(line.rlike(r"(?i)verschluss|okklusion|occlusion") & ~denied, True)
    percents = F.regexp_extract_all(line, F.lit(r"(\d{1,3})\s*%"), F.lit(1))
    stenosis = F.when(closed, 100).when((F.size(percents) == 1) & ~several & ~line.rlike(r"\d\s*[-–]\s*\d+\s*%"), F.get(percents, F.lit(0)).try_cast("int"))
    plaque = F.when(line.rlike(r"(?i)plaque"), ~denied)
    speed = F.replace(F.regexp_extract(line, r"(?i)PSV\s*[:=]?\s*(\d+(?:[.,]\d+)?)\s*(cm/s|m/s)", 1), F.lit(","), F.lit(".")).try_cast("double")
    psv = F.when(~several, speed * F.when(F.regexp_extract(line, r"(?i)PSV\s*[:=]?\s*\d+(?:[.,]\d+)?\s*(cm/s|m/s)", 1) == "m/s", 100.0).otherwise(1.0))
    out = rows.select(key, "line_no", F.explode("__v").alias("vessel"), sides.alias("__s"), F.when(stenosis <= 100, stenosis).alias("stenosis"), closed.alias("occlusion"), plaque.alias("plaque"), psv.alias("psv"), several.alias("__several"))
    out = out.withColumn("side", F.explode(F.when(F.col("vessel") == "BASILAR", F.array(F.lit("MIDLINE"))).otherwise(F.col("__s"))))
    return out.select(key, "line_no", "vessel", "side", "stenosis", "occlusion", "plaque", "psv", (F.col("__several") | (F.col("side") == "UNKNOWN")).alias("review"))


# --- decisions ------------------------------------------------------------------------------------------------------------------

# What is done with a treatment, and why, by their words; the first that is found counts.
ACTIONS = [("NOT_STARTED", r"(?i)nicht\s+(?:begonnen|eingeleitet)|not\s+started"), ("PAUSED", r"(?i)pausier|paused"), ("STOPPED", r"(?i)abgesetzt|beendet|stopped"), ("SWITCHED", r"(?i)umgestellt|switched"), ("STARTED", r"(?i)begonnen|eingeleitet|started"), ("CONTINUED", r"(?i)fortgeführt|weiter|continued")]
REASONS = [("BLEEDING", r"(?i)blutung|bleeding"), ("INTERVENTION", r"(?i)eingriff|operation|intervention"), ("RENAL", r"(?i)niere|renal"), ("PATIENT_WISH", r"(?i)wunsch|wish")]
PLANNED = r"(?i)geplant|empfohlen|sollte|planned|recommended"


def decisions(docs: DataFrame, key: str, body: str, subject: str) -> DataFrame:
    """key, place, action, reason, day, planned: each clause that names the subject and an action. day is the clause's only date; a planned action hasn't happened."""
    spans = F.posexplode(assertions.clause_spans(F.col(body)))
    rows = docs.select(key, body, spans.alias("place", "__c")).withColumn("__t", F.substr(body, F.col("__c.start") + 1, F.col("__c.end") - F.col("__c.start")))
    rows = rows.where(F.col("__t").rlike(subject)).withColumn("action", text.first_label(F.col("__t"), ACTIONS)).where("action is not null")
    days = F.regexp_extract_all("__t", F.lit(DATE), F.lit(1))
    return rows.select(key, "place", "action", text.first_label(F.col("__t"), REASONS).alias("reason"), F.when(F.size(days) == 1, _day(F.get(days, F.lit(0)))).alias("day"), F.col("__t").rlike(PLANNED).alias("planned"))


# --- owned dates ----------------------------------------------------------------------------------------------------------------

def owned_date(clause: Column, disease: str, procedures: str, between_words: str, onset_words: str) -> Column:
    """struct(day, relation) of a disease in a clause: DIRECT where the clause's only full date follows the disease with nothing but between_words between them (a procedure
    owns the dates of its clause, unless onset_words stand right before one); PROCEDURE_DATE, PARTIAL_DATE, SEVERAL_DATES, BEFORE_DISEASE, NOT_ADJACENT, INVALID_DATE else; null without the disease, NONE without a date."""
    dates = F.regexp_extract_all(clause, F.lit(DATE), F.lit(1))
    partial = F.regexp_replace(clause, DATE, " ").rlike(r"(?<![\d./-])(?:[01]?\d/)?(?:19|20)\d{2}(?![\d./-])")
    between = F.regexp_extract(clause, rf"(?s)(?:{disease})(.*?){DATE}", 1)
    follows = clause.rlike(rf"(?s)(?:{disease}).*?{DATE}")
    onset = clause.rlike(rf"(?:{onset_words})\s*{DATE}")
    free = ~F.regexp_replace(between, between_words, "").rlike(r"[\p{L}\p{N},;]")
    relation = (
        F.when((F.size(dates) == 0) & ~partial, "NONE").when(F.size(dates) == 0, "PARTIAL_DATE").when(clause.rlike(procedures) & ~onset, "PROCEDURE_DATE").when(F.size(dates) > 1, "SEVERAL_DATES")
        .when(~follows, "BEFORE_DISEASE").when(~free, "NOT_ADJACENT").when(_day(F.get(dates, F.lit(0))).isNull(), "INVALID_DATE").otherwise("DIRECT")
    )
    own = F.struct(F.when(relation == "DIRECT", _day(F.get(dates, F.lit(0)))).alias("day"), relation.alias("relation"))
    return F.when(clause.rlike(disease), own)


# --- assembling -----------------------------------------------------------------------------------------------------------------


def field_patch(evidence: DataFrame, key: str, field: str, value: str, rank: str, source: str) -> DataFrame:
    """key, field, value, state, rank, n_sources: the value that all evidence of the best rank (lowest number) agrees on, with the number of sources that say so;
    PATCH, or CONFLICT with a null value. Two aggregations."""
    known = evidence.where(F.col(value).isNotNull())
    per = known.groupBy(key, field, rank).agg(F.min(value).alias("l"), F.max(value).alias("h"), F.count_distinct(source).alias("n"))
    best = per.groupBy(key, field).agg(F.min_by(F.struct(rank, "l", "h", "n"), rank).alias("b"))
    agreed = F.col("b.l") == F.col("b.h")
    return best.select(key, field, F.when(agreed, F.col("b.l")).alias(value), F.when(agreed, "PATCH").otherwise("CONFLICT").alias("state"), F.col(f"b.{rank}").alias(rank), F.col("b.n").alias("n_sources"))


def disease_identities(mentions: DataFrame, key: str, label: str, canonical: list[tuple[str, str]], state: str, day: str) -> DataFrame:
    """key, disease, state, first_day, n_mentions, n_days: mentions of one canonical disease are one identity. Its state is the strongest of its mentions (an
    established one outweighs a suspicion, that a denial); labels without a rule keep their own name."""
    disease = F.coalesce(text.first_label(F.col(label), canonical), text.normalized(F.col(label)))
    order = F.create_map(*[F.lit(x) for pair in {"PRESENT": 4, "UNCERTAIN": 3, "DIFFERENTIAL": 2, "ABSENT": 1}.items() for x in pair])
    rank = F.coalesce(F.try_element_at(order, F.col(state)), F.lit(0))
    return mentions.groupBy(key, disease.alias("disease")).agg(F.max_by(state, rank).alias("state"), F.min(day).alias("first_day"), F.count(F.lit(1)).alias("n_mentions"), F.count_distinct(day).alias("n_days"))


def taxonomy_levels(df: DataFrame, key: str, label: str, paths: list[tuple[str, list[str]]]) -> DataFrame:
    """key, level, node of the path of the first rule (pattern, path) that a label matches; a label without a rule has the path UNCLASSIFIED."""
    path = F.when(F.lit(False), F.lit(None).cast("array<string>"))
    for pattern, nodes in paths:
        path = path.when(F.col(label).rlike(pattern), F.array(*[F.lit(n) for n in nodes]))
    return df.select(key, F.posexplode(path.otherwise(F.array(F.lit("UNCLASSIFIED")))).alias("level", "node"))


def birth_dates(candidates: DataFrame, key: str, raw: str, tier: str) -> DataFrame:
    """key, birth_date, status, tier: the date that all readable candidates of the best tier agree on; CONFLICT where they differ, UNREADABLE where none can be read."""
    from factloom.operators.temporal import any_date

    rows = candidates.select(key, any_date(F.col(raw)).alias("d"), tier)
    per = rows.groupBy(key, tier).agg(F.min("d").alias("l"), F.max("d").alias("h"))
    best = per.groupBy(key).agg(F.min_by(F.struct(tier, "l", "h"), F.when(F.col("l").isNotNull(), F.col(tier))).alias("b"))
    agreed = F.col("b.l") == F.col("b.h")
    status = F.when(F.col("b.l").isNull(), "UNREADABLE").when(agreed, "LINKED").otherwise("CONFLICT")
    return best.select(key, F.when(agreed, F.col("b.l")).alias("birth_date"), status.alias("status"), F.when(F.col("b.l").isNotNull(), F.col(f"b.{tier}")).alias(tier))


def rule_hits(docs: DataFrame, key: str, body: str, rules: list[tuple[str, str]]) -> DataFrame:
    """rule, n_docs, n_hits, example (smallest key) for every rule of a table, also those that never match."""
    counts = F.array(*[F.struct(F.lit(name).alias("rule"), F.regexp_count(body, F.lit(p)).alias("hits")) for name, p in rules])
    rows = docs.select(key, F.explode(counts).alias("r")).select(key, "r.*")
    return rows.groupBy("rule").agg(F.count_if(F.col("hits") > 0).alias("n_docs"), F.coalesce(F.sum("hits"), F.lit(0)).alias("n_hits"), F.min(F.when(F.col("hits") > 0, F.col(key))).alias("example"))


def crossed_flags(df: DataFrame, keys: list[str], prefixes: dict[str, Column], exposures: dict[str, Column]) -> DataFrame:
    """variable, k, n: for every prefix (a subgroup) and exposure how many rows of the subgroup are exposed of those known; one scan, one aggregation."""
    names = {f"{p}_{e}": (F.when(sub, flag)) for p, sub in prefixes.items() for e, flag in exposures.items()}
    got = df.groupBy(*keys).agg(*[x for name, c in names.items() for x in (F.count_if(c).alias(f"{name}__k"), F.count(c).alias(f"{name}__n"))])
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}__k").alias("k"), F.col(f"{v}__n").alias("n")) for v in names]))
    return got.select(*keys, rows.alias("r")).select(*keys, "r.*")


def literal_evidence(scans: DataFrame, notes: DataFrame, key: str, scan_id: str, scan_day: str, kind: str, note_day: str, body: str, patterns: dict[str, str], days: int) -> DataFrame:
    """scans with n_notes and evidence: the only note of the same key, at most `days` away, that names the scan's kind; several are counted and none is taken.

    The join is on the key and buckets of `days`; notes that name no kind never reach it."""
    day = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    named = notes.select(F.col(key).alias("__k"), F.col(note_day).alias("__nd"), F.col(body).alias("__b"), F.explode(text.labels(F.col(body), list(patterns.items()))).alias("__kind"))
    right = named.withColumn("__bucket", F.floor(day("__nd") / (days + 1)))
    left = scans.select(key, scan_id, scan_day, kind).withColumn("__o", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("__at", F.floor(day(scan_day) / (days + 1)) + F.col("__o"))
    near = (F.col(key) == F.col("__k")) & (F.col("__at") == F.col("__bucket")) & (F.col(kind) == F.col("__kind"))
    pairs = left.join(right, near).where(F.abs(F.datediff(scan_day, "__nd")) <= days)
    found = pairs.groupBy(scan_id).agg(F.count(F.lit(1)).alias("n_notes"), F.min("__b").alias("__one"))
    out = scans.join(found, scan_id, "left").withColumn("n_notes", F.coalesce("n_notes", F.lit(0).cast("bigint")))
    return out.withColumn("evidence", F.when(F.col("n_notes") == 1, F.col("__one"))).drop("__one")


# Sides, places and kinds of findings in recordings of brain waves.
WAVES = [("EPILEPTIFORM", r"(?i)spike|sharp|epilepsietypisch"), ("SLOWING", r"(?i)verlangsam|theta|delta|slowing")]


def recording_findings(reports: DataFrame, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Exam values (key, background_low, background_high in Hz, reactive) and findings (key, place, kind, side, focal) of reports. Denied findings are none."""
    low, high = F.regexp_extract(body, r"(?i)(?:grund|background)\w*\D{0,30}?(\d{1,2})(?:\s*[-–]\s*(\d{1,2}))?\s*(?:/s|Hz)", 1), F.regexp_extract(body, r"(?i)(?:grund|background)\w*\D{0,30}?(\d{1,2})(?:\s*[-–]\s*(\d{1,2}))?\s*(?:/s|Hz)", 2)
    reactive = F.when(F.col(body).rlike(r"(?i)nicht reaktiv|unreactive"), False).when(F.col(body).rlike(r"(?i)reaktiv|reactive"), True)
    values = reports.select(key, low.try_cast("int").alias("background_low"), F.coalesce(high.try_cast("int"), low.try_cast("int")).alias("background_high"), reactive.alias("reactive"))
    spans = F.posexplode(assertions.clause_spans(F.col(body)))
    rows = reports.select(key, body, spans.alias("place", "__c")).withColumn("__t", F.substr(body, F.col("__c.start") + 1, F.col("__c.end") - F.col("__c.start")))
    rows = rows.where(~F.col("__t").rlike(r"(?i)\b(?:kein\w*|ohne|no)\b")).withColumn("kind", F.explode(text.labels(F.col("__t"), WAVES)))
    side = text.first_label(F.col("__t"), [("BILATERAL", r"(?i)beidseit|bds|bilateral|generalisiert"), ("LEFT", r"(?i)links|left"), ("RIGHT", r"(?i)rechts|right")])
    return values, rows.select(key, "place", "kind", side.alias("side"), F.col("__t").rlike(r"(?i)herd|fokal|focal|temporal|frontal").alias("focal"))


def copy_clusters(rows: DataFrame, key: str, row_id: str, body: str) -> DataFrame:
    """key, row_id, leader: texts of a key that a longer one holds word for word are copies of the longest such text; the leader points to itself.

    Equal texts are one before pairs are made, and a pair shares the key and the shorter text's first eight words, so that a key with many texts makes few pairs.
    """
    own = rows.select(key, row_id, text.normalized(F.col(body)).alias("__t"))
    texts = own.groupBy(key, "__t").agg(F.min(row_id).alias("__id"))
    words = F.split("__t", " ")
    grams = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 8, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, 8), " ")))
    short = texts.withColumn("__g", F.xxhash64(F.array_join(F.slice(words, 1, 8), " ")))
    long = texts.select(F.col(key).alias("__k"), F.col("__t").alias("__long"), F.col("__id").alias("__lid"), F.explode(F.array_distinct(grams(words))).alias("__lg"))
    pairs = short.join(long, (F.col(key) == F.col("__k")) & (F.col("__g") == F.col("__lg")) & (F.length("__long") > F.length("__t"))).where(F.contains("__long", "__t"))
    best = pairs.groupBy(key, "__t").agg(F.max_by("__lid", F.struct(F.length("__long"), (-F.col("__lid")).alias("m"))).alias("__top"))
    led = texts.join(best.select(F.col(key).alias("__k2"), F.col("__t").alias("__t2"), "__top"), (F.col(key) == F.col("__k2")) & (F.col("__t") == F.col("__t2")), "left")
    leaders = led.select(F.col(key).alias("__k3"), F.col("__t").alias("__t3"), F.coalesce("__top", "__id").alias("leader"))
    return own.join(leaders, (F.col(key) == F.col("__k3")) & (F.col("__t") == F.col("__t3"))).select(key, row_id, "leader")
