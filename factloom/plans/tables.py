"""Queries of the rule tables, named after the rows of the coverage table whose kind of rule they evaluate: small vocabularies that fit the driver's texts, evaluated on whole tables, and the same rules in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import extract, rules
from factloom.plans.catalogue import Tables, query

P = "o_orderpriority"
URGENT, HIGH, MEDIUM, NONE, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"
MEDICINE_TEXTS = {URGENT: "Enoxaparin 40 mg", HIGH: "ELIQUIS 5 mg", MEDIUM: "Keppra 500", NONE: "Thrombo ASS 100", LOW: "Vitamin D"}
RECORDING_TEXTS = {URGENT: "EEG zeigte Spikes links", HIGH: "Ein EEG ist geplant", MEDIUM: "siehe EEG", NONE: "EEG vom 3.4.2000\nGrundrhythmus 9 Hz, nicht sicher beurteilbar bei Artefakten", LOW: "Infarkt"}


def _said(column: str, texts: dict[str, str]) -> Column:
    """The text that stands for a value of a column; null for others."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in texts.items() for x in pair]), F.col(column))

#: Small words of the four languages of the texts.
LANGUAGE_WORDS = [("EN", rules.words("the", "of", "and")), ("FR", rules.words("les", "des", "qui")), ("DE", rules.words("der", "die", "und")), ("ES", rules.words("los", "el", "por"))]
_SQL_WORDS = {n: p.replace("'", "''") for n, p in LANGUAGE_WORDS}
_EN, _FR, _DE, _ES = (f"regexp_matches(text, '{_SQL_WORDS[n]}')" for n in ("EN", "FR", "DE", "ES"))
_FOUND = f"list_filter([CASE WHEN {_EN} THEN 'EN' END, CASE WHEN {_FR} THEN 'FR' END, CASE WHEN {_DE} THEN 'DE' END, CASE WHEN {_ES} THEN 'ES' END], lambda x: x IS NOT NULL)"
#: The first line that isn't blank.
_LEAD = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '')[1]"



@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '/en/') THEN 'EN' WHEN regexp_matches(url, '/(fr|es)/') AND NOT regexp_matches(html, '<table') THEN 'ROMANCE' WHEN regexp_matches(url, '/de/') THEN 'DE' ELSE 'OTHER' END AS scope,
  CASE WHEN regexp_matches(url, '[?&]ref=') THEN false WHEN regexp_matches(url, '[?#]') THEN true END AS direct FROM pages""")
def study_rules(t: Tables) -> DataFrame:
    fields = {"url": F.col("url"), "html": F.col("html")}
    scope = rules.decide(fields, [("EN", {"url": "/en/"}, {}), ("ROMANCE", {"url": "/(fr|es)/"}, {"html": "<table"}), ("DE", {"url": "/de/"}, {})], "OTHER")
    return t.pages.select("page_id", scope.alias("scope"), rules.stated(F.col("url"), "[?#]", "[?&]ref=").alias("direct"))


@query("""SELECT item_id, coalesce(name LIKE 'large%' AND kind IN ('home', 'office') AND size >= 12 AND NOT regexp_matches(name, 'plate|bolt'), false) AS wanted FROM items""")
def t2_series(t: Tables) -> DataFrame:
    rule = ("WANTED", {"name": "^large", "kind": r"^(home|office)\z"}, {"name": "plate|bolt"})
    return t.items.select("item_id", rules.combined(rules.holds({"name": F.col("name"), "kind": F.col("kind")}, rule), F.col("size") >= 12).alias("wanted"))


@query(f"""SELECT doc_id, array_to_string({_FOUND}, ',') AS languages, CASE WHEN regexp_matches(text, '(no|sin|kein) [0-9]') THEN false WHEN regexp_matches(text, '[0-9]') THEN true END AS numbers FROM documents""")
def mri_techniques(t: Tables) -> DataFrame:
    found = rules.every({"text": F.col("text")}, rules.on("text", LANGUAGE_WORDS))
    return t.documents.select("doc_id", F.array_join(found, ",").alias("languages"), rules.stated(F.col("text"), "[0-9]", "(no|sin|kein) [0-9]").alias("numbers"))


@query(f"""SELECT doc_id, CASE len(f) WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN f[1] ELSE 'MIXED' END AS spoken FROM (SELECT doc_id, {_FOUND} AS f FROM documents)""")
def macro_locations(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", rules.exclusive({"text": F.col("text")}, rules.on("text", LANGUAGE_WORDS), "MIXED", "UNKNOWN").alias("spoken"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'ECONOMY' THEN p_size * 10.0 ELSE p_size * 1.0 END AS d1, CASE WHEN p_type <> 'PROMO' THEN CASE WHEN p_type = 'ECONOMY' THEN 25.0 ELSE 2.5 END END AS d2, CASE WHEN p_type = 'STANDARD' THEN 7.0 END AS d3,
  CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'ECONOMY' THEN greatest(p_size * 10.0, 25.0) WHEN p_type = 'STANDARD' THEN greatest(p_size, 7.0) ELSE greatest(p_size, 2.5) END AS longest, CASE WHEN p_type = 'PROMO' THEN p_size + 0.5 END AS volume_ml FROM part""")
def lesion_dimensions(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    said = F.when(kind == "PROMO", F.concat(F.lit("Volume about "), "p_size", F.lit(",5 ml"))).when(kind == "ECONOMY", F.concat("p_size", F.lit(" x 2,5 cm"))).when(kind == "STANDARD", F.concat("p_size", F.lit(" x 2,5 × 7 mm"))).otherwise(F.concat("p_size", F.lit(" x 2.5 mm")))
    return t.part.select("p_partkey", *rules.dimensions(said))


@query(r"""SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[?]\s*\z') THEN false WHEN regexp_matches(text, '[.!]') THEN true END AS stated, CASE WHEN regexp_matches(text, '[0-9]{3}') THEN false WHEN regexp_matches(text, '[0-9]') THEN true END AS short_number FROM conversations""")
def bleeding_morphology(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.conversations.select("conv_id", "turn", rules.stated(text, "[.!]", r"[?]\s*\z").alias("stated"), rules.stated(text, "[0-9]", "[0-9]{3}").alias("short_number"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)copyright|license') THEN 'LICENCE' WHEN regexp_matches(text, '(password|token)') AND regexp_matches(text, '[0-9a-f]{24}') THEN 'SECRET' WHEN regexp_matches(text, '[^ ]@[^ ]')
  AND NOT regexp_matches(text, 'example[.](com|org)') THEN 'CONTACT' WHEN regexp_matches(text, '!!') THEN 'SHOUTED' ELSE 'PLAIN' END AS status FROM documents""")
def stated_diagnoses(t: Tables) -> DataFrame:
    table = [("LICENCE", {"text": "(?i)copyright|license"}, {}), ("SECRET", {"text": "(password|token)", "again": "[0-9a-f]{24}"}, {}), ("CONTACT", {"text": "[^ ]@[^ ]"}, {"text": "example[.](com|org)"}), ("SHOUTED", {"text": "!!"}, {})]
    return t.documents.select("doc_id", rules.decide({"text": F.col("text"), "again": F.col("text")}, table, "PLAIN").alias("status"))


#: Classes of medicines (category, subclass, agent) by their names; the first that is in a name counts.
MEDICINES = [
    (("ANTITHROMBOTIC", "ANTICOAGULANT", "LMWH"), "Fragmin|Enoxaparin|Clexane|Lovenox|Dalteparin|Nadroparin|Tinzaparin"),
    (("ANTITHROMBOTIC", "ANTICOAGULANT", "UFH"), "Heparin|Liquemin|Calciparin"),
    (("ANTITHROMBOTIC", "ANTICOAGULANT", "VKA"), "Marcoumar|Phenprocoumon|Warfarin|Acenocoumarol|Sintrom"),
    (("ANTITHROMBOTIC", "ANTICOAGULANT", "DOAC"), "Lixiana|Eliquis|Xarelto|Pradaxa|Edoxaban|Apixaban|Rivaroxaban|Dabigatran"),
    (("ANTITHROMBOTIC", "ANTIPLATELET", "ASPIRIN"), r"ASS|Aspirin|Acetylsalicylsäure|Thrombo\s*ASS"),
    (("ANTITHROMBOTIC", "ANTIPLATELET", "P2Y12_INHIBITOR"), "Plavix|Clopidogrel|Ticagrelor|Brilique|Prasugrel|Efient"),
    (("ANTIHYPERTENSIVE", None, None), "Ramipril|Bisoprolol|Concor|Amlodipin|Lisinopril|Candesartan|Valsartan|Enalapril|Metoprolol|Nebivolol|Carvedilol|Losartan"),
    (("LIPID_LOWERING", None, None), "Atorvastatin|Simvastatin|Rosuvastatin|Pravastatin|Ezetimib|Sortis"),
    (("ANTISEIZURE", None, None), "Levetiracetam|Keppra|Perampanel|Lacosamid|Vimpat|Valproat|Lamotrigin|Carbamazepin|Phenytoin|Gabapentin|Pregabalin|Lyrica"),
    (("ANTIDEMENTIA", None, None), "Donepezil|Memantin|Rivastigmin|Galantamin"),
    (("ANTIDEPRESSANT", None, None), "Sertralin|Escitalopram|Citalopram|Trazodon|Mirtazapin|Duloxetin|Venlafaxin"),
]
#: What an anticoagulant is for, by the words of its source.
ANTICOAGULANT_ROLES = [("VTE_PROPHYLAXIS", r"(?i)(?:Thrombose|VTE)[- ]?prophylax|prophylaktisch"), ("THERAPEUTIC_ANTICOAGULATION", r"(?i)therapeutisch|Vollheparinisierung")]


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'ANTISEIZURE' WHEN '5-LOW' THEN 'OTHER' ELSE 'ANTITHROMBOTIC' END AS category, CASE o_orderpriority WHEN '1-URGENT' THEN 'ANTICOAGULANT' WHEN '2-HIGH' THEN 'ANTICOAGULANT' WHEN '4-NOT SPECIFIED' THEN 'ANTIPLATELET' END AS subclass,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'LMWH' WHEN '2-HIGH' THEN 'DOAC' WHEN '4-NOT SPECIFIED' THEN 'ASPIRIN' END AS agent, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CASE WHEN o_orderstatus = 'F' THEN 'VTE_PROPHYLAXIS' ELSE 'UNKNOWN' END WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ANTIPLATELET' ELSE 'UNKNOWN' END AS role FROM orders""")
def medicine_classes(t: Tables) -> DataFrame:
    """Category, subclass and agent of a medicine by its name, and its role; that of an anticoagulant comes from the words of its source."""
    table = [(label, {"name": rf"(?i)\b(?:{names})\b"}, {}) for label, names in MEDICINES]
    source = F.when(F.col("o_orderstatus") == "F", "zur Thromboseprophylaxe").otherwise("laut Plan")
    found = rules.decide({"name": _said(P, MEDICINE_TEXTS)}, table, ("OTHER", None, None), ["category", "subclass", "agent"])
    role = F.when(F.col("subclass") == "ANTICOAGULANT", rules.decide({"source": F.col("source")}, rules.on("source", ANTICOAGULANT_ROLES), "UNKNOWN")).when(F.col("subclass") == "ANTIPLATELET", "ANTIPLATELET").otherwise("UNKNOWN")
    return t.orders.select("o_orderkey", source.alias("source"), found.alias("m")).select("o_orderkey", "source", "m.*").withColumn("role", role).drop("source")


@query(r"""SELECT item_id, CASE WHEN name LIKE '%bolt%' OR name LIKE '%widget%' THEN 'PART' WHEN name LIKE '%plate%' THEN 'WARE' ELSE 'OTHER' END AS category,
  CASE WHEN name LIKE '%bolt%' THEN 'FIXING' WHEN name LIKE '%widget%' THEN 'DEVICE' END AS subclass FROM items""")
def item_classes(t: Tables) -> DataFrame:
    table = [(("PART", "FIXING"), {"name": "bolt"}, {}), (("PART", "DEVICE"), {"name": "widget"}, {}), (("WARE", None), {"name": "plate"}, {})]
    return t.items.select("item_id", rules.decide({"name": F.col("name")}, table, ("OTHER", None), ["category", "subclass"]).alias("m")).select("item_id", "m.*")


@query("""SELECT sale_id, line_no, item_id, amount, CASE WHEN amount < 100 THEN 'LOW' WHEN amount > quantity * 200.0 THEN 'HIGH' WHEN amount IS NOT NULL AND quantity IS NOT NULL THEN 'NORMAL' ELSE 'UNKNOWN' END AS flagged FROM sale_lines WHERE flag = 'kept'""")
def first_values(t: Tables) -> DataFrame:
    rows = t.sale_lines.where("flag = 'kept'")
    return rows.select("sale_id", "line_no", "item_id", "amount", rules.against(F.col("amount"), F.lit(100.0), F.col("quantity") * 200.0).alias("flagged"))


@query(r"""WITH f AS (SELECT client_id, list_distinct(list_filter([CASE WHEN regexp_matches(name, '(?i)(^|[^\p{L}\p{N}])(jr|junior)([^\p{L}\p{N}]|\z)') THEN 'younger' END, CASE WHEN regexp_matches(name, '^[^a-z]+\z') THEN 'shouted' END], lambda x: x IS NOT NULL)) AS f FROM clients)
  SELECT client_id, CASE len(f) WHEN 0 THEN 'plain' WHEN 1 THEN f[1] ELSE 'AMBIGUOUS' END AS form FROM f""")
def kinship_degrees(t: Tables) -> DataFrame:
    table = rules.on("name", [("younger", rules.words("jr", "junior")), ("shouted", r"^[^a-z]+\z")])
    return t.clients.select("client_id", rules.exclusive({"name": F.col("name")}, table, none="plain").alias("form"))


@query(f"""WITH h AS (SELECT doc_id, coalesce({_LEAD}, '') AS text FROM documents) SELECT doc_id, CASE WHEN length(text) <= 160 THEN array_to_string({_FOUND}, ',') ELSE '' END AS targets FROM h""")
def section_targets(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(rules.routed(F.lit(None).cast("string"), F.coalesce("text", F.lit("")), rules.on("heading", LANGUAGE_WORDS)), ",").alias("targets"))


@query(r"""WITH l AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)
  SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'KEEP' WHEN before IS NULL THEN 'START' WHEN regexp_matches(before, '[?]') THEN 'ANSWER' WHEN regexp_matches(text, '[?]') AND NOT coalesce(regexp_matches(before, '[0-9]'), false) THEN 'ASK' ELSE 'GO ON' END AS action FROM l""")
def heading_actions(t: Tables) -> DataFrame:
    """What a turn does by its role, its text and the turn before it."""
    last = t.conversations.select(F.col("conv_id").alias("c"), F.col("turn").alias("k"), F.col("text").alias("before"), F.lead("turn").over(Window.partitionBy("conv_id").orderBy("turn")).alias("of"))
    rows = t.conversations.join(last, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("of")), "left")
    fields = {"role": F.col("role"), "text": F.col("text"), "before": F.col("before"), "any": F.when(F.col("before").isNotNull(), "x")}
    table = [("KEEP", {"role": r"^system\z"}, {}), ("START", {}, {"any": "x"}), ("ANSWER", {"before": "[?]"}, {}), ("ASK", {"text": "[?]"}, {"before": "[0-9]"})]
    return rows.select("conv_id", "turn", rules.decide(fields, table, "GO ON").alias("action"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'page_of' WHEN c_mktsegment = 'FURNITURE' THEN 'footer' END AS pattern, CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey END AS page_number FROM customer""")
def page_lines(t: Tables) -> DataFrame:
    line = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" Seite  "), "c_nationkey", F.lit(" von 40"))).when(F.col("c_mktsegment") == "FURNITURE", "Klinik – Telefon 123").otherwise(F.concat(F.lit("siehe Seite 3 von 4 "), "c_name"))
    found = rules.page_line(line, [("page_of", r"Seite (\d+) von \d+"), ("footer", r"Klinik - Telefon \d+")])
    return t.customer.select("c_custkey", found.alias("l")).select("c_custkey", "l.pattern", "l.page_number")


@query("""SELECT c_custkey, CAST(i AS INTEGER) AS place, CASE i WHEN 0 THEN 'Klinische Angaben' WHEN 2 THEN CASE WHEN c_acctbal < 0 THEN 'Labor' ELSE 'Laborbefunde im Verlauf' END END AS heading FROM customer, (VALUES (0), (1), (2), (3), (4)) v(i)""")
def joined_headings(t: Tables) -> DataFrame:
    last = F.when(F.col("c_acctbal") < 0, F.array(F.lit("Labor"), F.lit("normal"), F.lit("x"))).otherwise(F.array(F.lit("Labor"), F.lit("befunde"), F.lit("im Verlauf:")))
    lines = F.concat(F.array(F.lit("Klinische"), F.lit("Angaben:")), last)
    found = rules.joined_headings(lines, ["Klinische Angaben", "Labor", "Laborbefunde im Verlauf"])
    return t.customer.select("c_custkey", F.posexplode(found).alias("place", "heading"))


@query(r"""WITH l AS (SELECT doc_id, i, s[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
  m AS (SELECT *, coalesce(last_value(CASE WHEN regexp_matches(line, '^(And|Des|Die|Las)') THEN 'on' WHEN regexp_matches(line, '^(The|Les|Der|Los)') THEN 'off' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i), 'on') AS m FROM l)
  SELECT doc_id, md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE m = 'on'), '')) AS kept FROM m GROUP BY doc_id""")
def foreign_parts(t: Tables) -> DataFrame:
    return t.documents.where("text IS NOT NULL").select("doc_id", F.md5(rules.without_part(F.col("text"), "^(The|Les|Der|Los)", "^(And|Des|Die|Las)")).alias("kept"))


@query(r"""SELECT doc_id, len(l) > 0 AND len(list_filter(l, lambda x: NOT regexp_matches(x, '[.]\z'))) = 0 AS closed FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents)""")
def unmeasured_tables(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", rules.all_lines(F.col("text"), r"[.]\z").alias("closed"))


#: Features of a report of a recording of brain waves, by their words.
FEATURES = {
    "normal": r"(?i)Normalbefund|normales?\s+EEG|Grenzen\s+der\s+Norm", "focal_slowing": r"(?i)fokal\w*\s+Verlangsamung|Herdstörung", "generalized_slowing": r"(?i)(?:generalisiert|diffus)\w*\s+Verlangsamung|Allgemeinveränderung",
    "epileptiform": r"(?i)Spikes?\b|Sharp[- ]Waves?|epilepsietypisch", "periodic": r"\b[LG]PDs?\b|\b[LG]RDA\b", "sleep": r"(?i)Schlafspindel|K[- ]Komplex|Vertex", "artifact": r"(?i)Artefakt|nicht\s+(?:beurteilbar|auswertbar)",
    "seizure_context": r"(?i)Status\s+epilepticus|Anfall|Anfälle|Epilepsie", "stroke_context": r"(?i)Infarkt|Schlaganfall|ischämisch", "dementia_context": r"(?i)Demenz|Enzephalopathie",
}
_NAMED, _NOT_DONE = r"\bEEG\b|(?i)Elektroen[cz]ephalo", r"(?i)EEG[^.!?\n]{0,40}nicht\s+durchgeführt"
_RESULT = r"(?i)(?:EEG|Elektroen[cz]ephalo\w*)[^.!?\n]{0,60}(?:zeigte|ergab|abgeleitet|unauffällig)"
_HEADED = r"(?im)^[ \t]*EEG\b[^\n]{0,140}\d{1,2}\.\d{1,2}\.\d{4}[\s\S]{0,400}?(?:grundrhythm|grundaktivit|Hz|herdbefund)"
_PLANNED = r"(?i)empfohlen|geplant|angefordert|vorgesehen|nicht\s+durchgeführt"
#: Whether a report tells of a recording, plans one or only names one; and the wording that rules alone don't settle.
RECORDINGS = [("PERFORMED", {"text": _RESULT}, {"text": _NOT_DONE}), ("PERFORMED", {"text": _HEADED}, {"text": _NOT_DONE}), ("PLANNED", {"text": _PLANNED, "again": _NAMED}, {}), ("REFERENCED", {"text": _NAMED}, {})]
UNSETTLED = ("UNSETTLED", {"text": r"(?i)broad[- ]sharp|nicht\s+(?:sicher\s+)?beurteilbar|iktal|Korrelation|Phasenumkehr|triphasisch|bifronto"}, {})


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'PERFORMED' WHEN '2-HIGH' THEN 'PLANNED' WHEN '3-MEDIUM' THEN 'REFERENCED' WHEN '4-NOT SPECIFIED' THEN 'PERFORMED' ELSE 'UNKNOWN' END AS class, o_orderpriority = '4-NOT SPECIFIED' AS needs_semantics, o_orderpriority = '1-URGENT' AS epileptiform,
  o_orderpriority = '4-NOT SPECIFIED' AS artifact, o_orderpriority = '5-LOW' AS stroke_context, o_custkey >= 50 AS many FROM orders""")
def recording_screen(t: Tables) -> DataFrame:
    said = _said(P, RECORDING_TEXTS)
    fields = {"text": said, "again": said}
    got = t.orders.select("o_orderkey", rules.decide(fields, RECORDINGS, "UNKNOWN").alias("class"), rules.holds(fields, UNSETTLED).alias("needs_semantics"), *rules.features(said, FEATURES, {"many": (F.col("o_custkey"), 50)}))
    return got.select("o_orderkey", "class", "needs_semantics", "epileptiform", "artifact", "stroke_context", "many")


@query(f"""SELECT doc_id, coalesce({_EN}, false) AS english, coalesce(regexp_matches(text, '[0-9]'), false) AS numbers, coalesce(regexp_matches(text, '(?i)copyright|license'), false) AS licence, coalesce(n_chars >= 2000, false) AS long FROM documents""")
def document_screen(t: Tables) -> DataFrame:
    table = {"english": LANGUAGE_WORDS[0][1], "numbers": "[0-9]", "licence": "(?i)copyright|license"}
    return t.documents.select("doc_id", *rules.features(F.col("text"), table, {"long": (F.col("n_chars"), 2000)}))


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents WHERE text IS NOT NULL), d AS (SELECT doc_id, CASE WHEN {_EN} THEN 'EN' WHEN {_FR} THEN 'FR' WHEN {_DE} THEN 'DE' WHEN {_ES} THEN 'ES' END AS spoken FROM l)
  SELECT doc_id, spoken, count(*) AS n FROM d GROUP BY doc_id, spoken""")
def laboratory_lines(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", rules.decide({"line": F.col("line")}, rules.on("line", LANGUAGE_WORDS)).alias("spoken")).groupBy("doc_id", "spoken").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'order' AS kind, CAST(o_custkey AS VARCHAR) AS anchor, '{"status":"' || o_orderstatus || '","key":' || o_orderkey || '}' AS value, o_orderpriority AS evidence FROM orders
  UNION ALL SELECT 'event', CAST(user_id AS VARCHAR), '{"type":"' || event_type || '"}', CAST(event_id AS VARCHAR) FROM events""")
def nested_projection(t: Tables) -> DataFrame:
    c = F.col
    return extract.projected([(t.orders, "order", c("o_custkey"), [c("o_orderstatus").alias("status"), c("o_orderkey").alias("key")], c(P)), (t.events, "event", c("user_id"), [c("event_type").alias("type")], c("event_id"))])


@query("""WITH s AS (SELECT o_custkey, CAST(floor(o_totalprice / 10000) AS DOUBLE) * -2.0 AS z FROM orders), d AS (SELECT o_custkey, z - lag(z) OVER (PARTITION BY o_custkey ORDER BY z) AS step FROM s), m AS (SELECT o_custkey, count(*) AS n, median(step) FILTER (WHERE step > 0) AS step FROM d GROUP BY o_custkey)
  SELECT m.o_custkey, m.n, round(m.step, 6) AS step, CAST(count(*) FILTER (WHERE d.step > m.step * 1.5) AS INTEGER) AS n_gaps, CAST(count(*) FILTER (WHERE d.step = 0) AS INTEGER) AS n_repeats FROM m JOIN d ON m.o_custkey = d.o_custkey GROUP BY m.o_custkey, m.n, m.step""")
def slice_geometry(t: Tables) -> DataFrame:
    cosines = {"r1": 0.0, "r2": 1.0, "r3": 0.0, "c1": 1.0, "c2": 0.0, "c3": 0.0}
    slices = t.orders.select("o_custkey", F.lit(7.0).alias("x"), F.col("o_totalprice").alias("y"), (F.floor(F.col("o_totalprice") / 10000) * 2.0).alias("z"), *[F.lit(v).alias(k) for k, v in cosines.items()])
    return extract.slice_geometry(slices, ["o_custkey"], ["x", "y", "z"], list(cosines))

