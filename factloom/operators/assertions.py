"""Assertions with scope: sentences, clauses and concept mentions as spans of the source, and what each mention asserts.

A cue speaks for one concept: words before a mention reach back to the mention before it, words after it to the next one. A negation is shared
only along a plain list (`no A, B or C`). Spans are code point offsets into the unchanged text, so that every state can be shown at its place.
Offsets of repeated matches are beyond the built-in functions; one Arrow-batched function finds all spans of a text in one pass.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Abbreviations whose stops end no sentence.
ABBREVIATIONS = ("z.n.", "v.a.", "z.b.", "d.h.", "u.a.", "i.v.", "p.o.", "dr.", "prof.", "ca.", "bzw.", "ggf.", "inkl.", "evtl.", "st.p.", "e.g.", "i.e.", "vs.", "nr.")
# Cue words of each state, in German and English.
CONTEXT = r"\b(?:Fragestellung|Indikation|Zuweisung|Clinical question|Indication)\b"
FAMILY = r"\b(?:Mutter|Vater|Bruder|Schwester|Großmutter|Großvater|Familienanamnese|mother|father|sister|brother|family history)\b"
CONDITIONAL = r"\b(?:falls|wenn|sofern|sollte|im Falle|bei Auftreten|if|in case of)\b"
NOT_EXCLUDED = r"\b(?:nicht\s+(?:sicher\s+)?(?:auszuschließen|ausgeschlossen)|cannot\s+be\s+(?:ruled\s+out|excluded))"
WORKUP = r"(?:\b(?:zur|zwecks)\s+(?:weiteren\s+)?Abklärung\b|\bDD\b|\bDifferenzialdiagnose\b|\brule\s+out\b|\bversus\b)"
EXCLUDED = r"^\s*(?:(?:wurde|konnte|ist|war|was|is)\s+)?(?:sicher\s+)?(?:ausgeschlossen|excluded|ruled\s+out)\b"
UNCERTAIN = r"\b(?:Verdacht\s+auf|V\.\s*a\.|fraglich\w*|möglich\w*|wahrscheinlich\w*|eventuell|könnte|suspected|possible|probable)"
NEGATOR = r"\b(?:kein\w*|ohne|nie|Ausschluss|no|not|without|never|negative\s+for|absence\s+of)\b"
NEGATED_AFTER = r"^\s*(?:\w+\s+){0,4}?(?:nicht|not)\s+(?:mehr\s+)?(?:nachweisbar|nachgewiesen|sichtbar|erkennbar|detektiert|vorhanden|detected|seen|present)\b"
HISTORICAL = r"(?:\bZ\.\s*n\.|\bZustand\s+nach|\bbekannt\w*|\banamnestisch\w*|\bfrüher\w*|\bknown|\bhistory\s+of)\s*(?:\w+\s+)?$"
QUALIFIER = r"\b(?:größer\w*|relevant\w*|wesentlich\w*|aktiv\w*|akut\w*|frisch\w*|larger|significant|acute)\b"
BRIDGE = r"\s*(?:,|oder|bzw\.?|und|sowie|or|and|nor)\s*(?:(?:oder|und|or|and|einer|eine|eines|einem|a|an)\s+)?"
CONTRAST = r"(?:,\s*)?\b(?:aber|jedoch|wobei|hingegen|but|however|although)\b"

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_MENTION = T.ArrayType(T.StructType([T.StructField("concept", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("start", "end")], T.StructField("state", T.StringType()), T.StructField("scope", T.StringType()), T.StructField("qualified", T.BooleanType()), *[T.StructField(c, T.IntegerType()) for c in ("clause_start", "clause_end")]]))
_SHORT = "|".join("[.] ?".join(re.escape(part) for part in a.split(".")).removesuffix(" ?") for a in ABBREVIATIONS)
_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
_PROTECTED = re.compile(rf"(?<!\w)(?:{_SHORT})|\d[.](?=\s?\d)|(?<=\d)[.](?=\s(?:{_MONTHS}))", re.I)
_SENTENCE_END = re.compile(r"[.!?]+(?=\s+[A-ZÄÖÜ0-9]|\s*$)|\n+")
_CLAUSE_END = re.compile(rf"[.!?]+(?=\s+[A-ZÄÖÜ0-9]|\s*$)|\n+|;|{CONTRAST}", re.I)


def _masked(text: str) -> str:
    """The text with protected stops as middle dots, each character in its place."""
    return _PROTECTED.sub(lambda m: m[0].replace(".", "·"), text)


def spans(text: str, ends: re.Pattern) -> list[tuple[int, int]]:
    """Trimmed non-empty stretches between ends; an end belongs to the stretch before it."""
    out, at, masked = [], 0, _masked(text)
    for end in [*(m.end() for m in ends.finditer(masked)), len(text)]:
        part = text[at:end]
        if part.strip():
            out.append((at + len(part) - len(part.lstrip()), at + len(part.rstrip())))
        at = end
    return out


def _column(ends: re.Pattern):
    @F.pandas_udf(_SPAN)
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [{"start": a, "end": b} for a, b in spans(t, ends)])

    return cut


def sentence_spans(text: Column) -> Column:
    """Array of struct(start, end) of the sentences; stops of abbreviations, numbers and dates end none."""
    return _column(_SENTENCE_END)(text)


def clause_spans(text: Column) -> Column:
    """Array of struct(start, end) of the clauses: sentences, cut also at semicolons and contrasting words."""
    return _column(_CLAUSE_END)(text)


def _found(pattern: str, text: str) -> bool:
    return re.search(pattern, text, re.I) is not None


def state_of(clause: str, before: str, after: str, listed_negation: bool) -> str:
    """State of a mention from its clause and the words that are its own; the strictest that applies."""
    if _found(CONTEXT, clause):
        return "CONTEXT_ONLY"
    if _found(FAMILY, clause):
        return "FAMILY"
    if _found(CONDITIONAL, before):
        return "CONDITIONAL"
    if _found(NOT_EXCLUDED, after):
        return "UNCERTAIN"
    if _found(WORKUP, before):
        return "DIFFERENTIAL"
    if _found(EXCLUDED, after) or _found(NEGATED_AFTER, after):
        return "ABSENT"
    if _found(UNCERTAIN, before) or (_found(r"^\s*\?", after)):
        return "UNCERTAIN"
    if _found(NEGATOR, before) or listed_negation:
        return "ABSENT"
    return "PRESENT"


def mentions_in(text: str, concepts: list[tuple[str, re.Pattern]]) -> list[dict]:
    """All concept mentions of a text, longest first where they overlap, with state, scope and clause."""
    out = []
    for a, z in spans(text, _CLAUSE_END):
        clause = text[a:z]
        hits = sorted(((m.start(), -m.end(), name) for name, p in concepts for m in p.finditer(clause)))
        kept: list[tuple[int, int, str]] = []
        for start, end, name in hits:
            if not kept or start >= kept[-1][1]:
                kept.append((start, -end, name))
        negated = qualified_list = False
        for k, (start, end, name) in enumerate(kept):
            before = clause[kept[k - 1][1] if k else 0 : start]
            after = clause[end : kept[k + 1][0] if k + 1 < len(kept) else len(clause)]
            listed = k > 0 and re.fullmatch(BRIDGE, before, re.I) is not None
            state = state_of(clause, before, after, listed and negated)
            qualified = _found(QUALIFIER, before) or (listed and qualified_list)
            negated, qualified_list = state == "ABSENT", qualified
            historical = state == "PRESENT" and _found(HISTORICAL, before)
            scope = "HYPOTHETICAL" if state == "CONDITIONAL" else "HISTORICAL" if historical else "CURRENT"
            out.append({"concept": name, "start": a + start, "end": a + end, "state": state, "scope": scope, "qualified": qualified, "clause_start": a, "clause_end": z})
    return out


def mentions(docs: DataFrame, key: str, text: str, concepts: dict[str, str]) -> DataFrame:
    """key, concept, start, end, state, scope, qualified, clause_start, clause_end of every mention.

    state: CONTEXT_ONLY, FAMILY, CONDITIONAL, DIFFERENTIAL, UNCERTAIN, ABSENT or PRESENT; scope: CURRENT, HISTORICAL, HYPOTHETICAL; qualified: a
    modifier narrows what is asserted (no *larger* mass is not no mass). Each distinct text is searched once; null texts have no mention.
    """
    patterns = [(name, re.compile(p, re.I)) for name, p in concepts.items()]

    @F.pandas_udf(_MENTION)
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else mentions_in(t, patterns))

    known = docs.where(F.col(text).isNotNull()).select(key, F.col(text).alias("__t"), F.sha2(text, 256).alias("__h"))
    texts = known.groupBy("__h").agg(F.any_value("__t").alias("__t"))
    found = texts.select("__h", F.explode(find("__t")).alias("m"))
    return known.select(key, "__h").join(found, "__h").select(key, "m.*")


def negative_findings(found: DataFrame, key: str) -> DataFrame:
    """key, negatives: sorted concepts that are explicitly absent, without a qualifier that narrows the denial."""
    rows = found.where((F.col("state") == "ABSENT") & ~F.col("qualified"))
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("concept")), ",").alias("negatives"))


def findings_by_kind(found: DataFrame, key: str, supported: list[str]) -> DataFrame:
    """key, kind, concept, n: every mention is a finding, a negative, uncertain, or rejected (context, family, condition, qualified denial, concept that isn't supported)."""
    state = F.col("state")
    kind = F.when(~F.col("concept").isin(supported) | state.isin("CONTEXT_ONLY", "FAMILY", "CONDITIONAL"), "rejected").when(state == "PRESENT", "finding").when(state == "ABSENT", F.when(F.col("qualified"), "rejected").otherwise("negative")).otherwise("uncertain")
    return found.groupBy(key, kind.alias("kind"), "concept").agg(F.count(F.lit(1)).alias("n"))


# Words that name a way of looking for a finding, by what they are.
MODALITIES = [("HOLTER", r"(?i)holter|langzeit-?ekg|24[ -]?h-?ekg"), ("TELEMETRY", r"(?i)telemetr"), ("MONITORING", r"(?i)monitor"), ("ECG", r"(?i)\b(?:ekg|ecg)\b")]


def observation(text: Column, state: Column) -> list[Column]:
    """observation_type (SEARCH where a way of looking is named or the finding is absent after one, RISK_CONTEXT for risks, else ASSERTION) and modality."""
    modality = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, p in MODALITIES:
        modality = modality.when(text.rlike(p), name)
    looked = modality.isNotNull()
    kind = F.when((state == "UNCERTAIN") & text.rlike(r"(?i)risiko|gefahr|\brisk\b"), "RISK_CONTEXT").when(looked, "SEARCH").otherwise("ASSERTION")
    return [kind.alias("observation_type"), modality.otherwise("OTHER").alias("modality")]


# Words of the age of a lesion, most specific first.
LESION_AGES = [("INTERVAL_NEW", r"(?i)\bneu (?:aufgetreten|hinzugekommen)|\bnew since\b|neu im vergleich"), ("SUBACUTE", r"(?i)subakut|subacute"), ("ACUTE", r"(?i)\bakut|frisch|\bacute"), ("CHRONIC", r"(?i)\balt\w{0,2}\b|chronisch|residu|\bold\b|chronic")]


def lesion_age(clause: Column) -> Column:
    """INTERVAL_NEW (seen for the first time, which tells nothing of its age), SUBACUTE, ACUTE, CHRONIC, or null; CONFLICT where a clause says several ages."""
    said = F.array_compact(F.array(*[F.when(clause.rlike(p), name) for name, p in LESION_AGES]))
    ages = F.filter(said, lambda s: s != "INTERVAL_NEW")
    return F.when(F.size(ages) > 1, "CONFLICT").when(F.size(ages) == 1, F.get(ages, F.lit(0))).otherwise(F.get(said, F.lit(0)))
