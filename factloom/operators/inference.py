"""Inference by supplied functions: backends, two passes, batches, attempts, and validators that let nothing through that the source doesn't support.

A backend is a vectorised function of request texts. The operators around it are plain DataFrame code: every distinct request is asked once, every answer is
parsed against a schema, every field needs evidence in its source, and what fails is a row with a reason.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.operators.text import normalized

Backend = Callable[[pd.Series], pd.Series]


def word_stub(texts: pd.Series) -> pd.Series:
    """A deterministic stand-in: the first and last word of a request, and the number of its words, as JSON."""

    def one(t: str) -> str:
        words = t.split()
        return json.dumps({"first": words[0], "last": words[-1], "words": len(words)} if words else {}, ensure_ascii=False)

    return texts.map(one, na_action="ignore")


def failing_stub(texts: pd.Series) -> pd.Series:
    """Answers that are no JSON."""
    return texts.map(lambda t: "no answer", na_action="ignore")


BACKENDS: dict[str, Backend] = {"words": word_stub, "failing": failing_stub}


def backend(name: str) -> Backend:
    """The backend of that name; programs add theirs to BACKENDS."""
    if name not in BACKENDS:
        raise KeyError(f"no backend {name}; there are {sorted(BACKENDS)}")
    return BACKENDS[name]


def asked(rows: DataFrame, request: str, ask: Backend, schema: str) -> DataFrame:
    """rows with `answer` (typed, null unless the text parses as the schema) and `raw`. Each distinct request is asked once."""
    call = F.pandas_udf(ask, "string")
    answers = rows.select(F.col(request).alias("__r")).where("__r is not null").distinct().withColumn("raw", call("__r"))
    parsed = F.from_json("raw", schema, {"mode": "PERMISSIVE"})
    out = rows.join(answers, F.col(request) == F.col("__r"), "left").drop("__r")
    return out.withColumn("answer", F.when(F.col("raw").rlike(r"^\s*[{\[]"), parsed))


def two_pass(docs: DataFrame, key: str, body: str, detect: Callable[[Column], Column], ask: Backend, schema: str) -> DataFrame:
    """key, place, episode, answer, grounded: a first pass detects episodes (an array of texts), a second asks about each of them.

    An episode that isn't in its source text (blanks aside) is not asked about: its answer is null and grounded is false.
    """
    episodes = docs.select(key, body, F.posexplode(detect(F.col(body))).alias("place", "episode"))
    grounded = F.coalesce(F.contains(normalized(F.col(body)), normalized(F.col("episode"))) & (F.length(F.trim("episode")) > 0), F.lit(False))
    rows = episodes.withColumn("grounded", grounded).withColumn("__ask", F.when(F.col("grounded"), F.col("episode")))
    return asked(rows, "__ask", ask, schema).select(key, "place", "episode", "answer", "grounded")


def supported_fields(rows: DataFrame, source: str, fields: dict[str, str]) -> DataFrame:
    """rows whose fields stay only where their evidence column's quote is in the source; flags lists the fields that were taken away and why.

    fields: value column -> evidence column. Reasons: NO_EVIDENCE (no quote), NOT_IN_SOURCE, VALUE_NOT_IN_EVIDENCE (text values must be in their quote).
    """
    out, flags = {}, []
    kinds = dict(rows.dtypes)
    for value, evidence in fields.items():
        quote = normalized(F.col(evidence))
        missing = F.coalesce(quote == "", F.lit(True))
        elsewhere = ~F.coalesce(F.contains(normalized(F.col(source)), quote), F.lit(False))
        own = ~F.coalesce(F.contains(quote, normalized(F.col(value))), F.lit(False)) if kinds[value] == "string" else F.lit(False)
        reason = F.when(F.col(value).isNull(), None).when(missing, "NO_EVIDENCE").when(elsewhere, "NOT_IN_SOURCE").when(own, "VALUE_NOT_IN_EVIDENCE")
        out[value] = F.when(reason.isNull(), F.col(value))
        flags.append(F.when(reason.isNotNull(), F.concat(F.lit(f"{value}:"), reason)))
    return rows.withColumn("flags", F.array_join(F.array_compact(F.array(*flags)), ",")).withColumns(out)


def validated_items(rows: DataFrame, key: str, raw: str, schema: str, rules: Callable[[Callable[[str], Column]], dict[str, Column]], spans: DataFrame | None = None, span: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good and bad items of JSON arrays: key, place, item, and for bad ones the reasons.

    An item must parse as the schema (else SHAPE), name a span of its document that is known (else PROVENANCE; spans has key and span), and keep every rule; rules get
    a function from field names to columns. A text that is no JSON array is one bad item. Nothing is lost: good and bad items are all items.
    """
    items = F.from_json(raw, T.ArrayType(T.StructType.fromDDL(schema)), {"mode": "PERMISSIVE"})
    parsed = rows.select(key, F.posexplode_outer(F.when(F.col(raw).rlike(r"^\s*\["), items)).alias("place", "item"))
    if spans is not None:
        known = spans.select(F.col(key).alias("__k"), F.col(span).alias("__s"), F.lit(True).alias("__known")).distinct()
        parsed = parsed.join(known, (F.col(key) == F.col("__k")) & (F.col(f"item.{span}") == F.col("__s")), "left").drop("__k", "__s")
    else:
        parsed = parsed.withColumn("__known", F.lit(True))
    broken = [F.when(F.col("item").isNull(), "SHAPE"), F.when(F.col("item").isNotNull() & F.col("__known").isNull(), "PROVENANCE")]
    broken += [F.when(F.col("item").isNotNull() & ~F.coalesce(ok, F.lit(False)), name) for name, ok in rules(lambda c: F.col(f"item.{c}")).items()]
    marked = parsed.withColumn("reasons", F.array_join(F.array_compact(F.array(*broken)), ",")).drop("__known")
    return marked.where("reasons = ''").drop("reasons"), marked.where("reasons <> ''")


def attempts(rows: DataFrame, key: str, request: str, backends: list[Backend], valid: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Result (key, attempt, answer; null where all fail) and all attempts (key, attempt, answer, valid), which are kept: later backends see only what failed before."""
    from factloom.sources.work import written

    todo, log = rows.select(key, request), None
    for number, ask in enumerate(backends, 1):
        call = F.pandas_udf(ask, "string")
        own = todo.withColumn("answer", call(F.col(request))).withColumn("valid", F.coalesce(valid(F.col("answer")), F.lit(False)))
        own = written(own.select(key, request, F.lit(number).alias("attempt"), "answer", "valid"), "attempts")
        log = own if log is None else log.unionByName(own)
        todo = own.where(~F.col("valid")).select(key, request)
    best = log.where("valid").groupBy(key).agg(F.min_by(F.struct("attempt", "answer"), "attempt").alias("b"))
    return rows.select(key).join(best, key, "left").select(key, "b.attempt", "b.answer"), log.drop(request)


def batched(rows: DataFrame, group: str, key: str, request: str, size: int, summarize: Callable[[list[tuple]], dict]) -> DataFrame:
    """key, summary, complete: requests of a group are sent `size` at a time; a batch counts only if the answer has every key that was sent and no other.

    Rows are numbered inside their group (ranks.row_numbers), so that a batch is a group of its own of at most `size` rows.
    """
    from factloom.operators import ranks

    kind = dict(rows.dtypes)[key]

    def run(tables):
        for table in tables:
            keys, summaries, whole = [], [], []
            for batch in table.column(0).to_pylist():
                sent = sorted((r["k"], r["r"]) for r in batch)
                got = summarize(sent)
                complete = set(got) == {k for k, _ in sent}
                keys += [k for k, _ in sent]
                summaries += [got.get(k) if complete else None for k, _ in sent]
                whole += [complete] * len(sent)
            form = table.column(0).type.value_type.field("k").type
            yield pa.RecordBatch.from_arrays([pa.array(keys, form), pa.array(summaries, pa.string()), pa.array(whole, pa.bool_())], names=[key, "summary", "complete"])

    numbered = ranks.row_numbers(rows.select(group, key, request), [group], [F.col(key)], "__n").withColumn("__batch", F.floor((F.col("__n") - 1) / size))
    # a batch is a row, so that many of them go to a call of the worker
    batches = numbered.groupBy(group, "__batch").agg(F.collect_list(F.struct(F.col(key).alias("k"), F.col(request).alias("r"))).alias("__sent"))
    return batches.select("__sent").mapInArrow(run, f"`{key}` {kind}, summary string, complete boolean")
