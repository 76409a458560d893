"""The pipeline's stages against plain versions on a small corpus, and what is registered."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from factloom.llm import mixing, tokenids
from factloom.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone light garden window paper silver morning cloud forest yellow bridge winter table music letter ocean candle".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 400, n)))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = {}, []
    for i in range(300):
        rows[i] = prose(i, 80 + i % 50)
        labels.append((i, 1, 0))
    for i in range(300, 380):
        rows[i] = " ".join(w + "***" for w in prose(i, 80).split())
        labels.append((i, 0, 0))
    for i in range(400, 420):  # copies with one word changed
        words = rows[i - 400].split()
        words[40] = "otherword"
        rows[i] = " ".join(words)
    item = prose(7777, 34)
    rows[430] = prose(430, 60) + " " + item + " " + prose(431, 60)
    rows[431] = None
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows.items()], DOCS).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def test_stages_take_effect(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("component_id", F.lit("clash")).withColumn("__copies", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    good = written(stages["quality classifier"](spark, docs, path), "good")
    assert good.columns == docs.columns
    assert ids(good) - {431} == set(rows) - set(range(300, 380)) - {431}
    single = written(stages["n-gram Jaccard join"](spark, good, path), "single")
    assert ids(good) - ids(single) == set(range(400, 420)) and single.columns == docs.columns
    clean = written(stages["benchmark decontamination"](spark, single, path), "clean")
    assert ids(single) - ids(clean) == {430} and clean.columns == docs.columns
    mixed = written(stages["mixing sources to target weights"](spark, clean, path), "mixed")
    sizes = {r["doc_id"]: r["n"] for r in clean.select("doc_id", mixing.size_of().alias("n")).collect()}
    taken = {r["source"]: r["n"] for r in mixed.withColumn("n", mixing.size_of()).groupBy("source").agg(F.sum("n").alias("n")).collect()}
    per = {}
    for i, n in sizes.items():
        per[f"s{i % 3}"] = per.get(f"s{i % 3}", 0) + n
    assert all(abs(taken[s] - w) <= 130 for s, w in mixing.targets(per).items())
    out = sorted(stages["token-ID / binary output"](spark, mixed, path).collect(), key=lambda r: r["start"])
    t = tokenids.tokenizer(tokenids.default_path())
    want = [(r["doc_id"], t.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in sorted(mixed.collect(), key=lambda r: (r["doc_id"], r["text"] or ""))]
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out] == [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want]


def test_run_agrees_with_itself(spark, corpus):
    path, _ = corpus
    once, again = (sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) for _ in range(2))
    assert once == again and once


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} <= names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


def test_stages_without_rows_and_with_null_ids(spark, corpus, tmp_path):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("gone", F.lit("clash")).withColumn("Size", F.lit("clash"))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), path).count() == 0, name
    item = spark.read.parquet(f"{path}/benchmark.parquet").first()["text"]
    nulls = spark.createDataFrame([(None, prose(1, 60), "en", "s0", 1), (None, prose(1, 60), "en", None, 1), (None, None, None, "s1", 1), (8000, item, "en", "s0", 1)], DOCS).withColumn("gone", F.lit("clash")).withColumn("Size", F.lit("clash"))
    # what can't be told from others by its id is neither linked nor matched, and stays
    assert stages["n-gram Jaccard join"](spark, nulls, path).count() == 4
    assert sorted(str(r["doc_id"]) for r in stages["benchmark decontamination"](spark, nulls, path).collect()) == ["None"] * 3
    mixed = stages["mixing sources to target weights"](spark, nulls, path)
    assert mixed.columns == nulls.columns and mixed.where("gone <> 'clash' or Size <> 'clash'").count() == 0
    assert stages["token-ID / binary output"](spark, nulls, path).count() == 4
