import pytest
from pyspark.sql import functions as F

from factloom.operators import inference, ranks, temporal
from factloom.sources import external, work
from factloom.sources.tables import ContractError


def test_addresses_of_databases():
    assert external.jdbc_address({"DATABASE_URL": "postgresql+driver://me:secret@host:5433/data"}) == ("jdbc:postgresql://host:5433/data", {"user": "me", "password": "secret"})
    assert external.jdbc_address({"DATABASE_URL": "postgres://host/data"})[0] == "jdbc:postgresql://host/data"
    assert external.jdbc_address({"PGHOST": "h", "PGDATABASE": "d", "PGUSER": "u"}) == ("jdbc:postgresql://h:5432/d", {"user": "u"})
    with pytest.raises(ContractError):
        external.jdbc_address({})


def test_rule_files_are_checked():
    fields = {"label": str, "priority": int}
    assert external.rules_from_yaml("- {label: a, priority: 1}\n- {label: b, priority: 2}", fields, ["label"])[1]["label"] == "b"
    for bad in ("- {label: a, priority: 1}\n- {label: a, priority: 2}", "- {label: a}", "- a", "label: a"):
        with pytest.raises(ContractError):
            external.rules_from_yaml(bad, fields, ["label"])
    assert external.rules_from_yaml("", fields, ["label"]) == []


def test_workbooks_keep_cells_and_refuse_bad_headers(spark, tmp_path):
    rows = [["a", "b", "c"], ["<1>", None, " x & y "], ["", "2", None]]
    assert external.sheet_rows(external.workbook(rows)) == [["a", "b", "c"], ["<1>", "", " x & y "], ["", "2"]]
    bad = spark.createDataFrame([("bad.xlsx", external.workbook([["a", "a"]]))], "name string, content binary")
    external.write_files(bad, str(tmp_path), "name", "content")
    with pytest.raises(Exception, match="repeated header"):
        external.read_workbooks(spark, str(tmp_path)).collect()


def test_publishing_is_guarded(spark, tmp_path):
    root, rows = f"file://{tmp_path}/published", spark.range(5).toDF("i")
    assert external.publish(rows, root, "v1", expected=None)["rows"] == 5
    with pytest.raises(ContractError, match="not None"):
        external.publish(rows, root, "v2", expected=None)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        external.publish(rows, root, "v1", expected="v1")
    assert external.current(spark, root).count() == 5 and external.read_text(spark, f"{root}/lock") is None
    external._put(spark, f"{root}/lock", "other", False)
    with pytest.raises(ContractError, match="locked"):
        external.publish(rows, root, "v3", expected="v1")
    spark.range(4).toDF("i").write.mode("overwrite").parquet(f"{root}/v1/data")
    with pytest.raises(ContractError, match="manifest"):
        external.current(spark, root)


def test_backends_have_names():
    assert inference.backend("words") is inference.word_stub
    with pytest.raises(KeyError):
        inference.backend("none")


def test_quantiles_of_groups_of_all_sizes(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [("small", float(v)) for v in rng.integers(0, 50, 7)] + [("one", 3.0), ("none", None)] + [("large", float(v)) for v in rng.normal(0, 1, 30_000).round(3)] + [("ties", 1.0)] * 12_000 + [("ties", 2.0)] * 3_000 + [(None, 4.0)]
    shares = {"low": 0.0, "q": 0.25, "m": 0.5, "t": 0.9, "high": 1.0}
    got = {r["g"]: r for r in ranks.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares).collect()}
    assert set(got) == {"small", "one", "large", "ties", None}
    for g, r in got.items():
        values = np.array([v for k, v in rows if k == g and v is not None])
        for name, s in shares.items():
            assert abs(r[name] - np.quantile(values, s)) < 1e-4, (g, name)


def test_quantiles_ranks_and_islands_of_one_large_group(spark):
    df = spark.range(0, 2000, 1, 8).select(F.lit(None).cast("string").alias("g"), (F.col("id") * 7919 % 1000).cast("double").alias("v"), "id")
    got = ranks.quantiles(df, ["g"], "v", {"q": 0.25, "m": 0.5}).first()
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert [got["q"], got["m"]] == pytest.approx(want)
    numbered = ranks.row_numbers(df, ["g"], [F.col("v"), F.col("id")], "n").orderBy("v", "id").collect()
    assert [r["n"] for r in numbered] == list(range(1, 2001))
    times = [0, 10, 700_000, 700_100, 1_300_000, 1_300_200, 5_000_000]
    rows = spark.createDataFrame([("k", i, t) for i, t in enumerate(times)], "k string, i int, t long").select("k", "i", F.timestamp_seconds("t").alias("t"))
    runs = {r["island"]: r["n"] for r in temporal.islands(rows, ["k"], "t", 150, ["i"], bucket_seconds=60).collect()}
    assert runs == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1}
    chain = spark.range(400).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 50).alias("t"), F.col("id").alias("i"))
    assert [(r["island"], r["n"]) for r in temporal.islands(chain, ["k"], "t", 60, ["i"], bucket_seconds=120).collect()] == [(1, 400)]


def test_impossible_days_are_no_days(spark):
    got = spark.createDataFrame([("am 31.2.2020",), ("am 29.2.2020",), ("3/1999",), ("13/1999",), ("nie",)], "t string").select(temporal.partial_date(F.col("t")).alias("d")).select("d.precision").collect()
    assert [r["precision"] for r in got] == ["year", "day", "month", "year", "unknown"]


def test_work_tables_are_cleared(spark):
    work.written(spark.range(3), "x")
    work.clear_work(spark)
    assert not external._fs(spark, f"{work.shared_folder(spark)}/{spark.sparkContext.applicationId}")[0].exists(external._fs(spark, f"{work.shared_folder(spark)}/{spark.sparkContext.applicationId}")[1])
