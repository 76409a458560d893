"""What the findings of the third round named: each test fails on the code before."""

import itertools
import random
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from factloom.operators import rules
from factloom.plans import catalogue, depth, governance, linking, more, reports, tables  # noqa: F401
from test_catalogue import rows_of


def against_sql(spark, folder, name, **frames):
    """Rows of a query and of its SQL over small tables."""
    con = duckdb.connect()
    for table, df in frames.items():
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    want = con.execute(catalogue.SQL[name])
    return rows_of(df.columns, df.collect()), rows_of([d[0] for d in want.description], want.fetchall())


@pytest.mark.parametrize("name", ["unmeasured_tables", "section_targets"])
def test_lines_end_at_any_space_separator(spark, tmp_path, name):
    texts = ["A line. ", "　The line of it. \nAnd.  ", " \n \nthe and", "A line.\t", "A.\r\nB.", "​A.​", " ", "", None, "a ."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = against_sql(spark, tmp_path, name, documents=docs)
    assert got == want


def test_screen_and_classes_cover_orders_and_whole_vocabularies(spark):
    names = ["Clexane 40", "Heparin", "Sintrom", "xarelto 20", "Aspirin", "Brilique", "Concor", "Sortis", "Lyrica", "Memantin", "Sertralin", "Massage", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    table = [(label, {"name": rf"(?i)\b(?:{p})\b"}, {}) for label, p in tables.MEDICINES]
    got = df.select("i", rules.decide({"name": F.col("n")}, table, ("OTHER", None, None), ["category", "subclass", "agent"]).alias("m")).orderBy("i").collect()
    assert [x.m.agent for x in got][:6] == ["LMWH", "UFH", "VKA", "DOAC", "ASPIRIN", "P2Y12_INHIBITOR"]
    assert [x.m.category for x in got][6:] == ["ANTIHYPERTENSIVE", "LIPID_LOWERING", "ANTISEIZURE", "ANTIDEMENTIA", "ANTIDEPRESSANT", "OTHER", "OTHER"]
    data = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{data}/orders.parquet").count()
    classes, screen = catalogue.QUERIES["medicine_classes"](spark, data), catalogue.QUERIES["recording_screen"](spark, data)
    assert classes.count() == screen.count() == n
    assert classes.columns == ["o_orderkey", "category", "subclass", "agent", "role"] and screen.columns == ["o_orderkey", "class", "needs_semantics", "epileptiform", "artifact", "stroke_context", "many"]


def test_a_pair_is_made_in_one_of_the_blocks_that_it_shares(spark):
    import numpy as np

    from factloom.llm import jaccard

    # forty different texts of the same counts in twelve blocks: all pairs, each once
    point = jaccard.packed(np.ones(jaccard.GROUPS, np.int64))
    rows = spark.createDataFrame([(k * 7 - 30, i, 128, i, point) for k in range(12) for i in range(40)], "key long, id long, n long, grp long, point binary")
    want = {(i, j) for i in range(40) for j in range(i + 1, 40)}
    assert {tuple(r) for r in jaccard.leaf_pairs(rows).collect()} == want
    x, y = np.sort(np.array([[5, 2, 9], [1, 2, 3], [4, 5, 6]]), 1), np.sort(np.array([[9, 5, 7], [4, 5, 6], [4, 6, 8]]), 1)
    assert [jaccard.met_here(k, x, y).tolist() for k in (4, 5, 9)] == [[False, True, True], [True, True, False], [False, True, False]]


def test_many_small_groups_are_no_calls_of_their_own(spark):
    """Plans without a Python call for each group, and results on groups that batches of rows cut."""
    import io
    from contextlib import redirect_stdout

    data = "/root/testdata/sf0.001"
    for name in ("review_replay", "batched_summaries", "partial_date_clusters", "spans_without_overlaps"):
        text = io.StringIO()
        with redirect_stdout(text):
            catalogue.QUERIES[name](spark, data).explain()
        assert "GroupsInPandas" not in text.getvalue(), name
    from factloom.operators import clusters

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        spans = spark.createDataFrame([("a", i, i + 3) for i in range(20)] + [(None, i, i + 5) for i in range(11)] + [("b", None, 4), ("b", 1, 2)], "k string, a long, z long")
        got = clusters.without_overlaps(spans, ["k"], "a", "z").collect()
        assert sorted((str(r.k), r.a) for r in got if r.a is not None) == [("None", 0), ("None", 5), ("None", 10), *[("a", i) for i in range(0, 20, 3)], ("b", 1)]
        items = spark.createDataFrame([(None, "x", "1"), (1, "x", "2"), (1, "y", None)], "who long, key string, value string")
        log = spark.createDataFrame([(1, i, "EDIT", "x", None, str(i)) for i in range(12)] + [(1, 12, "MERGE", "y", "x", None), (2, 1, "ACCEPT", "x", None, None), (None, 1, "SPLIT", "x", "z", None)], "who long, at long, action string, key string, new_key string, value string")
        assert {tuple(r) for r in clusters.replay(items, log, "who").collect()} == {(None, "x", "1", "OPEN"), (None, "z", "1", "OPEN"), (1, "x", "11", "EDITED")}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_pairs_are_gathered_only_for_ids_of_several_forms(spark):
    import io
    from contextlib import redirect_stdout

    from factloom.operators import identity

    left = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, None), (3, None, 5), (None, 1, 5)], "l long, a long, b long")
    right = spark.createDataFrame([(7, 1, 5), (7, 2, 6), (8, 1, 5), (8, 1, 5), (9, None, 6)], "r long, a long, b long")
    got = [tuple(r) for r in identity.match_any(left, right, "l", "r", [["a"], ["b"]]).collect()]
    want = {(x.l, y.r) for x in left.collect() for y in right.collect() if (x.a is not None and x.a == y.a) or (x.b is not None and x.b == y.b)}
    assert len(got) == len(set(got)) and set(got) == want
    text = io.StringIO()
    with redirect_stdout(text):
        catalogue.QUERIES["match_any_key"](spark, "/root/testdata/sf0.001").explain()
    assert "Aggregate" not in text.getvalue()


def test_events_of_a_document_are_neither_shuffled_nor_sorted(spark):
    import io
    from contextlib import redirect_stdout

    text = io.StringIO()
    with redirect_stdout(text):
        for name in ("stroke_events", "scale_assessments"):
            catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").explain()
    assert "Exchange" not in text.getvalue() and "Window" not in text.getvalue()


def test_intervals_touch_few_buckets(spark):
    from factloom.operators import temporal

    assert temporal._MOST <= 4  # copies of an interval, beside those of a point: one a level that intervals are on
    rows = spark.sql("SELECT id AS p, 'k' AS k, timestamp_seconds(id * 1000000) AS at FROM range(200)")
    spans = spark.sql("SELECT id AS i, 'k' AS k, timestamp_seconds(id * 1000000) AS a, timestamp_seconds(id * 1000000 + id * id * 30000) AS z FROM range(0, 200, 7)")
    got = {r.p: (r.n_intervals, r.i) for r in temporal.link_in_interval(rows, spans, ["k"], "p", "at", "i", "a", "z").collect()}
    for p in range(200):
        own = [i for i in range(0, 200, 7) if i * 1000000 <= p * 1000000 <= i * 1000000 + i * i * 30000]
        assert got[p] == (len(own), own[0] if len(own) == 1 else None)


def test_quotes_take_texts_in_small_batches(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    catalogue.QUERIES["quote_locations"](own, "/root/testdata/sf0.001")
    assert int(own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_review_state_is_read_and_written_once_a_micro_batch():
    from collections import Counter

    from pyspark.sql import Row

    from factloom.streaming import review

    calls = Counter()

    class State(dict):
        def getValue(self, k):
            calls["get"] += 1
            return self.get(k)

        def containsKey(self, k):
            calls["get"] += 1
            return k in self

        def updateValue(self, k, v):
            calls["put"] += 1
            self[k] = v

        def removeKey(self, k):
            del self[k]

    class Count:
        def get(self):
            return getattr(self, "n", None)

        def update(self, n):
            self.n = n

    p = review.Projection()
    p.items, p.count = State(), Count()
    event = lambda at, action, key, new=None, value=None: Row(artifact="a", at=at, action=action, key=key, new_key=new, value=value)
    first = [event(None, "ITEM", "x", value="1"), event(None, "ITEM", "y"), *[event(i, "EDIT", "x", value=str(i)) for i in range(20)]]
    assert len(list(p.handleInputRows(("a",), iter(first), None))) == 22
    assert calls == {"put": 2} and p.items == {("x",): ("19", "EDITED"), ("y",): (None, "OPEN")}
    second = [event(30, "SPLIT", "x", "z"), event(31, "MERGE", "y", "x"), event(32, "MERGE", "z", "x"), event(33, "ACCEPT", "x")]
    assert [r["state"] for r in p.handleInputRows(("a",), iter(second), None)] == ["OPEN", "GONE", "GONE", "ACCEPTED"]
    assert p.items == {("x",): ("19", "ACCEPTED")}


def shuffled_bytes(spark, action):
    """What an action writes to shuffles, by the status of its stages."""
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext.setJobGroup("measured", "measured")
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ids = [s for j in spark.sparkContext.statusTracker().getJobIdsForGroup("measured") for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return sum(store.lastStageAttempt(i).shuffleWriteBytes() for i in set(ids))


def test_alignment_shuffles_little_more_than_the_texts(spark):
    data = "/root/testdata/sf0.01"
    wrote = shuffled_bytes(spark, lambda: catalogue.QUERIES["version_alignment"](spark, data).write.format("noop").mode("overwrite").save())
    assert wrote < 2 * sum(len((r.text or "").encode()) for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect())


@pytest.mark.parametrize("most", [2048, 2])
def test_alignment_of_rows_and_of_looked_up_lines_is_one(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(depth, "_MOST_LINES", most)
    line = "alpha betaa gamma delta\n\nbetaa gamma omega\nalpha betaa gamma delta\nzeta zeta etaa\nab c\n"
    texts = [line, line + "Gamma DELTA alpha\n" + line, "", None, "one", "Größe über größe\nüber GRÖSSE\n", "\n\n\n", line * 3]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(-7, line)], "doc_id long, text string")
    got, want = against_sql(spark, tmp_path, "version_alignment", documents=docs)
    assert got == want and {"ALIGNED", "AMBIGUOUS", "REMOVED", "ADDED"} <= {v for r in got for v in r}


def test_alignment_of_an_id_of_several_rows(spark):
    texts = [(1, "alpha betaa"), (1, "alpha betaa"), (2, "gamma delta\nomega sigma"), (None, "alpha"), (None, "alpha")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    t = catalogue.Tables(spark, "")
    t.documents = docs
    got = {(x.doc_id, x.n_old, x.n_new, x.state) for x in depth.version_alignment(t).collect()}
    assert (1, 2, 2, "ALIGNED") in got and (None, 2, None, "REMOVED") in got


def test_few_pairs_of_names_reach_the_exact_ratio(spark, monkeypatch):
    from pyspark.sql.types import DoubleType

    from factloom.operators import copies

    # names of a few syllables share many pairs of letters, though few of them are close
    r = random.Random(8)
    name = lambda: " ".join("".join(r.choice(["ber", "ley", "ez", "son", "ström", "gu", "kor", "dal", "ham"]) for _ in range(3)) for _ in range(2))
    names = sorted({name() for _ in range(300)})
    df = spark.createDataFrame([("x", n) for n in names], "city string, name string")
    want = {(a, b) for a, b in itertools.combinations(names, 2) if SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85}
    assert {(x.a, x.b) for x in copies.near_copies(df, ["city"], "name").collect()} == want
    monkeypatch.setattr(copies, "ratio_from", lambda *a: lambda a, b: F.lit(1.0).cast(DoubleType()))
    assert copies.near_copies(df, ["city"], "name").count() < 100


def test_tables_in_database_files(spark, tmp_path, monkeypatch):
    from factloom.sources import external

    rows = [(i, None if i % 7 == 0 else f"n'\"{i}ß", i / 3, i % 2 == 0) for i in range(1000)] + [(None, "", None, None)]
    df = spark.createDataFrame(rows, 'k long, `a "b` string, x double, f boolean').repartition(3)
    external.write_sqlite(df, f"{tmp_path}/db", 'T"', rows=64)
    assert spark.read.parquet(f"{tmp_path}/db").count() >= 16
    assert sorted(external.read_sqlite(spark, f"{tmp_path}/db", 'T"', df.schema).collect(), key=str) == sorted(df.collect(), key=str)
    external.write_sqlite(df.where("false"), f"{tmp_path}/none", "T")
    assert external.read_sqlite(spark, f"{tmp_path}/none", "T", df.schema).collect() == []
    # on a cluster the database of one process is not that of another
    monkeypatch.setattr(governance, "_in_one_process", lambda s: False)
    monkeypatch.setattr(external, "write_jdbc", None)
    data = "/root/testdata/sf0.001"
    got = catalogue.QUERIES["jdbc_round_trip"](spark, data)
    assert sorted(got.collect()) == sorted(spark.read.parquet(f"{data}/nation.parquet").select("n_nationkey", "n_name").collect())


def test_only_one_process_counts_as_local():
    from types import SimpleNamespace as N

    of = lambda master: governance._in_one_process(N(sparkContext=N(master=master)))
    assert of("local") and of("local[4]") and of("local[*, 2]") and not of("local-cluster[3,2,3000]") and not of("spark://h:7077") and not of("yarn")


def test_state_stores_go_when_their_task_has_committed(spark):
    from factloom.llm import turns

    assert turns._session(spark).conf.get("spark.sql.streaming.stateStore.unloadOnCommit") == "true"


def test_turns_take_one_store_a_partition(spark):
    """Each store that was ever opened leaves memory behind, so a start has one stateful operator; it tells repeats of released and of waiting turns by itself."""
    import os

    from factloom.llm import common, turns

    folder = common.shared_folder(spark).removeprefix("file://") + f"/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    arrived = [(0, 1, 0, 0, "user", "a"), (0, 1, 2, 0, "user", "c"), (1, 1, 0, 0, "user", "late"), (1, 1, 2, 0, "user", "late"), (2, 1, 1, 0, "assistant", "b")]
    df = spark.createDataFrame(arrived, "batch int, conv_id long, turn long, first long, role string, text string")
    found = turns.reassemble(spark, df, batches=3).collect()
    (own,) = (x for x in set(os.listdir(folder)) - before if x.startswith("turns-"))
    assert [x for x in os.listdir(f"{folder}/{own}/checkpoint/state") if x.isdigit()] == ["0"]
    got = sorted((x.event, x.turn, x.batch, x.text, x.unreleased, x.n_missing, x.n_breaks) for x in found)
    assert got == [("close", -1, 3, None, "", 0, 0), ("release", 0, 0, "a", None, None, None), ("release", 1, 2, "b", None, None, None), ("release", 2, 2, "c", None, None, None)]
