"""Operators on small tables: unknowns, ties, ambiguity, empty inputs."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from factloom.functions import text_udfs
from factloom.operators import clusters, identity, memo, reconcile, scores, statistics, temporal, text
from factloom.sources import tables
from factloom.streaming import events as stream


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def one(df):
    return df.collect()[0]


def test_consensus_and_three_values(spark):
    df = frame(spark, [("a", "x"), ("a", None), ("b", "x"), ("b", "y"), ("c", None), ("d", "n"), ("d", "n")], "k string, v string")
    got = {r["k"]: r for r in df.groupBy("k").agg(statistics.consensus("v").alias("c"), statistics.assessed_any("v", "x", "n").alias("t"), statistics.known_any(F.col("v") == "x").alias("u")).collect()}
    assert [got[k]["c"] for k in "abcd"] == ["x", None, None, "n"]
    assert [got[k]["t"] for k in "abcd"] == [True, True, None, False]
    assert [got[k]["u"] for k in "abcd"] == [True, True, None, None]


def test_fisher_equals_hypergeometric_sum(spark):
    cases = [(3, 1, 1, 3), (8, 2, 1, 5), (0, 5, 5, 0), (10, 10, 10, 10), (0, 0, 3, 4)]
    rows = frame(spark, [(i, *c) for i, c in enumerate(cases)], "i int, a long, b long, c long, d long")
    got = {r["i"]: r["p"] for r in rows.select("i", statistics.fisher_exact(*[F.col(x) for x in "abcd"]).alias("p")).collect()}
    for i, (a, b, c, d) in enumerate(cases):
        if not (a + b and c + d and a + c and b + d):
            assert got[i] is None
            continue
        prob = lambda x: math.comb(a + b, x) * math.comb(c + d, a + c - x) / math.comb(a + b + c + d, a + c)  # noqa: B023, E731
        want = sum(prob(x) for x in range(max(0, a - d), min(a + b, a + c) + 1) if prob(x) <= prob(a) * (1 + 1e-7))
        assert got[i] == pytest.approx(want)


def test_mann_whitney_with_ties(spark):
    rows = [("s", float(v), f) for v, f in [(1, True), (2, True), (2, False), (3, False), (4, False)]] + [("s", None, True)]
    r = one(statistics.mann_whitney(frame(spark, rows, "g string, v double, f boolean"), ["g"], "v", "f"))
    assert (r["n1"], r["n0"], r["u"]) == (2, 3, 0.5)


def test_as_of_keeps_conflicts_unknown(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    index = frame(spark, [(1, "p", day(20)), (2, "q", day(20)), (3, "r", day(20))], "id int, k string, at timestamp")
    facts = frame(spark, [("p", day(19), 5.0), ("p", day(18), 6.0), ("q", day(19, 1), 1.0), ("q", day(19, 2), 2.0), ("r", day(1), 9.0), ("p", day(21), 7.0)], "k string, t timestamp, v double")
    got = {r["id"]: r["value"] for r in temporal.as_of(index, facts, ["k"], "id", "at", "t", "v", 7).collect()}
    assert got == {1: 5.0, 2: None, 3: None}


def test_dates(spark):
    rows = frame(spark, [("2024-02-30",), ("29.2.2024",), ("45000",), ("20240105",), ("1.13.2020",), (None,), ("3000-01-01",)], "s string")
    got = [r[0] for r in rows.select(temporal.any_date(F.col("s"))).collect()]
    assert got == [None, dt.date(2024, 2, 29), dt.date(2023, 3, 15), dt.date(2024, 1, 5), None, None, None]
    parts = [tuple(r[0]) for r in frame(spark, [("seen 3.4.2010 or 2011",), ("in 05/2012",), ("since 1999",), ("never",)], "s string").select(temporal.partial_date(F.col("s"))).collect()]
    assert parts == [(2010, 4, 3, "day"), (2012, 5, None, "month"), (1999, None, None, "year"), (None, None, None, "unknown")]


def test_ages(spark):
    rows = frame(spark, [(dt.date(2000, 2, 29), dt.date(2021, 2, 28)), (dt.date(2000, 1, 1), dt.date(1999, 1, 1))], "b date, d date")
    got = rows.select(temporal.age_years(F.col("b"), F.col("d")).alias("y"), temporal.age_exact(F.col("b"), F.col("d")).alias("x")).collect()
    assert got[0]["y"] == 20 and got[1]["y"] is None and got[1]["x"] is None


def test_names_and_grades(spark):
    left = frame(spark, [(1, "d", "Müller, Anna"), (2, "d", "Meier Jo Anna"), (3, "d", "Nobody"), (4, "e", "Smith")], "l int, b string, n string")
    right = frame(spark, [(10, "d", "MUELLER ANNA"), (11, "d", "Meier Jo"), (12, "e", "Smith"), (13, "e", "SMITH")], "r int, b string, m string")
    got = {r["l"]: (r["grade"], r["r"], r["status"]) for r in identity.graded_match(left, right, ["b"], "l", "r", "n", "m").collect()}
    assert got == {1: ("orthography", 10, "MATCH"), 2: ("prefix", 11, "MATCH"), 3: (None, None, "NO_MATCH"), 4: ("exact", None, "AMBIGUOUS")}


def test_shared_candidates_become_reviews(spark):
    df = frame(spark, [(1, 7, "MATCH"), (2, 7, "MATCH"), (3, 8, "MATCH"), (4, None, "NO_MATCH")], "i int, c int, s string")
    assert {r["i"]: r["s"] for r in identity.demote_shared(df, "c", "s").collect()} == {1: "REVIEW_SHARED", 2: "REVIEW_SHARED", 3: "MATCH", 4: "NO_MATCH"}


def test_components_of_chains(spark):
    edges = frame(spark, [(i, i + 1) for i in range(1, 40)] + [(100, 101), (None, 5), (7, 7)], "a int, b int")
    got = {r["id"]: r["component"] for r in identity.components(edges, "a", "b").collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[101] == 100
    assert identity.components(edges.where("false"), "a", "b").count() == 0


def test_closure_with_cycle(spark):
    e = frame(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "s string, t string")
    got = {(r[0], r[1]) for r in reconcile.closure(e, "s", "t").collect()}
    assert got == {(x, y) for x in "abc" for y in "abc"} | {("x", "y")}
    changed = frame(spark, [("x",)], "m string")
    assert [r[0] for r in reconcile.stale(frame(spark, [("y", "x"), ("z", "y"), ("q", "r")], "m string, d string"), changed, "m", "d").orderBy("m").collect()] == ["y", "z"]


def test_promote_moves_only_the_expected_pointer(spark):
    entries = frame(spark, [("m", 2, True), ("n", 2, False), ("o", 3, True)], "module string, version int, valid boolean")
    active = frame(spark, [("m", 1), ("n", 1), ("o", 2)], "module string, version int")
    requests = frame(spark, [("m", 2, 1), ("n", 2, 1), ("o", 3, 1)], "module string, version int, expected_version int")
    assert {r["module"]: r["version"] for r in reconcile.promote(entries, requests, active, "module", "version").collect()} == {"m": 2, "n": 1, "o": 2}


def test_sections_are_lossless(spark):
    texts = {1: "intro\nA.\nbody ü\nmore\nB.\nend", 2: "", 3: "A.", 4: "\n\nA.\n"}
    docs = frame(spark, list(texts.items()), "id int, t string")
    rows = text.sections(docs, "id", "t", F.col("line").rlike(r"^[A-Z]\.$")).orderBy("id", "section_no").collect()
    for i, t in texts.items():
        assert "".join(t[r["start"] : r["end"]] for r in rows if r["id"] == i) == t
    assert [r["heading"] for r in rows if r["id"] == 1] == [None, "A.", "B."]


def test_assertions_and_rules(spark):
    df = frame(spark, [("no stroke seen",), ("Possible stroke",), ("stroke of luck",), ("nothing",), ("if stroke then",)], "c string")
    assert [r[0] for r in df.select(text.assertion(F.col("c"), r"\bstroke\b")).collect()] == ["NEGATED", "UNCERTAIN", "ESTABLISHED", None, "CONDITIONAL"]
    rules = [("a", "EXACT", "history"), ("b", "PREFIX", "history of"), ("c", "REGEX", "^hist")]
    heads = frame(spark, [("History",), ("History of falls",), ("histogram",), ("It was. then more",)], "c string")
    assert [r[0] for r in heads.select(text.heading_label(F.col("c"), rules)).collect()] == ["a", "b", "c", None]


def test_quotes(spark):
    df = frame(spark, [("the  cat", "see the cat here"), ("x", "x y x"), ("z", "abc"), ("beta gamma", "alpha   beta  gamma")], "q string, t string")
    got = [r[0] for r in df.select(text.locate_quote(F.col("q"), F.col("t"))).collect()]
    assert (got[0]["start"], got[0]["end"]) == (4, 11) and got[1] is None and got[2] is None and (got[3]["start"], got[3]["end"]) == (8, 19)


def test_scores_and_decisions(spark):
    df = frame(spark, [(True, None), (False, False), (None, True)], "a boolean, b boolean")
    got = [(r["score_min"], r["score_max"], r["score"]) for r in df.select(*scores.score_with_bounds({"a": (F.col("a"), 2), "b": (F.col("b"), 1)})).collect()]
    assert got == [(2, 3, None), (0, 0, 0), (1, 3, None)]
    assert [r[0] for r in df.select(scores.decide([("x", F.col("a")), ("y", F.col("b"))], "z")).collect()] == ["x", "z", None]
    assert [r[0] for r in df.select(scores.bounded_class(F.lit(1), F.lit(2), [("low", 1), ("high", 9)])).collect()] == [None] * 3


def test_greedy_cover_prefers_rare_features(spark):
    rows = frame(spark, [(1, "a"), (1, "b"), (2, "a"), (3, "c"), (3, "b"), (4, "a")], "i int, f string")
    assert [r["i"] for r in scores.greedy_cover(rows, "i", "f", 5).orderBy("rank").collect()] == [3, 1]


def test_clusters(spark):
    m = frame(spark, [("p", 1, 2010, 5, 3), ("p", 2, 2010, 5, None), ("p", 3, 2011, None, None), ("p", 4, None, None, None)], "p string, m int, y int, mo int, d int")
    assert {r["m"]: r["cluster"] for r in clusters.date_clusters(m, ["p"], "m", "y", "mo", "d").collect()} == {1: 1, 2: 1, 3: 2, 4: None}
    t = frame(spark, [("a", 1, 10.0), ("a", 2, 10.4), ("a", 3, 12.0)], "p string, t int, y double")
    assert {r["t"]: r["row_no"] for r in clusters.visual_rows(t, ["p"], "t", "y", 0.5).collect()} == {1: 1, 2: 1, 3: 2}
    s = frame(spark, [("a", 0, 5), ("a", 3, 9), ("a", 5, 6)], "p string, a int, b int")
    assert sorted((r["a"], r["b"]) for r in clusters.without_overlaps(s, ["p"], "a", "b").collect()) == [(0, 5), (5, 6)]


def test_memo_asks_each_request_once_and_flags_the_invalid(spark):
    rows = frame(spark, [(1, "q1"), (2, "q1"), (3, "bad")], "i int, q string")
    cache = frame(spark, [], "key string, answer string, valid boolean")

    def answer(s):
        return s.map(lambda x: "no" if x.startswith("bad") else x.upper())

    out, new = memo.answered(rows, "q", "d", cache, answer, lambda a: a != "no")
    assert {r["i"]: (r["answer"], r["valid"]) for r in out.collect()} == {1: ("Q1", True), 2: ("Q1", True), 3: ("no", False)}
    assert new.count() == 2
    again, more = memo.answered(rows.where("i < 3"), "q", "d", new, answer, lambda a: a != "no")
    assert more.count() == 0 and again.count() == 2


def test_udfs(spark):
    df = frame(spark, [("ﬁn Straße é",), (None,)], "s string")
    r = df.select(text_udfs.normal_form(F.col("s")).alias("n"), text_udfs.without_marks(F.col("s")).alias("m"), text_udfs.casefolded(F.col("s")).alias("c"), text_udfs.pseudonym(F.col("s"), "k", "d").alias("p")).collect()
    assert r[0]["n"].startswith("fin") and r[0]["m"].endswith("E") and "strasse" in r[0]["c"] and len(r[0]["p"]) == 16
    assert r[1]["p"] is None


def test_csv_contracts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n1; x \n2;y\n")
    assert [r["name"] for r in tables.read_csv(spark, f"file://{tmp_path}/a.csv", ["id"], key=["id"]).orderBy("id").collect()] == ["x", "y"]
    with pytest.raises(tables.ContractError):
        tables.read_csv(spark, f"file://{tmp_path}/a.csv", ["other"])
    (tmp_path / "b.csv").write_text("id,v\n1,x\n1,y\n")
    with pytest.raises(tables.ContractError):
        tables.read_csv(spark, f"file://{tmp_path}/b.csv", key=["id"])


def test_write_once_and_folders(spark, tmp_path):
    df = frame(spark, [(1, "x"), (1, "x")], "a int, b string")
    tables.write_once(df, f"file://{tmp_path}/t")
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_once(df, f"file://{tmp_path}/t")
    assert not tables.same_rows(df, df.distinct())
    for name, body in (("p1/a.txt", "1"), ("p1/b.txt", "1"), ("p2/c.txt", "2"), ("d.txt", "3")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(body)
    files = tables.scan_folder(spark, f"file://{tmp_path}/in", "*.txt")
    assert {r["folder"]: (r["n_files"], r["n_distinct"], r["status"]) for r in tables.folder_totals(files).collect()} == {"p1": (2, 1, "OK"), "p2": (1, 1, "OK"), "": (1, 1, "ERROR")}
    manifest = tables.freeze(files).where("path not like '%c.txt'")
    assert [r["change"] for r in tables.changed_since(manifest, files).collect()] == ["ADDED"]


def test_streaming_sessions_equal_islands(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [("u", base + dt.timedelta(seconds=s)) for s in (0, 100, 390, 2000, 2100)] + [("u", base + dt.timedelta(days=1))]
    frame(spark, rows, "k string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")  # one file: several would come in any order, and some too late
    out = stream.sessions(stream.event_stream(spark, f"{tmp_path}/in", "k string, ts timestamp"), "k", "ts")
    q = out.writeStream.format("memory").queryName("s").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["n"] for r in spark.sql("select n from s").collect()) == [2, 3]


def test_typed_cells_json_and_union(spark, tmp_path):
    df = frame(spark, [("True", '{"a": 1}'), ("x", "[1"), (None, '{"a": NaN}')], "b string, j string")
    r = tables.typed_cells(df, ["b", "j"]).select("b_bool", F.col("j_json").isNull().alias("none")).collect()
    assert [x["b_bool"] for x in r] == [True, None, None] and [x["none"] for x in r][:2] == [False, True]
    assert [x[0] for x in df.select(tables.strict_json(F.col("j"), "a double")["a"]).collect()] == [1.0, None, None]
    tables.write_csv([frame(spark, [(1, [1, 2])], "i int, a array<int>"), frame(spark, [(2, "z")], "i int, c string")], f"file://{tmp_path}/u")
    back = spark.read.option("header", True).csv(f"file://{tmp_path}/u")
    assert sorted(back.columns) == ["a", "c", "i"] and back.count() == 2


def test_reuse_parses_each_content_once(spark):
    files = frame(spark, [("p1", "h1"), ("p2", "h1"), ("p3", "h2")], "path string, sha256 string")
    cache = frame(spark, [("h2", "v1", "old"), ("h1", "v0", "other")], "sha256 string, parser string, parsed string")
    got = tables.reuse_or_parse(files, cache, lambda f: f.withColumn("parsed", F.concat(F.lit("new "), "path")), "v1")
    assert {r["path"]: r["parsed"] for r in got.collect()}["p3"] == "old"
    assert len({r["parsed"] for r in got.where("sha256 = 'h1'").collect()}) == 1


def test_similarity(spark):
    df = frame(spark, [("abcd", "bc"), ("abcd", "abxd"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(text_udfs.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[1] == pytest.approx(0.75) and got[2] is None


def test_noise_is_kept_apart(spark):
    docs = frame(spark, [(i, f"same\nown {i}\nsame") for i in range(3)], "i int, t string")
    kept, gone = text.without_noise(docs, "i", "t", text.noise_lines(docs, "i", "t", 3))
    assert kept.count() == 3 and gone.count() == 6


def test_replay(spark):
    items = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "a", "y"), (3, "a", "z")], "art long, key string, value string")
    log = [(1, 1, "EDIT", "a", None, "x2"), (1, 2, "SPLIT", "a", "c", None), (1, 3, "MERGE", "b", "a", None), (1, 4, "ACCEPT", "c", None, None), (1, 5, "ACCEPT", "b", None, None), (2, 1, "MERGE", "a", "gone", None), (2, 2, "REJECT", "a", None, None), (9, 1, "ACCEPT", "a", None, None)]
    events = spark.createDataFrame(log, "art long, at int, action string, key string, new_key string, value string")
    got = {tuple(r) for r in clusters.replay(items, events, "art").collect()}
    assert got == {(1, "a", "x2", "EDITED"), (1, "c", "x2", "ACCEPTED"), (2, "a", "y", "REJECTED"), (3, "a", "z", "OPEN")}
    assert clusters.replay(items.where("false"), events, "art").count() == 0


def test_new_text_operators(spark):
    rows = spark.createDataFrame([("Acid plus", 5.0), ("acidic", None), (None, 30.0)], "s string, x double")
    aliases = [("acid", "A"), ("acid plus", "AP")]
    got = rows.select(text.longest_alias(F.col("s"), aliases).alias("c"), text.nearest(F.col("x"), [("l", 0.0), ("r", 10.0)], 1.0).alias("n"), text.dosage(F.col("s")).alias("d")).collect()
    assert [r["c"] for r in got] == ["AP", None, None]
    assert [r["n"] and tuple(r["n"]) for r in got] == [("l", True), None, ("r", False)]
    assert got[0]["d"]["strength"] is None and got[0]["d"]["as_needed"] is False


def test_components_of_a_long_chain(spark):
    chain = [0, *range(170, 100, -1)]
    edges = frame(spark, list(zip(chain[:-1], chain[1:], strict=True)), "a long, b long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert {(r["id"], r["component"]) for r in identity.components(edges, "a", "b").collect()} == {(i, 0) for i in chain}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
