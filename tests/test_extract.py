"""Extraction operators on small tables: unknowns, repeats, ambiguity, empty inputs."""

import datetime as dt

from pyspark.sql import functions as F

from factloom.operators import extract


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_numbered_items_cover_their_text(spark):
    body = "before\n1. a ü\nmore\n2) b\n10. c"
    docs = frame(spark, [(1, body), (2, ""), (3, None), (4, "1.5 mg")], "id int, t string")
    rows = extract.numbered_items(docs, "id", "t").orderBy("id", "start").collect()
    assert [(r["id"], r["item_no"], body[r["start"] : r["end"]]) for r in rows] == [(1, 1, "1. a ü\nmore\n"), (1, 2, "2) b\n"), (1, 10, "10. c")]


def test_compound_needs_every_part(spark):
    df = frame(spark, [("B + a",), ("a/x",), ("a/A",), (None,), ("",)], "n string")
    assert [r[0] for r in df.select(extract.compound_generic(F.col("n"), {"a": "one", "b": "two"})).collect()] == ["one + two", None, "one", None, None]


def test_reference_flags_need_what_decides(spark):
    df = frame(spark, [(1.0, 2.0, None), (3.0, 2.0, None), (3.0, None, 2.0), (2.0, 2.0, 2.0), (None, 1.0, 2.0)], "v double, l double, h double")
    assert [r[0] for r in df.select(extract.reference_flag(F.col("v"), F.col("l"), F.col("h"))).collect()] == ["LOW", None, "HIGH", "NORMAL", None]


def test_header_above_keeps_ties_unknown(spark):
    cells = frame(spark, [(1, "k", 10), (2, "k", 30), (3, "q", 10), (4, None, 10), (5, "k", 5)], "c int, k string, y int")
    heads = frame(spark, [("k", "a", 5), ("k", "b", 1), ("k", "c", 25), ("k", "d", 25), ("q", "e", 1)], "k string, h string, hy int")
    got = {r["c"]: r["above"] for r in extract.header_above(cells, heads, ["k"], "c", "y", "h", "hy", 6).collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None, 5: "b"}
    assert extract.header_above(cells.where("false"), heads, ["k"], "c", "y", "h", "hy", 6).count() == 0


def test_owned_dates(spark):
    said = ["stroke on 3.4.2010; fall on 5.6.2011", "stroke 3.4.2010 and 5.6.2011", "stroke planned 3.4.2010", "no stroke", None, "", "stroke 31.2.2010", "stroke 3.4.2010; stroke 03.04.2010"]
    rows = frame(spark, list(enumerate(said)), "i int, t string").select("i", extract.owned_date(F.col("t"), "stroke", "planned").alias("o")).orderBy("i").collect()
    day = dt.date(2010, 4, 3)
    assert [r["o"]["date"] for r in rows] == [day, None, None, None, None, None, None, day]
    assert [r["o"]["basis"] for r in rows][:4] == ["OWNED", "SEVERAL", "BLOCKED", "NONE"]


def test_units_and_scores(spark):
    df = frame(spark, [("Hb 13,5 g/dL",), ("Hb 135 g/L",), ("Hb <5 g/L",), ("Hb 5 cups",), (None,)], "t string")
    got = [tuple(r[0]) for r in df.select(extract.unit_value(F.col("t"), "Hb", {"g/dL": 1.0, "g/L": 0.1})).collect()]
    assert got == [(13.5, "VALID"), (13.5, "VALID"), (None, "COMPARATOR"), (None, "UNIT"), (None, "NONE")]
    docs = frame(spark, [(1, "T 28/30, T 31, T 20-25, T 9 %, T 5/10, T soon"), (2, None)], "i int, t string")
    rows = extract.adjacent_scores(docs, "i", "t", "T", 30).orderBy("place").collect()
    assert [(r["score"], r["reason"]) for r in rows] == [(28, "ACCEPTED"), (None, "OUTSIDE"), (None, "RANGE"), (None, "PERCENT"), (None, "OTHER_SCALE"), (None, "NO_NUMBER")]


def test_owners_conservation_and_flags(spark):
    rows = frame(spark, [(1,), (2,), (3,)], "i int")
    links = frame(spark, [(1, "a"), (1, "a"), (1, None), (2, "a"), (2, "b")], "i int, o string")
    assert {r["i"]: (r["o"], r["state"]) for r in extract.unique_owner(rows, links, "i", "o").collect()} == {1: ("a", "OWNED"), 2: (None, "REFERENCE_ONLY"), 3: (None, "UNLINKED")}
    parts = frame(spark, [(1,), (2,), (2,), (9,)], "i int")
    assert {(r["i"], r["state"]) for r in extract.conserved(rows, parts, "i").collect()} == {(2, "REPEATED"), (3, "LOST"), (9, "INVENTED")}
    assert extract.conserved(rows, rows, "i").count() == 0
    found, stored = frame(spark, [(1, "x"), (2, "x"), (3, None)], "i int, s string"), frame(spark, [(1, "y"), (2, "x"), (3, "y")], "i int, s string")
    none = frame(spark, [], "i int, flag string")
    assert [tuple(r) for r in extract.new_flags(found, stored, "i", "s", none).collect()] == [(1, "x!=y")]
    assert extract.new_flags(found, stored, "i", "s", frame(spark, [(1, "x!=y")], "i int, flag string")).count() == 0


def test_ranks_rules_and_taxonomy(spark):
    df = frame(spark, [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "y"), ("c", 1, None), ("c", 2, "z")], "k string, r int, v string")
    got = {r["k"]: (r["value"], r["r"], r["state"]) for r in extract.ranked_value(df, ["k"], "r", "v").collect()}
    assert got == {"a": ("x", 1, "AGREED"), "b": (None, 1, "CONFLICT"), "c": ("z", 2, "AGREED")}
    tree = extract.with_taxonomy(frame(spark, [("p",), ("q",), (None,)], "l string"), "l", {"p": ["top", "low"]}).collect()
    assert {(r["l"], r["level"], r["node"]) for r in tree} == {("p", 0, "top"), ("p", 1, "low"), ("q", None, None), (None, None, None)}
    rules = [("OUT", "big", F.col("r") > 1), ("IN", "x", F.col("v") == "x")]
    assert {tuple(r[0]) for r in df.where("k = 'c'").select(extract.decide_with_reason(rules, ("?", "none"))).collect()} == {("?", "none"), ("OUT", "big")}


def test_nested_patterns_queues_and_sources(spark):
    df = frame(spark, [("a", 2, "y"), ("a", 1, "x"), ("a", 1, None), ("b", 1, "x")], "k string, n int, v string")
    again = extract.unnested(extract.nested(df, "k", ["n"], ["n", "v"], "rows"), "k", "rows")
    assert [(r["k"], r["place"], r["n"], r["v"]) for r in again.orderBy("k", "place").collect()] == [("a", 0, 1, None), ("a", 1, 1, "x"), ("a", 2, 2, "y"), ("b", 0, 1, "x")]
    assert extract.unnested(extract.nested(df.where("false"), "k", ["n"], ["v"], "rows"), "k", "rows").count() == 0
    sets = frame(spark, [(["x", "y"],), (["y"],), ([],), (None,)], "s array<string>")
    assert [r[0] for r in sets.select(extract.pattern_of(F.col("s"), [("both", ["x", "y"]), ("one", ["y"])], "none")).collect()] == ["both", "one", "none", "none"]
    got = {r["k"]: tuple(r)[1:] for r in extract.queues(df, ["k"], F.col("v") == "x", F.col("v") == "y").collect()}
    assert got == {"a": (3, 1, 1, 1), "b": (1, 1, 0, 0)}
    assert {tuple(r) for r in extract.representative(df, ["k"], "v", "n").collect()} == {("a", "y", 2, 2), ("b", "x", 1, 1)}
