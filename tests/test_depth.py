"""Alignment, offsets, anchored resolution, near copies, scans, dictionaries, margins, masked tokens, cubes and table functions against plain Python."""

import itertools
import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from factloom.functions import offsets, table_functions
from factloom.operators import alignment, copies, cubes, dictionary, margins, masked, resolution, rules, scans
from factloom.streaming import review

# --- alignment ------------------------------------------------------------------------------------------------------------------------


def plain_alignment(old, new, least):
    """Pairs of word sets of each place by the rules of align(), all against all."""
    out = []
    for place in sorted({r[0] for r in old + new}):
        sides = []
        for rows in (old, new):
            classes = {}
            for p, unit, text, a, z in rows:
                if p == place:
                    words = frozenset(re.findall(r"\w{4,}", (text or "").lower()))
                    classes.setdefault(words, []).append((unit, a, z))
            sides.append({min(u for u, _, _ in m): (w, m) for w, m in classes.items()})
        score = {}
        for (o, (wo, mo)), (n, (wn, mn)) in itertools.product(sides[0].items(), sides[1].items()):
            overlap = any(a < d and c < b for _, a, b in mo for _, c, d in mn if b > a and d > c)
            shared, union = len(wo & wn), len(wo | wn)
            if overlap or (shared and shared * least[1] >= union * least[0]):
                score[o, n] = (shared / max(union, 1), overlap)
        best = {}
        for side in (0, 1):
            for x in sides[side]:
                own = {k: s for k, s in score.items() if k[side] == x}
                top = [k for k, s in own.items() if s == max(own.values())]
                best[side, x] = top[0] if len(top) == 1 else None
        chosen = {k for k in score if best[0, k[0]] == k and best[1, k[1]] == k}
        out += [(place, o, n, "ALIGNED") for o, n in chosen]
        for side, lone in ((0, "REMOVED"), (1, "ADDED")):
            for x in sides[side]:
                if not any(k[side] == x for k in chosen):
                    state = "AMBIGUOUS" if any(k[side] == x for k in score) else lone
                    out.append((place, x, None, state) if side == 0 else (place, None, x, state))
    return sorted(out, key=str)


def test_alignment_equals_all_pairs(spark):
    r = random.Random(5)
    vocabulary = ["alpha", "betaa", "gamma", "delta", "common", "common", "common", "shrt"]

    def version(seed):
        rows, at = [], {}
        for unit in range(seed, 90, 2):
            place = r.choice(["p", "q", None, "hot", "hot"])
            text = r.choice([None, "", " ".join(r.choice(vocabulary) + str(r.choice(["", "", 1, 2])) for _ in range(r.randint(1, 6)))])
            a = at.get(place, 0)
            z = a + r.randint(0, 30)
            at[place] = z
            rows.append((place, unit, text, a, z))
        return rows

    old, new = version(0), version(1)
    frame = lambda rows: spark.createDataFrame([(*x, "clash") for x in rows], "place string, unit long, text string, a int, z int, shared string")
    for least in ((1, 2), (4, 5)):
        got = alignment.align(frame(old), frame(new), ["place"], "unit", "text", "a", "z", least=least, width=16)
        mine = [(("" if x.place is None else x.place), x.old_unit, x.new_unit, x.state) for x in got.collect()]
        some = lambda rows: [("" if x[0] is None else x[0], *x[1:]) for x in rows]
        assert sorted(mine, key=str) == plain_alignment(some(old), some(new), least)
    assert alignment.align(frame([]), frame([]), ["place"], "unit", "text", "a", "z").count() == 0


# --- offsets --------------------------------------------------------------------------------------------------------------------------


def test_offsets_slice_the_source():
    r = random.Random(1)
    signs = ["a", "b", " ", " ", "\t", "\n", "e", "é", "é", "­", "ﬁ", "—", "“", "​", "½", "x", "."]
    n = 0
    for _ in range(4000):
        t = "".join(r.choice(signs) for _ in range(r.randint(0, 14)))
        norm, runs = offsets.normalize(t)
        assert "  " not in norm and sum(x[3] for x in runs) == len(norm)
        for i in range(len(norm)):
            a, z = offsets.source_span(runs, i, i + 1)
            assert 0 <= a < z <= len(t) and norm[i] in offsets.normalize(t[a:z])[0]
        if len(norm) >= 3:
            i = r.randrange(len(norm) - 2)
            quote = norm[i : i + 3]
            if quote.strip() == quote and norm.find(quote, norm.find(quote) + 1) < 0 and offsets.normalize(quote)[0] == quote:
                a, z, k = offsets.places(t, quote)
                assert k == 1 and quote in offsets.normalize(t[a:z])[0]
                n += 1
    assert n > 500


def test_located_quotes(spark):
    rows = [("alpha   beta  gamma", "beta gamma", 8, 19), ("the ﬁrst­born oﬃcial", "firstborn official", 4, 20), ("say it again say it again", "say it again", None, None), ("x", None, None, None), (None, "quote quote", None, None), ("nothing here", "absent words", None, None), ("cáfé noir – oui", "cáfé noir - oui", 0, 18)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, t string, q string, a int, z int")
    got = df.withColumn("at", offsets.located(F.col("t"), F.col("q"), 8)).orderBy("i").collect()
    for x in got:
        a, z = x["a"], x["z"]
        if x.i == 6:  # six characters more in the source: two marks
            assert (x.at.start, x.at.end) == (0, len(x.t))
        else:
            assert (x.at.start, x.at.end) == (a, z), x
    assert [x["at"].n_places for x in got] == [1, 1, 2, 0, 0, 0, 1]


# --- resolution -----------------------------------------------------------------------------------------------------------------------


def test_chains_never_join_two_anchors(spark):
    # A - 2 - 3 - B; A - 6 - B; free 8 - 9; C alone; 12 behind the record where A and B meet; 13 and 14: one anchor, two birth dates
    records = [(1, "A", 1), (2, None, None), (3, None, None), (4, "B", 2), (6, None, None), (8, None, 7), (9, None, 7), (10, "C", None), (12, None, None), (13, "D", 5), (14, None, 6)]
    edges = [(1, 2), (2, 3), (3, 4), (1, 6), (6, 4), (8, 9), (6, 12), (13, 14)]
    r = spark.createDataFrame(records, "id long, official string, born int")
    e = spark.createDataFrame([(u, v, 0) for u, v in edges], "u long, v long, key_no int")
    got = {x.id: (x.entity, x.state, x.n_records) for x in resolution.resolve(r, e, "id", "official", ["born"]).collect()}
    assert got[1] == got[2] == ("A:A", "ANCHORED", 2) and got[3] == got[4] == ("A:B", "ANCHORED", 2)
    assert got[6] == got[12] == (None, "AMBIGUOUS", None)
    assert got[8] == got[9] == ("R:8", "FREE", 2) and got[10] == ("A:C", "ANCHORED", 1)
    assert got[13] == got[14] == (None, "INCOHERENT", 2)
    cut = {(x.u, x.v) for x in resolution.conflicts(r, e, "id", "official").collect()}
    assert cut == {(2, 3), (1, 6), (6, 4), (6, 12)}


def test_long_chain_between_anchors(spark):
    n = 41
    r = spark.createDataFrame([(i, {0: "A", n - 1: "B"}.get(i)) for i in range(n)], "id long, official string")
    e = spark.createDataFrame([(i, i + 1, 0) for i in range(n - 1)], "u long, v long, key_no int")
    got = {x.id: x.anchor for x in resolution.reach(r, e, "id", "official").collect()}
    assert [got[i] for i in range(n)] == ["A"] * 20 + [None] + ["B"] * 20


def test_key_edges_are_stars(spark):
    df = spark.createDataFrame([(i, "k" if i < 50 else None, f"m{i % 60}") for i in range(100)], "id long, a string, b string")
    edges = resolution.key_edges(df, "id", [["a"], ["b"]])
    assert edges.where("key_no = 0").count() == 49 and edges.where("key_no = 1").count() == 40


# --- copies ---------------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("least,q", [((85, 100), 2), ((85, 100), 3), ((6, 10), 2)])
def test_near_copies_equal_all_pairs(spark, least, q):
    r = random.Random(q)
    base = ["elsama berleyberez", "joda gukoorley", "anolan stromberezgu", "ab", "abc", "a", "aaaaaaaa", "elsama berleyberez jr"]

    def typo(s):
        i = r.randrange(len(s) or 1)
        return r.choice([s[:i] + s[i + 1 :], s[:i] + "x" + s[i:], s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :], s])

    rows = [(i, r.choice(["x", "y"]), r.choice([None, "", *[typo(typo(b)) for b in base]])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, city string, name string")
    got = {(x.city, x.a, x.b) for x in copies.near_copies(df, ["city"], "name", least=least, q=q).collect()}
    want = set()
    for city in ("x", "y"):
        names = sorted({n for _, c, n in rows if c == city and n})
        want |= {(city, a, b) for a, b in itertools.combinations(names, 2) if SequenceMatcher(None, a, b, autojunk=False).ratio() >= least[0] / least[1]}
    assert got == want and want
    led = {x.id: x.leader for x in copies.copy_groups(df, ["city"], "id", "name", least=least, q=q).collect()}
    assert len(led) == 120 and all(led[i] == i for i, _, n in rows if not n)
    assert all(led[a] == led[b] for a, ca, na in rows for b, cb, nb in rows if ca == cb and na and na == nb)


# --- scans ----------------------------------------------------------------------------------------------------------------------------


def test_running_states_equal_a_window(spark):
    from pyspark.sql import Window

    r = random.Random(3)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), r.choice([None, *range(20)]), i, r.choice([None, *range(9)]), r.choice([None, True, False])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int, f boolean").repartition(7)
    states = {"top": ("max", F.col("v")), "low": ("min", F.col("v")), "ever": ("any", F.col("f")), "always": ("all", F.col("f")), "total": ("sum", F.col("v")), "latest": ("last", F.col("v")), "earliest": ("first", F.col("v"))}
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    plain = {"top": F.max("v"), "low": F.min("v"), "ever": F.bool_or("f"), "always": F.bool_and("f"), "total": F.sum("v"), "latest": F.last("v", True), "earliest": F.first("v", True)}
    want = {x.i: tuple(x[n] for n in states) for x in df.withColumns({n: e.over(w) for n, e in plain.items()}).collect()}
    got = {x.i: tuple(x[n] for n in states) for x in scans.running(df, ["k"], ["t", "i"], states).collect()}
    assert got == want
    # the hot key lies in several ranges
    state = F.when(F.col("top") > 6, "high").when(F.col("ever"), "seen")
    changes = {x.i for x in scans.state_changes(df, ["k"], ["t", "i"], {n: states[n] for n in ("top", "ever")}, state).collect()}
    full = df.withColumns({n: plain[n].over(w) for n in ("top", "ever")}).withColumn("s", state)
    before = Window.partitionBy("k").orderBy("t", "i")
    marked = full.withColumn("p", F.lag("s").over(before)).withColumn("n", F.row_number().over(before))
    assert changes == {x.i for x in marked.collect() if x.n == 1 or x.s != x.p}
    assert scans.running(df.limit(0), ["k"], ["t", "i"], states).count() == 0


# --- dictionaries ---------------------------------------------------------------------------------------------------------------------


def test_dictionary_trie_and_joins_agree_with_plain_search(spark):
    r = random.Random(2)
    vocabulary = ["ab", "cd", "ef", "gh", "ij", "é", "X1"]
    terms = [(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 4))), str(r.randint(0, 5))) for _ in range(60)] + [("Ab  CD", "9"), ("", "1"), (None, "2"), ("--", "3")]
    texts = [(i, r.choice([None, ""]) if i < 4 else " ".join(r.choice([*vocabulary, "zz", "AB", "cd,", "(ef)"]) for _ in range(r.randint(1, 40)))) for i in range(60)]
    codes = {}
    for t, c in terms:
        key = tuple(re.findall(r"[^\W_]+", (t or "").lower()))
        if key:
            codes.setdefault(key, set()).add(c)
    want = set()
    for i, t in texts:
        words = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t or "")]
        k = 0
        while k < len(words):
            hit = next((n for n in range(4, 0, -1) if tuple(w for w, _, _ in words[k : k + n]) in codes and k + n <= len(words)), 0)
            if hit:
                c = codes[tuple(w for w, _, _ in words[k : k + hit])]
                want.add((i, words[k][1], words[k + hit - 1][2], min(c) if len(c) == 1 else "AMBIGUOUS"))
            k += max(hit, 1)
    docs, dictionary_ = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(terms, "term string, code string")
    for limit in (dictionary.TRIE_BYTES, 0):
        got = dictionary.find_terms(docs, "id", "t", dictionary_, "term", "code", trie_bytes=limit)
        assert {tuple(x) for x in got.collect()} == want
    assert dictionary.find_terms(docs, "id", "t", dictionary_.limit(0), "term", "code", trie_bytes=-1).count() == 0


def test_many_terms_cost_no_more_than_few():
    import time

    r = random.Random(0)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    text = " ".join(r.choice(words) for _ in range(60_000))

    def seconds(n):
        trie = dictionary.build_trie([(f"{r.choice(words)} {r.choice(words)} {i}", str(i)) for i in range(n)])
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            list(dictionary.trie_spans(trie, text))
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(10_000) < 4 * seconds(10)


def test_ambiguous_names_do_not_fall_through(spark):
    entries = spark.createDataFrame([("Alpha", "1"), ("alpha", "2"), ("Beta Two", "3"), ("beta two", "4"), ("betatwo", "3"), (None, "5"), ("Gamma", None)], "entry string, code string")
    names = spark.createDataFrame([("Alpha",), ("ALPHA",), ("BetaTwo",), ("Delta",), (None,), ("Alpha",), ("Gamma",)], "name string")
    stages = [("EXACT", lambda c: c), ("FOLDED", lambda c: F.lower(c)), ("SPACING", lambda c: F.replace(F.lower(c), F.lit(" "), F.lit("")))]
    got = {x.name: (x.code, x.stage) for x in dictionary.resolve_staged(names, "name", entries, "entry", "code", stages).collect()}
    assert got == {"Alpha": ("1", "EXACT"), "ALPHA": (None, "AMBIGUOUS"), "BetaTwo": ("3", "FOLDED"), "Delta": (None, "UNRESOLVED"), "Gamma": (None, "UNRESOLVED")}


# --- margins --------------------------------------------------------------------------------------------------------------------------


def test_margins_partition_the_blocks(spark):
    rows = []
    for page in range(6):
        shift = 4.9 if page % 2 else 5.1  # around the border of a cell
        rows += [("d", page, f"Report  {page}", 10.0, shift - 1, 40.0, shift + 1), ("d", page, "Body text", 10.0, 50.0, 90.0, 52.0), ("d", page, "Page " + str(page), 10.0, 95.0, 20.0, 97.0), ("d", page, f"own {'x' * page}", 60.0, 95.0, 70.0, 97.0), ("d", page, "Keep me", 60.0, 2.0, 70.0, 4.0)]
    rows += [("d", 9, None, 1.0, 1.0, 2.0, 2.0), ("d", 9, "No box", None, None, None, None), ("e", 0, "Report 1", 10.0, 4.0, 40.0, 6.0), ("d", 0, "Report  0", 10.0, 4.1, 40.0, 6.1)]
    df = spark.createDataFrame(rows, "doc string, page int, text string, l double, t double, r double, b double").withColumn("margin", F.lit(1)).drop("margin")
    got = margins.split_margins(df, "doc", "page", "text", ("l", "t", "r", "b"), F.lit(100.0), protected=F.col("text") == "Keep me")
    out = [(x.doc, x.text, x.margin) for x in got.collect()]
    assert len(out) == len(rows)
    assert {t for d, t, m in out if m} == {f"Report  {p}" for p in range(6)} | {f"Page {p}" for p in range(6)} and all(d == "d" for d, _, m in out if m)
    assert margins.split_margins(df.limit(0), "doc", "page", "text", ("l", "t", "r", "b"), F.lit(100.0)).count() == 0


# --- masked tokens --------------------------------------------------------------------------------------------------------------------


def plain_masked(text, classes):
    out = []
    for kind, pattern in classes:
        for m in re.finditer(pattern, text):
            out.append((m.start(), m.end(), kind, m[0]))
        text = re.sub(pattern, lambda m: "\u0002" * len(m[0]), text)
    return sorted(out)


def test_masked_tokens_equal_plain_search(spark):
    r = random.Random(4)
    bits = ["12.03.2020", "3.2019", "2021", "1999-05-06", "2001-07", "é", " ", " ", "x", "12/2018", "20202", "-", "."]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(300)] + [None, "", "2020 " * 3000, "a\u0001b 2020"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {x.i: [tuple(s) for s in x.spans] for x in masked.masked_spans(df, "t", masked.DATES).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_masked((t or "").replace("\u0001", "�"), masked.DATES), t


# --- cubes ----------------------------------------------------------------------------------------------------------------------------


def test_sketches_merge_the_same_whatever_the_parts(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7000).alias("d"), F.sqrt("id").alias("v"))
    for parts in (2, 11):
        stored = cubes.sketches(df.withColumn("p", F.col("d") % parts), ["k", "p"], "d", "v")
        got = cubes.estimates(cubes.merged(stored, ["k"]), ["k"], {"median": 0.5}).collect()
        for x in got:
            assert x.n in (6666, 6667) and abs(x.n_distinct - 6667) <= 6667 * 1.5 * cubes.DISTINCT_ERROR
            rank = df.where(f"k = {x.k} AND v <= {x.median}").count() / x.n
            assert abs(rank - 0.5) <= 2 * cubes.RANK_ERROR
    assert cubes.rollup_sets(["a", "b"]) == [["a", "b"], ["a"], []] and cubes.all_sets(["a", "b"]) == [["a", "b"], ["a"], ["b"], []]


def test_grouping_id_tells_nulls_apart(spark):
    df = spark.createDataFrame([("x", None), (None, 1), ("x", 1)], "a string, b int")
    got = {(x.a, x.b, x.grouping_id): x.n for x in cubes.grouped(df, ["a", "b"], cubes.all_sets(["a", "b"]), {"n": F.count(F.lit(1))}).collect()}
    assert got[None, None, 3] == 3 and got[None, None, 2] == 1 and got[None, None, 1] == 1 and got["x", None, 0] == 1 and got["x", None, 1] == 2


# --- table functions, rules, review stream --------------------------------------------------------------------------------------------


def test_table_functions_in_sql(spark):
    table_functions.register(spark)
    spark.createDataFrame([(1, "a1 b22"), (2, None), (3, "")], "id int, t string").createOrReplaceTempView("texts")
    got = spark.sql("SELECT id, m.* FROM texts, LATERAL matches(t, '[a-z]([0-9]+)', 'word') m").collect()
    assert [(x.id, x.number, x.start, x.end, x.word) for x in got] == [(1, 1, 0, 2, "a1"), (1, 2, 3, 6, "b22")]
    with pytest.raises(Exception, match="empty text"):
        spark.sql("SELECT * FROM texts, LATERAL matches(t, 'x*')").collect()
    rows = [("k", 1, None), ("k", 2, "p"), ("k", 3, None), ("l", 1, None), ("l", 2, "q")]
    spark.createDataFrame(rows, "key string, at int, label string").createOrReplaceTempView("labelled")
    carried = {(x.key, x["at"]): x.context for x in spark.sql("SELECT * FROM carried(TABLE(labelled), 'key', 'at', 'label')").collect()}
    assert carried == {("k", 1): None, ("k", 2): "p", ("k", 3): "p", ("l", 1): None, ("l", 2): "q"}
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "at int, v string").createOrReplaceTempView("runs")
    runs = spark.sql("SELECT * FROM run_lengths(TABLE(runs) WITH SINGLE PARTITION ORDER BY (at), 'v')").collect()
    assert [(x.start, x.value, x.n) for x in runs] == [(0, "a", 2), (2, "b", 1), (3, "a", 1)]


def test_rule_evaluator(spark):
    df = spark.createDataFrame([(1, "red house"), (2, "no red car"), (3, "blue"), (4, None), (5, "red and blue")], "i int, t string")
    fields = {"t": F.col("t")}
    table = [("NOT", {"t": "red"}, {"t": "house|and"}), ("RED", {"t": rules.words("red")}, {}), ("BLUE", {"t": "blue"}, {})]
    got = df.select("i", rules.decide(fields, table, "NONE").alias("d"), rules.exclusive(fields, table[1:]).alias("x"), rules.stated(F.col("t"), "red", "no red").alias("s"), F.array_join(rules.every(fields, table), ",").alias("e")).orderBy("i").collect()
    assert [x.d for x in got] == ["RED", "NOT", "BLUE", "NONE", "RED"] and [x.x for x in got] == ["RED", "RED", "BLUE", None, "AMBIGUOUS"]
    assert [x.s for x in got] == [True, False, None, None, True] and [x.e for x in got] == ["RED", "NOT,RED", "BLUE", "", "RED,BLUE"]
    with pytest.raises(KeyError):
        rules.decide(fields, [("X", {"u": "x"}, {})])


def test_streamed_review_equals_replay_for_any_cut(spark, tmp_path):
    from factloom.operators import clusters

    r = random.Random(7)
    items = [(a, k, f"v{k}") for a in "pq" for k in "xyz"]
    events = [(r.choice("pq"), i, r.choice(["ACCEPT", "REJECT", "EDIT", "SPLIT", "MERGE", "UNCERTAIN"]), r.choice("xyzuv"), r.choice(["u", "v", "x", None]), r.choice([None, "w"])) for i in range(60)]
    own = spark.createDataFrame(items, "artifact string, key string, value string")
    log = spark.createDataFrame(events, review.EVENT)
    want = {tuple(x) for x in clusters.replay(own, log, "artifact").collect()}
    rows = own.select("artifact", F.lit(None).cast("bigint").alias("at"), F.lit("ITEM").alias("action"), "key", F.lit(None).cast("string").alias("new_key"), "value").unionByName(log)
    root = str(tmp_path)
    for i, part in enumerate((rows.where("at IS NULL OR at < 7"), rows.where("at >= 7 AND at < 40"), rows.where("at >= 40"))):
        part.coalesce(1).write.parquet(f"{root}/in/part={i}")
        review.run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    got = review.current(spark.read.schema(review.CHANGE).parquet(f"{root}/out"))
    assert {tuple(x) for x in got.collect()} == want


def test_normal_form_is_unicode():
    assert offsets.normalize("é")[0] == unicodedata.normalize("NFKC", "é")
