"""Operators on texts against brute force, round trips and held-out labels, with nulls, empty and long texts, repeats and empty tables."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.llm import decontam, fingerprints, jaccard, language, mixing, pii, quality, tokenids, toxicity, warc
from factloom.llm.common import new_path, written

WORDS = "river stone light garden window paper silver morning cloud forest yellow bridge winter table music letter ocean candle mirror shadow".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 50, n)))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "x"), (4, "x"), (None, "no id here"), (5, "long " * 30_000), (6, "eé　\U0001f600 ok")]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).withColumn("spans", F.lit(1)).withColumn("score", F.lit("x"))


# --- Jaccard join ---------------------------------------------------------------------------------------------------------------


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[i] = own
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies():
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        base = prose(g, 120).split()
        for c in range(8):
            own = list(base)
            for k in rng.integers(0, len(own), c):
                own[k] = f"changed{g}x{c}x{k}"
            rows.append((g * 10 + c, " ".join(own)))
    rows += [(100 + k, prose(500 + k, 60)) for k in range(10)] + [(200, prose(0, 120)), (201, "a b c"), (202, "A b  c"), (203, "a b"), (204, ""), (205, None)]
    return rows


def test_jaccard_equals_brute_force(spark):
    rows = near_copies()
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    assert got == want


def test_jaccard_parts_of_large_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 3)
    rows = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def skewed_copies():
    """One passage in many texts, a chain of near copies whose ends aren't linked, and pairs of exactly the least similarity."""
    passage, rng, rows = prose(77, 60), np.random.default_rng(8), []
    rows += [(1000 + k, f"{prose(3000 + k, 120 + k)} {passage} {prose(4000 + k, 60)}") for k in range(40)]
    rows += [(1100 + k, f"{passage} {prose(5000 + k, 5)}") for k in range(12)]
    words = prose(55, 204).split()
    for k in range(30):
        rows.append((int(1300 - k if k % 2 else 1200 + k), " ".join(words)))
        words[int(rng.integers(0, 200))] = f"step{k}"
        words[(7 * k) % 200] = f"more{k}"
    base = prose(66, 94).split()  # 90 shingles; 10 fewer at an end leave 80 of 100
    rows += [(1400, " ".join([*(f"x{i}" for i in range(10)), *base])), (1401, " ".join([*base, *(f"y{i}" for i in range(10))])), (1402, " ".join(base))]
    return rows


def test_jaccard_equals_brute_force_on_skewed_input(spark, monkeypatch):
    rows = skewed_copies() + near_copies()
    want = brute_components(rows)
    assert len({c for i, (_, c) in want.items() if 1200 <= i <= 1300}) < 31
    for hot, leaf in ((1024, 1024), (8, 4), (2, 2)):
        monkeypatch.setattr(jaccard, "HOT", hot)
        monkeypatch.setattr(jaccard, "LEAF", leaf)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
        assert got == want, (hot, leaf)


def test_similar_sets_share_a_first_shingle():
    rng = np.random.default_rng(12)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 400, n)).astype(np.uint64)
        b = np.unique(np.where(rng.random(len(a)) < 0.12, rng.integers(0, 400, len(a)), a).astype(np.uint64))
        hot = np.unique(rng.integers(0, 400, int(rng.integers(0, 200)))).astype(np.uint64)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.first_shingles(a, hot), jaccard.first_shingles(b, hot)))


def test_points_keep_large_counts():
    counts = np.array([[300] * jaccard.GROUPS, [1] * jaccard.GROUPS, [70_000] * jaccard.GROUPS], np.uint32)
    assert (jaccard.unpacked([jaccard.packed(c) for c in counts]) == counts).all()


def test_finer_points_bound_what_sets_share():
    rng = np.random.default_rng(6)
    for n, m in ((100, 110), (500, 530), (510, 600), (1500, 1800), (3000, 3000)):
        a, b = (np.unique(rng.integers(0, 1 << 62, k)).astype(np.uint64) for k in (n, m))
        b[: n // 2] = a[: n // 2]
        b = np.unique(b)
        hashes, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        fine = [f or jaccard.packed(p) for f, p in zip(jaccard.fine_points(hashes, at), jaccard.points(hashes, at))]
        for blob, own in zip(fine, (a, b)):
            assert jaccard.folded(blob, jaccard.GROUPS, 1).sum() == len(own)
        both = pa.RecordBatch.from_arrays([pa.array([1, 1, 2]), pa.array([2, 1, 2]), pa.array([len(a), len(a), len(b)]), pa.array([len(b), len(a), len(b)]), pa.array([fine[0], fine[0], fine[1]], pa.binary()), pa.array([fine[1], fine[0], fine[1]], pa.binary())], names=list("abcdef"))
        out = next(jaccard._by_fine_points([both])).to_pylist()
        assert {(1, 1), (2, 2)} <= {(r["a"], r["b"]) for r in out} and (n < 1000 or len(out) == 2)  # long texts of which half is shared are told apart


def test_tree_join_finds_all_pairs():
    rng = np.random.default_rng(1)
    counts = rng.poisson(3, (150, jaccard.GROUPS)).astype(np.uint16)
    counts[100:] = counts[:50]
    counts[100:, 0] += 1
    sizes, ids = counts.sum(1).astype(np.int64), np.arange(150)
    got = set(jaccard.tree_join(ids, ids, sizes, counts, np.zeros(150)))
    want = {(a, b) for a in range(150) for b in range(a + 1, 150) if 180 * int(np.minimum(counts[a], counts[b]).sum()) >= 80 * int(sizes[a] + sizes[b])}
    assert got == want and len(want) >= 50


def test_jaccard_edges(spark):
    out = jaccard.near_duplicates(documents(spark, EDGE)).collect()
    assert len(out) == len(EDGE)
    assert {r["n_shingles"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None]
    assert jaccard.near_duplicates(documents(spark, EDGE).where("false")).count() == 0


# --- language, toxicity, quality ----------------------------------------------------------------------------------------------------


def brute_phrases(text, sample):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i : i + k] in sample:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_language_phrases_equal_longest_match_parsing():
    samples = {"a": b"the cat sat on the mat and the hat", "b": b"der hund und die katze und das haus"}
    parser = language.Parser(samples)
    text = b"the hat and the hund sat"
    codes = parser.code[np.frombuffer(text, np.uint8)]
    got = parser.phrases(codes, np.array([0]), np.array([len(text)]))[0]
    assert got.tolist() == [brute_phrases(text, samples["a"]), brute_phrases(text, samples["b"])]


def test_language_edges(spark):
    samples = {"en": prose(1, 300).encode(), "xx": b"qzx jqv wkq zzq " * 50}
    got = {(r["doc_id"], r["lang_pred"]) for r in language.predict(documents(spark, EDGE), samples).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "en")} <= got
    assert language.predict(documents(spark, EDGE), {}).where("lang_pred <> 'und'").count() == 0
    assert language.predict(documents(spark, EDGE).where("false"), samples).count() == 0


def test_language_held_out(spark):
    rows = [(i, " ".join(np.random.default_rng(i).choice(["the", "and", "of", "house"] if i % 2 else ["der", "und", "das", "haus"], 40)), "en" if i % 2 else "de", "s", 1) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    got = language.predict(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred <> lang").count() == 0


def toxic_docs():
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        sentences = [prose(i * 7 + k, 8) for k in range(5)]
        if bad:
            sentences[i % 5] += " " + ["rotten", "filthy"][i % 8 // 4]
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_words_and_finds_the_sentence(spark):
    rows, labels = toxic_docs()
    docs, known = documents(spark, rows), frame(spark, labels, "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i]["predicted"] == y for i, y in labels)
    text = dict(rows)[4]
    best = max(got[4]["sentences"], key=lambda s: s["score"])
    assert re.search("rotten|filthy", text[best["start"] : best["end"]])


def test_toxicity_without_labels_and_edges(spark):
    docs = documents(spark, EDGE)
    model = toxicity.train(docs, frame(spark, [], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect() if r["doc_id"] == 2} == {0.0}
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.Scorer({"words": {"bad": 9.0}, "b": -9.0, "leak": 0.01})("a BAD day")[0] > 0.4


def test_quality_held_out(spark):
    rows = [(i, prose(i, 60) if i % 3 else " ".join(w + "***" for w in prose(i, 60).split())) for i in range(300)]
    docs, labels = documents(spark, rows), frame(spark, [(i, int(i % 3 > 0)) for i in range(300)] + [(1, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in quality.score(docs, model).collect()}
    assert all(got[i] == int(i % 3 > 0) for i in range(300))
    assert quality.keep_good(docs, model).columns == docs.columns
    assert {r["doc_id"] for r in quality.keep_good(docs, model).collect()} == {i for i in range(300) if i % 3}


def test_quality_flat_walk_equals_nested_walk():
    rng = np.random.default_rng(0)
    x = rng.random((200, len(quality.NAMES)))
    model = quality.fit_trees(x, (x[:, 0] > 0.5).astype(float))
    start, features, values, leaves = model
    for row in x[:20]:
        raw = start
        for f, v, leaf in zip(features, values, leaves):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > v[node])
            raw += leaf[node - len(f)]
        assert quality.score_rows(model, row[None])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_quality_edges(spark):
    docs = documents(spark, EDGE)
    model = quality.train(docs, frame(spark, [], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.where("false"), model).count() == 0


# --- token ids, WARC --------------------------------------------------------------------------------------------------------------------


def test_tokens_round_trip(spark):
    rows = [(7, "a  b. c"), (3, "The end, isn't it?\nNext line"), (9, prose(1, 400)), (1, None), (2, ""), (5, "<|endoftext|> x"), (5, "twice"), (8, " odd  blanks ")]
    path = new_path(spark, "ids")
    tokenids.write(documents(spark, rows), path)
    t = tokenids.tokenizer(tokenids.default_path())
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    ids = [t.encode(x or "", add_special_tokens=False).ids + [0] for _, x in ordered]
    got = sorted(tokenids.digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [i for i, _ in ordered]
    assert [r["n_tokens"] for r in got] == [len(x) for x in ids]
    assert [r["start"] for r in got] == [sum(map(len, ids[:k])) for k in range(len(ids))]
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [r["ids"] for r in tokenids.read(spark, path, [9]).collect()] == [ids[-1]]


def test_tokens_empty_table(spark):
    path = new_path(spark, "ids")
    tokenids.write(documents(spark, []), path)
    assert tokenids.digests(spark, path).count() == 0


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>"), (5, "http://b/\r\n", "<p>x</p>"), (3, None, "<p>x</p>"), (2, "u", None), (4, "u", ""), (6, "u", "ü"), (None, "u", "z")], "page_id long, url string, html string").withColumn("payload", F.lit(0))
    path = new_path(spark, "warc")
    warc.write(pages, path)
    got = {r["page_id"]: r for r in warc.read(spark, path).collect()}
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None), 2: ("revisit", 4), 4: ("response", None), 6: ("response", None), None: ("response", None)}
    import base64

    assert got[6]["payload_bytes"] == 2 and got[6]["payload_digest"] == base64.b32encode(hashlib.sha1("ü".encode()).digest()).decode()
    record = {r["page_id"]: bytes(r["record"]) for r in warc.records(spark, path).collect()}
    assert record[5].endswith(b"\r\n\r\n<p>x</p>\r\n\r\n") and b"WARC-Refers-To" not in record[5] and b"WARC-Refers-To: <urn:page:5>" in record[1]
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_warc_refuses_changed_payload(spark):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"y"))
    written(bad, "bad").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="other bytes"):
        warc.read(spark, path).collect()


# --- personal data, fingerprints --------------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for n, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), n, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PII = [
    "write to a.b@c.de%x@y.org.uk now",
    "hosts 1.2.3.4.5 and 256.1.1.1 and 0010.0.0.255",
    "card 4111 1111 1111 1111, not 4111 1111 1111 1112, 4111-1111-1111-1111 7",
    "call +49 (30) 123456-78 or +1 2 or +12345678901234567",
    "\U0001f600 x@y.z  ü 10.0.0.1",
    "aaaa@bbbb @c.d a@b a@b. a@b..c",
    "1" * 4000 + " " + "a" * 5000,
    "",
]


def test_pii_equals_plain_patterns(spark):
    from factloom.llm.pii import BASE, KINDS, spans

    out = spans(documents(spark, list(enumerate(PII)) + [(99, None)])).collect()
    for r in out:
        got = ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] < len(BASE))
        assert got == brute_spans(PII[r["doc_id"]] if r["doc_id"] != 99 else "")


def test_pii_added_kinds_need_check_or_context(spark):
    from factloom.llm.pii import KINDS, spans

    rows = [(1, "iban GB82 WEST 1234 5698 7654 32 ok"), (2, "iban GB82 WEST 1234 5698 7654 33 ok"), (3, "my social security number 123-45-6789"), (4, "part 123-45-6789")]
    got = {r["doc_id"]: [KINDS[s["kind"]] for s in r["spans"]] for r in spans(documents(spark, rows)).collect()}
    assert "iban" in got[1] and "iban" not in got[2] and "national_id" in got[3] and "national_id" not in got[4]


def test_pii_ibans_end_by_length_and_context_is_on_both_sides(spark):
    from factloom.llm.pii import KINDS, spans

    de, gb = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    odd = "ZZ" + str(98 - int("1234567890123" + "353500") % 97).zfill(2) + "1234567890123"
    rows = [f"{de} BIC COBADEFF", f"{de} 2024", f"{de} Please", f"{de} {gb} {de}", f"é {gb} A", f"{odd} NEXT {de}", f"{de}1", f"{de[:-1]}", f"{de}, {de}", f"AB12 {de}"]
    found = [[de], [de], [de], [de, gb, de], [gb], [odd, de], [], [], [de, de], [de]]
    rows += ["SSN 123-45-6789, 987-65-4321", "123-45-6789 (SSN)", "123-45-6789 " + "x" * 60 + " SSN", "123-45-6789" + ", 987-65-4321" * 2 + " SSN"]
    found += [["123-45-6789", "987-65-4321"], ["123-45-6789"], [], ["123-45-6789", "987-65-4321", "987-65-4321"]]
    for r in spans(documents(spark, list(enumerate(rows)))).collect():
        text = rows[r["doc_id"]]
        assert [text[s["start"] : s["end"]] for s in r["spans"] if KINDS[s["kind"]] in ("iban", "national_id")] == found[r["doc_id"]], text


def test_pii_empty_table(spark):
    assert pii.spans(documents(spark, []).where("false")).count() == 0


def test_fingerprint_differences_are_exact(spark):
    rows = [(i, "\n".join(prose(i * 100 + k if k % 2 else k, 12) for k in range(i % 40 + 1))) for i in range(60)] + [(60, ""), (61, None), (61, None), (None, "x")]
    d = fingerprints.with_next(frame(spark, rows))
    d = d.select("range", "nth", "doc_id", fingerprints.digests(F.col("text")).alias("a"), fingerprints.digests(F.col("next")).alias("b"))
    out = fingerprints.compared(written(d, "d"), [("a", "b")]).select("d0", fingerprints.difference(F.col("a"), F.col("b")).alias("again"), (F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))).alias("exact")).collect()
    assert len(out) == len(rows) and all(r["d0"] == r["again"] == r["exact"] for r in out)


def test_next_document_and_edited_text(spark, tmp_path):
    rows = [(i, f"{i:03d} " + prose(i, 5)) for i in range(50)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    texts = dict(rows)
    for r in fingerprints.op8_fingerprints(spark, str(tmp_path)).collect():
        own, nxt = texts[r["doc_id"]], texts[(r["doc_id"] - 1) % 50]
        k = len(own) // 3
        assert r["edited_sha256"] == hashlib.sha256((own[: len(own) - k] + nxt[:k]).encode()).hexdigest()
        assert r["n_chars"] == len(own) and 0 <= r["near_next"] <= 1


def test_fingerprint_edges(spark, tmp_path):
    documents(spark, EDGE).write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprints.op8_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(EDGE)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 4}) == 1
    documents(spark, EDGE).where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fingerprints.op8_fingerprints(spark, f"{tmp_path}/none").count() == 0


def brute_likeness(a, b):
    cut = lambda t: {p for p in re.findall(rf"(?:[^ \t\n\x0b\f\r]+[ \t]+){{0,{fingerprints.PIECE_WORDS - 1}}}[^ \t\n\x0b\f\r]+", t)}
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_comes_from_the_returned_fingerprints(spark, tmp_path):
    rows = [(i, "\n".join(prose(i * 1000 + k, 9) for k in range((i * 7) % 90))) for i in range(40)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = fingerprints.op8_fingerprints(spark, str(tmp_path))
    own = out.withColumn("d", fingerprints.differing_pieces(F.col("fingerprint"), F.col("edited_fingerprint"))).withColumn("l", fingerprints.parsed(F.col("fingerprint"))["pieces"]).withColumn("r", fingerprints.parsed(F.col("edited_fingerprint"))["pieces"]).collect()
    texts, peeled = dict(rows), 0
    for r in own:
        text, nxt = texts[r["doc_id"]], texts[(r["doc_id"] - 1) % 40]
        k = len(text) // 3
        edited = text[: len(text) - k] + nxt[:k]
        assert r["near_edited"] == pytest.approx(brute_likeness(text, edited)) and r["near_next"] == pytest.approx(brute_likeness(text, nxt))
        if r["d"] is not None and r["l"] + r["r"]:
            assert r["near_edited"] == pytest.approx((r["l"] + r["r"] - r["d"]) / (r["l"] + r["r"] + r["d"]))
            peeled += 1
    assert peeled >= 34  # the fingerprints alone hold enough for an edit of a third


def test_a_small_edit_leaves_cells_in_proportion_to_it(spark):
    lines = [prose(k, 9) for k in range(2000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:1000], "another line", *lines[1001:]])), (3, "\n".join(lines[:600]))]
    d = frame(spark, rows).select("doc_id", F.lit(0).alias("range"), F.col("doc_id").cast("int").alias("nth"), fingerprints.digests(F.col("text")).alias("a"))
    prints = {r["nth"]: r for r in fingerprints.sketches(d.repartition("range", "nth"), ["a"]).join(d, ["range", "nth"]).select("nth", fingerprints.fingerprint(F.size("a"), F.col("f_a")).alias("f")).collect()}
    pair = spark.createDataFrame([(prints[1]["f"], prints[2]["f"], prints[3]["f"])], "l string, r string, s string")
    l, r, s = (fingerprints.parsed(F.col(c)) for c in "lrs")
    got = pair.select(F.size(fingerprints.subtract(l["cells"], r["cells"])).alias("left"), fingerprints.differing_pieces(F.col("l"), F.col("r")).alias("d"), s["third"].alias("small"), l["third"].alias("large"), fingerprints.differing_pieces(F.col("l"), F.col("s")).alias("far")).first()
    assert got["left"] <= 6 and got["d"] == 2
    assert got["small"] < got["large"] and got["far"] is None  # folded to the smaller size, too few cells for 1400


def test_next_documents_across_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = [(i * 3 % 100, f"t{i * 3 % 100:03d}") for i in range(100)] + [(None, "null")] * 2
    got = {(r["text"], r["next"]) for r in fingerprints.with_next(frame(spark, rows)).collect()}
    order = [f"t{i:03d}" for i in range(99, -1, -1)] + ["null"]
    assert got == set(zip(order, [*order[1:], order[0]])) | {("null", "null")}


# --- decontamination, mixing --------------------------------------------------------------------------------------------------------------


def test_decontamination_finds_passages_and_paraphrases(spark):
    items = [(k, prose(9000 + k, 30) + ". " + prose(9500 + k, 8) + ".") for k in range(5)]
    rows = [(i, prose(i, 300)) for i in range(40)]
    rows.append((100, prose(70, 90) + " " + items[2][1] + " " + prose(71, 90)))
    words = items[3][1].split()
    rows.append((101, prose(72, 60) + " " + " ".join(w for k, w in enumerate(words) if k % 8) + " " + prose(73, 60)))
    rows += [(None, None), (102, "")]
    found = decontam.contaminated(documents(spark, rows), frame(spark, items + [(9, None), (10, "too short")], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(100, 2), (101, 3)}
    assert decontam.contaminated(documents(spark, rows).where("false"), frame(spark, items, "item_id long, text string")).count() == 0


def brute_matches(items, rows):
    """(doc_id, item_id) of the pairs of which some part of the document, at any place, passes."""
    out = set()
    for i, t in rows:
        words = next((w for _, _, w, _ in decontam.tokens(pa.array([t]))), np.zeros(0, np.uint16))
        for k, own in enumerate(items.words):
            n = len(own)
            for a in range(max(1, len(words) - n - n // 2 - 1)):
                part = words[a : a + n + n // 2 + 2]
                common = items.lcs(k, part)
                if common >= decontam.LEAST_SHARE * n and (common >= decontam.WHOLE_SHARE * n or np.isin(items.answers[k], part).mean() >= decontam.LEAST_ANSWER):
                    out.add((i, items.ids[k]))
                    break
    return out


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    common = [f"c{k}" for k in range(30)]
    items = [(k, prose(9000 + k, n)) for k, n in enumerate([5, 6, 8, 10, 12, 16, 24, 40, 60, 70, 130])]
    items += [(20 + k, " ".join(rng.choice(common, n, replace=n > 30))) for k, n in enumerate([8, 12, 20, 40])] + [(30, "a b " * 5)]
    rows = []
    for k, (_, item) in enumerate(items):
        w = item.split()
        wide = " ".join(f"{x} n{j}" if j % 3 == 0 else x for j, x in enumerate(w))
        for j, part in enumerate([item, " ".join(x for i, x in enumerate(w) if i % 7 != 3), wide, " ".join(w[len(w) * 2 // 5 :])]):
            about = [" ".join(rng.choice(common, 40)) + " " + prose(k * 10 + j + z, 60 + j) for z in (0, 500)]
            rows.append((k * 10 + j, f"{about[0]} {part} {about[1]}"))
    rows += [(900 + k, " ".join(rng.choice(common, 50)) + prose(k, 200)) for k in range(20)]
    own = decontam.Items(items, np.zeros((decontam.FEATURES + 1, decontam.RANK), np.float32))
    expected = brute_matches(own, rows)
    found = decontam.contaminated(documents(spark, rows), frame(spark, items, "item_id long, text string")).collect()
    assert len(expected) >= 3 * len(items)
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected


def test_decontamination_matches_items_under_five_words(spark):
    items = [(1, "Golden heron, forty."), (2, "forty"), (3, "a b a"), (4, "..."), (5, ""), (6, "golden forty")]
    rows = [(1, prose(1, 50) + " golden HERON forty " + prose(2, 50)), (2, "golden heron"), (3, "forty a b. a b a"), (4, "a b"), (4, "a forty"), (5, None), (6, "golden"), (7, "heron forty")]
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["end_word"]) for r in decontam.contaminated(documents(spark, rows), frame(spark, items, "item_id long, text string")).collect()}
    assert got == {(1, 1): (50, 53), (1, 2): (52, 53), (3, 2): (0, 1), (3, 3): (1, 4), (4, 2): (1, 2), (7, 2): (1, 2)}


def test_last_words_of_a_long_item_are_a_query():
    words = prose(5, 60).split()
    axes = np.random.default_rng(4).normal(size=(decontam.FEATURES + 1, decontam.RANK)).astype(np.float32)
    items = decontam.Items([(1, " ".join(words))], axes)
    text = next(w for _, _, w, _ in decontam.tokens(pa.array([" ".join(words[-38:])])))
    assert any(len(x[0]) for x in items.candidates(text, np.array([0, len(text)])))
    assert [m[1] for m in items.matches(text, np.array([0, len(text)]))] == [0]


def test_lcs_equals_table():
    items = decontam.Items([(1, "a b c d e f g h")], np.zeros((decontam.FEATURES + 1, decontam.RANK), np.float32))
    words = items.words[0]
    rng = np.random.default_rng(2)
    for _ in range(50):
        other = rng.choice(words, 12)
        table = np.zeros((len(words) + 1, 13), int)
        for i, a in enumerate(words):
            for j, b in enumerate(other):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        assert items.lcs(0, other) == table[-1, -1]


def test_targets_reshare_the_excess():
    got = mixing.targets({"a": 100, "b": 100, "c": 100, None: 100})
    assert got == {"a": 200.0, None: 200.0, "b": pytest.approx(200 / 3), "c": pytest.approx(400 / 3)}
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(4)
    p, sizes = np.full(300, 0.37), rng.integers(1, 2000, 300).astype(float)
    q = mixing.flight(p, sizes, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and (q * sizes).sum() == pytest.approx((p * sizes).sum())


def test_mixing_hits_targets_and_agrees_with_itself(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    rows = [(i, prose(i, 5 + i % 60), None, None if i % 7 == 0 else f"s{i % 3}", 1) for i in range(700)] + [(3, prose(3, 8), None, "s0", 1)] * 2 + [(None, None, None, "s1", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    sized = mixing.sized(docs)
    once, again = (sorted(map(str, mixing.copies(sized).collect())) for _ in range(2))
    assert once == again and len(once) == len(rows)
    per = mixing.copies(sized).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 64 and r["most"] <= 2 for r in per)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in mixing.copies(sized).collect())


def test_mixing_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


# --- sampling and whole texts ---------------------------------------------------------------------------------------------------------


def test_texts_without_a_word_get_the_leak():
    model = {"words": {"rotten": 6.0, "fil*": 2.0}, "b": -3.0, "leak": 0.01}
    scorer = toxicity.Scorer(model)
    for text in (None, "", "3.14", "1. 2. 3. 4.", "\n" * 50, " ... !!! 7_7 "):
        assert scorer(text) == (0.01, [])


def brute_noisy_or(text, model):
    """Sentences by hand: stretches between stops and line ends that hold a letter."""
    rest = 1 - model["leak"]
    for part in re.split(r"[.!?\n]+", text):
        words = re.findall(r"[^\W\d_]+", toxicity.lowered(part))
        if words:
            z = model["b"] + sum(x for w, x in model["words"].items() if (w in words if w[-1] != "*" else any(v.startswith(w[:-1]) and len(v) > len(w) - 1 for v in words)))
            rest *= 1 - 1 / (1 + np.exp(-z))
    return 1 - rest


def test_toxicity_score_equals_noisy_or_by_hand(spark):
    model = {"words": {"rotten": 6.0, "river": 1.0, "silve*": 0.7}, "b": -4.0, "leak": 0.02}
    scorer = toxicity.Scorer(model)
    texts = ["Rotten. Fine; ROTTEN 3.5 rotten_x", "river silver4 silv silverX! 22. ?!", "İrotten rotten²", prose(4, 200) + ". rotten\n\nriver"]
    for t in texts:
        assert scorer(t)[0] == pytest.approx(brute_noisy_or(t, model))


def test_toxicity_learns_from_long_texts_and_repeated_ids(spark):
    rows, labels = toxic_docs()
    rows = [(i, prose(i, 4000) + ". " + t if i % 40 == 0 else t) for i, t in rows] + [rows[4]] * 300
    model = toxicity.train(documents(spark, rows), frame(spark, labels + labels[:3] + [(None, 1)], "doc_id long, toxic int"), sample=350)
    assert {"rotten", "filthy"} <= set(model["words"])
    held = toxicity.score(documents(spark, rows), model).join(frame(spark, labels, "doc_id long, toxic int"), "doc_id").where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2)
    got = held.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    assert {r["toxic"]: r["p"] for r in got} == {0: 0.0, 1: 1.0}


def test_language_learns_from_all_over_a_text(spark):
    header = "navigation menu imprint search " * 60
    rows = [(i, header + " ".join(np.random.default_rng(i).choice(["the", "and", "of", "house"] if i % 2 else ["der", "und", "das", "haus"], 600)), "en" if i % 2 else "de", "s", 1) for i in range(8)]
    samples = language.train(spark.createDataFrame(rows + [rows[0]] * 50, DOCS), size=20_000)
    assert set(samples) == {"en", "de"} and all(len(x) > 8_000 for x in samples.values())  # few documents fill the bytes
    assert b"haus" in samples["de"] and b"house" in samples["en"] and samples["de"].count(b"menu") < len(samples["de"]) / 40


def test_quality_scores_equal_a_walk_by_hand_and_repeated_ids_are_one_row(spark):
    rows = [(i, prose(i, 80) if i % 2 else "||| " * 40 + str(i)) for i in range(200)]
    labels = frame(spark, [(i, i % 2) for i in range(200)] + [(None, 1)], "doc_id long, quality int")
    model = quality.train(documents(spark, rows + [rows[3]] * 500), labels)
    start, features, values, leaves = model
    got = {r["doc_id"]: r["score"] for r in quality.score(documents(spark, rows), model).collect()}
    for i, text in rows[:40]:
        x, raw = quality.statistics(pa.array([text]))[0], start
        for f, v, leaf in zip(features, values, leaves):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(x[f[node]] > v[node])
            raw += leaf[node - len(f)]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-raw)))
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(200))


def test_tokens_of_null_and_repeated_ids_and_long_texts(spark):
    rows = [(None, f"none {k}") for k in range(40)] + [(7, f"seven {k}") for k in range(40)] + [(7, "seven 1")] * 20 + [(9, "word " * 60_000), (3, "a" * 50_000)]
    path = new_path(spark, "ids")
    tokenids.write(frame(spark, rows).repartition(8), path)
    got = sorted(tokenids.digests(spark, path).collect(), key=lambda r: r["start"])
    t = tokenids.tokenizer(tokenids.default_path())
    want = sorted((i is not None, i or 0, zlib.crc32(np.array(t.encode(x, add_special_tokens=False).ids + [0], "<u4").tobytes())) for i, x in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == list(itertools.accumulate([0, *(r["n_tokens"] for r in got[:-1])]))
    assert [r["doc_id"] for r in got if r["doc_id"] is not None] == sorted(r["doc_id"] for r in got if r["doc_id"] is not None) and got[0]["doc_id"] is None
    assert tokenids.file_number("part-100000-x.orc") > tokenids.file_number("part-99999-x.orc")


def test_units_with_one_hash_are_told_apart(monkeypatch):
    real = tokenids.npwords.run_hashes
    encoder = tokenids.Encoder(tokenids.default_path())
    monkeypatch.setattr(tokenids.npwords, "run_hashes", lambda d, a, z, *v: real(d, a, z, *v) if v else np.full(len(a), 12345, np.uint64))
    texts = ["one two three, four", "five six. seven", "one two three, four"]
    flat, sizes = encoder(pa.array(texts))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert flat.tolist() == [i for ids in want for i in ids] and sizes.tolist() == [len(x) for x in want]


def test_tokenizers_with_other_cuts_encode_whole_texts(tmp_path):
    import json

    with open(tokenids.default_path()) as f:
        told = json.load(f)
    told["pre_tokenizer"]["use_regex"] = False
    path = str(tmp_path / "other.json")
    with open(path, "w") as f:
        json.dump(told, f)
    assert tokenids.cuts_hold(tokenids.default_path()) and not tokenids.cuts_hold(path)
    text = "Some text, with stops. And\nlines"
    flat, _ = tokenids.Encoder(path)(pa.array([text]))
    assert flat.tolist() == tokenids.tokenizer(path).encode(text, add_special_tokens=False).ids + [0]


def test_mixing_names_repeats_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    rows = [(i, prose(i, 10 + i % 30), None, f"s{i % 3}", 1) for i in range(120)] + [(7, prose(7, 17), None, "s1", 1)] * 200 + [(7, prose(k, 17), None, "s1", 1) for k in range(50)] + [(500, "word " * 40_000, None, "s2", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("size", "salt", "one", "i", "o", "z", "s", "low", "more", "n", "copies", "__copies", "__size", "nth", "target", "Block"):
        docs = docs.withColumn(c, F.lit(c))
    once, again = (sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert once == again
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.where("size <> 'size' or n <> 'n' or __copies <> '__copies' or i <> 'i'").count() == 0
    assert mixed.count() == sum(r["copies"] for r in mixing.copies(mixing.sized(docs)).collect())
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(mixing.size_of()).alias("n")).collect()}
    assert all(abs(taken.get(s, 0) - w) <= 0.02 * w + 40 for s, w in mixing.targets(sizes).items() if s != "s2")


def test_swaps_close_the_gap_that_landing_leaves():
    sizes = np.array([5.0, 7, 11, 13, 400, 90, 3, 8])
    p = np.array([1.0, 0, 1, 0, 1, 0, 0, 1])
    got = mixing.repair(p, sizes, np.arange(8), 426.0)
    assert abs(426 - got @ sizes) <= abs(426 - p @ sizes) and got.sum() == p.sum() and abs(426 - got @ sizes) <= 2
    assert (mixing.repair(p, sizes, np.array([], int), 999.0) == p).all()


def test_decontamination_in_parts_of_the_benchmark(spark, monkeypatch):
    items = [(k, prose(9000 + k, 12 + k)) for k in range(9)] + [(20, "golden forty"), (21, "golden forty")]
    rows = [(i, f"{prose(i, 80)} {items[i % 9][1]} {prose(i + 50, 80)} golden forty") for i in range(12)]
    bench = frame(spark, items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.contaminated(documents(spark, rows), bench).select("doc_id", "item_id", "start_word", "end_word").collect()))
    monkeypatch.setattr(decontam, "PART_ITEMS", 2)
    parts = sorted(map(tuple, decontam.contaminated(documents(spark, rows), bench).select("doc_id", "item_id", "start_word", "end_word").collect()))
    assert whole == parts and len({(i, k) for i, k, _, _ in whole if k < 9}) == 12 and sum(k > 9 for _, k, _, _ in whole) == 24
    assert decontam.contaminated(documents(spark, rows), bench.where("false")).count() == 0


def test_decontamination_finds_paraphrases(spark):
    """Planted paraphrases at three strengths: words dropped and replaced; the recall is that of pairs which pass the subsequence and answer checks."""
    items = [(k, prose(9000 + k, 30) + ". " + prose(9500 + k, 8) + ".") for k in range(30)]
    for strength, least in (((0.05, 0.05), 30), ((0.1, 0.1), 29), ((0.1, 0.2), 24)):
        rows = []
        for k, text in items:
            rng = np.random.default_rng(k)
            words = [f"new{rng.integers(1 << 30)}" if rng.random() < strength[1] else w for w in text.split() if rng.random() >= strength[0]]
            rows.append((k, f"{prose(k, 150)} {' '.join(words)} {prose(k + 99, 150)}"))
        found = decontam.contaminated(documents(spark, rows), frame(spark, items, "item_id long, text string")).where("doc_id = item_id").count()
        assert found >= least, (strength, found)


def test_decontamination_of_repeats_long_texts_and_clashing_columns(spark):
    items = [(1, prose(9001, 20)), (1, prose(9001, 20)), (2, prose(9002, 300))]
    long = " ".join(prose(k, 1000) for k in range(40))
    rows = [(1, f"{long} {items[0][1]} {long}"), (1, f"{long} {items[0][1]} {long}"), (2, items[2][1]), (3, "x " * 50_000)]
    docs = documents(spark, rows).withColumn("item_id", F.lit(5)).withColumn("cosine", F.lit("c")).withColumn("words", F.lit(0))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, frame(spark, items, "item_id long, text string")).collect()}
    assert got == {(1, 1), (2, 2)}


def test_sums_meet_in_levels(spark, monkeypatch):
    from factloom.llm import common

    monkeypatch.setattr(common, "FAN", 2)
    rows = spark.range(0, 70, 1, 7).selectExpr("cast(id % 3 as int) as axis", "id")

    def run(batches):
        for b in batches:
            for axis, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([axis], pa.int32()), pa.array([np.array([1.0, i]).tobytes()], pa.binary())], names=["axis", "sums"])

    got = common.tree_sum(rows.mapInArrow(run, "axis int, sums binary"))
    assert {k: v.tolist() for k, v in got.items()} == {a: [len(range(a, 70, 3)), sum(range(a, 70, 3))] for a in range(3)}
    assert common.tree_sum(rows.where("false").mapInArrow(run, "axis int, sums binary")) == {}


def test_work_tables_need_a_shared_folder():
    from types import SimpleNamespace

    from factloom.llm import common

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda *a: None)))
    with pytest.raises(ValueError):
        common.shared_folder(cluster)


@pytest.mark.parametrize("name", ["op4_jaccard", "op7_warc"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    import os

    import duckdb

    from factloom.llm import queries

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no driver tables")
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, data), con.execute(queries.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(map(str, r)) for r in got.select(*names).collect()) == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_warc_of_empty_tables_repeated_ids_and_long_payloads(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 300_000), (2, "u", "x" * 300_000), (2, "v", "x" * 300_000), (3, "w", None), (None, "n", "x" * 300_000)], "page_id long, url string, html string").withColumn("sha256", F.lit("clash")).withColumn("payload", F.lit(1))
    path = new_path(spark, "warc")
    warc.write(pages, path)
    got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read(spark, path).collect()), key=str)
    assert got == sorted([(0, 300_000, "revisit", 2), (1, 300_000, "revisit", 2), (2, 300_000, "response", None), (2, 300_000, "response", None), (3, 0, "response", None)], key=str)
    path = new_path(spark, "warc")
    warc.write(pages.where("false"), path)
    assert warc.read(spark, path).count() == 0 and warc.records(spark, path).count() == 0
