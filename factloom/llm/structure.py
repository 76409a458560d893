"""Conversation structure repair: the cheapest edits after which a conversation's roles follow the grammar, as shortest paths of composed weighted automata.

Three automata are composed lazily, arc by arc: the acceptor of a conversation's rows, the edit transducer (keep, rerole, delete, insert; EDITS has their costs) and
the acceptor of the role grammar `(s?(ua)+)?` (GRAMMAR). A state of the composition is a place between rows and a state of the grammar; insertions stay at a place.
Weights are (cost, string of labels), compared in this order. Distances to the end are taken place by place from the last one back (topological order; at
one place two insertions suffice); the least labels among the cheapest paths are then read from the front: the grammar is deterministic, so at each state the least
label on a cheapest path leads to one state, and comparing whole label strings comes to comparing their first difference.

Rows are dealt by ranges of (conversation, turn), so that a conversation of any length spreads over ranges: each range's piece of it gives a 4 x 4 matrix of costs
from grammar state to grammar state, matrices give the distances at the borders, and each piece is walked by itself. Almost all conversations are one piece.

Defined results: nulls are one space, in the key of a damage too; a row with an empty role has no initial and can't be kept; rows of one turn follow role, then text; a row without conv_id belongs to one conversation; empty and
long texts are whole; an empty table gives an empty result; other columns are left out. The digest of a repaired conversation is taken in one stream with fixed memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import table, trimmed, written

#: Role grammar: state -> {initial: next state}. 0: nothing yet, 1: after s, 2: after u, 3: after a.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
#: Edit transducer: label -> cost; a kept or reroled row that is cut off costs TRUNCATED more.
EDITS = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
ROLES = {"u": "user", "a": "assistant"}
#: Faults of a row; blank and duplicate rows must go.
NONE, BLANK, DUPLICATE, CUT_OFF = range(4)
_FAR = 1 << 60
#: What an insertion or a new role can be in each state of the grammar.
_MADE = tuple(next(i for i in arcs if i in ROLES) for arcs in GRAMMAR)
_SPACE = r"\x20\x09-\x0D"
_EDITED = "conv_id bigint, part int, pos bigint, initial string, fault int, illegal int, edit string, role_to string, before string, after string, cost bigint, audit string"


def arcs(state: int, row: tuple[str, int] | None) -> Iterator[tuple[str, int, int, bool]]:
    """Arcs (label, cost, next state, takes the row) of the composition at a place whose next row is (initial, fault), in the labels' order."""
    if row is not None:
        yield "D", EDITS["D"], state, True
    yield "I", EDITS["I"], GRAMMAR[state][_MADE[state]], False
    if row is not None and row[1] not in (BLANK, DUPLICATE):
        extra = TRUNCATED if row[1] == CUT_OFF else 0
        if row[0] in GRAMMAR[state]:
            yield "K", EDITS["K"] + extra, GRAMMAR[state][row[0]], True
        yield "R", EDITS["R"] + extra, GRAMMAR[state][_MADE[state]], True


def _closed(costs: list[int]) -> list[int]:
    """Costs at a place, insertions there included."""
    for _ in range(2):
        costs = [min(c, EDITS["I"] + costs[GRAMMAR[g][_MADE[g]]]) for g, c in enumerate(costs)]
    return costs


END = _closed([0 if g in FINAL else _FAR for g in range(len(GRAMMAR))])


def distances(rows: list[tuple[str, int]], end: list[int]) -> list[list[int]]:
    """Cost from each place and state to the end, given the costs from the place after the last row on."""
    out = [end]
    for row in reversed(rows):
        after = out[-1]
        out.append(_closed([min(cost + after[to] for _, cost, to, takes in arcs(g, row) if takes) for g in range(len(GRAMMAR))]))
    return out[::-1]


def walk(rows: list[tuple[str, int]], far: list[list[int]], state: int, last: bool) -> tuple[list[tuple[str, str | None, str]], str, int]:
    """(label, new role's initial, initials inserted before) of each row, initials inserted after the last one, and the state reached."""
    out, before, i = [], "", 0
    while i < len(rows) or (last and far[i][state]):
        row = rows[i] if i < len(rows) else None
        for label, cost, to, takes in arcs(state, row):
            if far[i][state] == cost + far[i + takes][to]:
                break
        else:
            raise AssertionError("no cheapest arc")
        if takes:
            out.append((label, _MADE[state] if label == "R" else None, before))
            before, i = "", i + 1
        else:
            before += _MADE[state]
        state = to
    return out, before, state


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that a fixed hash of each row's key leaves, empties, cuts, repeats or gives another role."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), d.alias("d")).where("d <> 0")
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("d") == 3, 2).otherwise(1).alias("n"))
    return rows.withColumn("n", F.explode(F.sequence(F.lit(1), "n"))).drop("n")


def ordered(rows: DataFrame) -> DataFrame:
    """rows with part (range of conversation and turn) and pos (place in the order of all rows), written."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, part, pos, initial, fault of ordered rows: the first of blank, duplicate (role and text seen earlier) and truncated."""
    firsts = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    blank, whole = ~F.col("text").rlike(f"[^{_SPACE}]"), F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")
    seen = rows.select("conv_id", "turn", "part", "pos", F.left("role", F.lit(1)).alias("initial"), blank.alias("blank"), whole.alias("whole")).join(firsts.hint("merge"), "pos", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(~F.col("whole"), CUT_OFF).otherwise(NONE)
    return seen.select("conv_id", "turn", "part", "pos", "initial", fault.alias("fault"))


def _rows(piece: pd.DataFrame) -> list[tuple[str, int]]:
    return list(zip(piece["initial"], piece["fault"].astype(int), strict=True))


def _matrix(piece: pd.DataFrame) -> pd.DataFrame:
    rows, n = _rows(piece.sort_values("pos")), len(GRAMMAR)
    to = [distances(rows, [0 if g == h else _FAR for g in range(n)])[0] for h in range(n)]
    return pd.DataFrame({"conv_id": piece["conv_id"].iloc[:1], "part": piece["part"].iloc[:1], "costs": [[to[h][g] for g in range(n) for h in range(n)]]})


def _ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """The costs from the end of each piece on."""
    pieces, n, end, out = pieces.sort_values("part", ascending=False), len(GRAMMAR), list(END), []
    for costs in pieces["costs"]:
        out.append(end)
        end = _closed([min(int(costs[g * n + h]) + end[h] for h in range(n)) for g in range(n)])
    return pd.DataFrame({"conv_id": pieces["conv_id"], "part": pieces["part"], "ends": out, "last": [i == 0 for i in range(len(out))]})


def _reached(piece: pd.DataFrame) -> pd.DataFrame:
    """The state at the end of a piece from each state at its start."""
    piece = piece.sort_values("pos")
    rows, end, last = _rows(piece), [int(x) for x in piece["ends"].iloc[0]], bool(piece["last"].iloc[0])
    far = distances(rows, end)
    states = [walk(rows, far, g, last)[2] if far[0][g] < _FAR else g for g in range(len(GRAMMAR))]
    return pd.DataFrame({"conv_id": piece["conv_id"].iloc[:1], "part": piece["part"].iloc[:1], "ends": [end], "last": [last], "states": [states]})


def _starts(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces, state, out = pieces.sort_values("part"), 0, []
    for states in pieces["states"]:
        out.append(state)
        state = int(states[state])
    return pieces[["conv_id", "part", "ends", "last"]].assign(start=out)


def borders(rows: DataFrame) -> DataFrame:
    """conv_id, part, ends, last, start of each piece of the conversations in several parts; a few rows a part."""
    spread = rows.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(F.col("conv_id").alias("of"))
    mine = written(rows.join(F.broadcast(spread), F.col("conv_id").eqNullSafe(F.col("of")), "left_semi"), "spread")
    costs = mine.groupBy("conv_id", "part").applyInPandas(_matrix, "conv_id bigint, part int, costs array<bigint>")
    ends = written(costs.groupBy("conv_id").applyInPandas(_ends, "conv_id bigint, part int, ends array<bigint>, last boolean"), "ends")
    known = mine.join(F.broadcast(ends.select(F.col("conv_id").alias("of"), F.col("part").alias("p"), "ends", "last")), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("p"))).drop("of", "p")
    states = known.groupBy("conv_id", "part").applyInPandas(_reached, "conv_id bigint, part int, ends array<bigint>, last boolean, states array<int>")
    return written(states.groupBy("conv_id").applyInPandas(_starts, "conv_id bigint, part int, ends array<bigint>, last boolean, start int"), "borders")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one conversation and part after the other."""
    kept: list[pd.DataFrame] = []
    for rows in batches:
        if not len(rows):
            continue
        new = (rows["conv_id"].fillna(-1).ne(rows["conv_id"].fillna(-1).shift()) | rows["conv_id"].isna().ne(rows["conv_id"].isna().shift()) | rows["part"].ne(rows["part"].shift())).to_numpy()
        starts = [i for i in range(1, len(rows)) if new[i]]
        cuts = [0, *starts, len(rows)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            piece = rows.iloc[a:b]
            if kept and _key(kept[0]) != _key(piece):
                yield pd.concat(kept) if len(kept) > 1 else kept[0]
                kept = []
            kept.append(piece)
    if kept:
        yield pd.concat(kept) if len(kept) > 1 else kept[0]


def _key(piece: pd.DataFrame):
    conv = piece["conv_id"].iloc[0]
    return (None if pd.isna(conv) else int(conv)), int(piece["part"].iloc[0])


@trimmed
def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    waiting, n = [], 0
    for piece in _pieces(batches):
        rows, first = _rows(piece), piece.iloc[0]
        split = not pd.isna(first["start"])
        state, end, last = (int(first["start"]), [int(x) for x in first["ends"]], bool(first["last"])) if split else (0, list(END), True)
        labels, after, _ = walk(rows, distances(rows, end), state, last)
        audit = "".join("I" * len(b) + e for e, _, b in labels) + "I" * len(after)
        initials = [i for i, _ in rows]
        (conv, part), most = _key(piece), len(rows) - 1
        for k, ((edit, to, before), pos, (initial, fault)) in enumerate(zip(labels, piece["pos"], rows, strict=True)):
            illegal = int(k > 0 and initials[k - 1] + initial not in ("su", "ua", "au"))
            cost = EDITS[edit] + EDITS["I"] * (len(before) + (len(after) if k == most else 0)) + (TRUNCATED if fault == CUT_OFF and edit != "D" else 0)
            waiting.append((conv, part, pos, initial, fault, illegal, edit, to and ROLES[to], before, after if k == most else "", cost, audit if k == most else None))
        n += len(rows)
        if n >= 10_000:
            yield _frame(waiting)
            waiting, n = [], 0
    if waiting:
        yield _frame(waiting)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _EDITED.split(", ")])
    return out.astype({"conv_id": "Int64"})


def edits(rows: DataFrame) -> DataFrame:
    """_EDITED: what happens to each of the rows of faults(), written; `audit` stands at the last row of a piece."""
    rows = written(rows, "faults")
    split = borders(rows).select(F.col("conv_id").alias("of"), F.col("part").alias("p"), "ends", "last", "start")
    known = rows.join(F.broadcast(split), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("p")), "left").drop("of", "p", "turn")
    return written(known.repartition("part").sortWithinPartitions("pos").mapInPandas(_edited, _EDITED), "edits")


def repaired(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """conv_id, pos, lines: what stands in place of each row, as texts `role:text`; rows that leave nothing are left out."""
    made = lambda c: F.transform(F.filter(F.split(c, ""), lambda i: i != ""), lambda i: F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), i), F.lit(":")))
    own = F.when(F.col("edit") != "D", F.array(F.concat(F.coalesce("role_to", "role"), F.lit(":"), "text"))).otherwise(F.array().cast("array<string>"))
    both = rows.select("conv_id", "pos", "role", "text").join(edited.select("pos", "edit", "role_to", "before", "after"), "pos")
    return both.select("conv_id", "pos", F.concat(made("before"), own, made("after")).alias("lines")).where("size(lines) > 0")


@trimmed
def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    at, found = None, None
    for rows in batches:
        done = []
        for conv, lines in zip(rows["conv_id"], rows["lines"], strict=True):
            conv = None if pd.isna(conv) else int(conv)
            if found is None or conv != at:
                if found is not None:
                    done.append((at, found.hexdigest()))
                at, found, first = conv, hashlib.sha256(), True
            for line in lines:
                found.update((line if first else "\n" + line).encode())
                first = False
        yield pd.DataFrame(done, columns=["conv_id", "digest"]).astype({"conv_id": "Int64"})
    if found is not None:
        yield pd.DataFrame([(at, found.hexdigest())], columns=["conv_id", "digest"]).astype({"conv_id": "Int64"})


def digests(lines: DataFrame) -> DataFrame:
    """conv_id, digest: SHA-256 of the conversation's lines, joined by newlines, in order."""
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInPandas(_digests, "conv_id bigint, digest string")


def audits(conversations: DataFrame, rows: DataFrame, edited: DataFrame) -> DataFrame:
    """Every conversation with gaps, blank, duplicate, truncated, illegal, cost, audit."""
    count = lambda f: F.sum(F.when(F.col("fault") == f, 1).otherwise(0))
    pieces = edited.groupBy("conv_id", "part").agg(
        count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT_OFF).alias("truncated"), F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.max("audit").alias("audit"), F.min_by("initial", "pos").alias("head"), F.max_by("initial", "pos").alias("tail"),
    )
    ends = F.array_sort(F.collect_list(F.struct("part", "audit", "head", "tail"))).alias("ends")  # a few for each part
    whole = pieces.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], ends)
    pairs = F.transform(F.sequence(F.lit(1), F.size("ends") - 1), lambda i: F.concat(F.get("ends", i - 1)["tail"], F.get("ends", i)["head"]))
    wrong = F.when(F.size("ends") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    whole = whole.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + wrong).alias("illegal"), "cost", F.array_join(F.transform("ends", lambda e: e["audit"]), "").alias("audit"))
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    return conversations.select("conv_id").distinct().unionByName(whole, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = ordered(damaged(conversations))
    edited = edits(faults(rows))
    found = audits(conversations, rows, edited).unionByName(digests(repaired(rows, edited)), allowMissingColumns=True)
    number = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    nothing = hashlib.sha256(b"").hexdigest()
    return found.groupBy("conv_id").agg(
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("digest"), F.lit(nothing)).alias("repaired_sha256")
    )
