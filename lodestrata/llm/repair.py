"""Cheapest repair of a conversation's turns by a Viterbi pass over the roles seen so far.

States: nothing kept, a system turn, a user turn waiting for its answer, an answered
turn.  Rows are dealt by ranges of (conversation, turn, role, text), so a
conversation of any size is spread over tasks, each of which cuts its run of a conversation into
parts of bounded size.  A conversation that is one part is solved there.  Of others
each part gives its least costs between all states and the order of these paths; the
same survivors then run over parts instead of rows, first in a task's range, then over ranges,
until one choice for each conversation is left and handed back down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import _common as common
from .survivors import Survivors

#: Rows and bytes of a part.
PART_ROWS, PART_BYTES = 256, 4 << 20
#: Costs of the edits; an undeleted truncated turn costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
EMPTY, SYSTEM, USER, ANSWERED = range(4)
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
#: Bits of a part's number that count inside a task, and by which each further level gathers tasks.
INSIDE, LEVEL = 32, 10


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of conversations after the contract's damage; ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text = _or_space("text")
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_or_space("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _after(state: int) -> int:
    """The state that a user or assistant turn leads to, whichever may stand there."""
    return ANSWERED if state == USER else USER


@cache
def options(code: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, edits) of a row: the least, then ASCII-least edits between two states.

    ``code``: b blank and d duplicate (both must go), else the role's initial (x for another), in capitals if truncated.
    """
    best = {}

    def offer(*option) -> None:
        source, to, cost, edits = option
        if (source, to) not in best or (cost, edits) < best[source, to][2:]:
            best[source, to] = option

    role, more = code.lower(), TRUNCATED if code.isupper() else 0
    for source in range(4):
        state = source
        for inserts in range(3):
            spent, edits = inserts * INSERT, "I" * inserts
            offer(source, state, spent + DELETE, edits + "D")
            if role not in "bd":
                offer(source, _after(state), spent + REROLE + more, edits + "R")
                if role == "s" and state == EMPTY:
                    offer(source, SYSTEM, spent + more, edits + "K")
                if role == ("a" if state == USER else "u"):
                    offer(source, _after(state), spent + more, edits + "K")
            state = _after(state)
    return tuple(best.values())


def last_inserts(state: int) -> int:
    """Turns to add behind the last row, so that it ends answered or empty."""
    return {EMPTY: 0, SYSTEM: 2, USER: 1, ANSWERED: 0}[state]


def _choose(run: Survivors) -> int:
    """The state to end in: the least cost with its last turns added, ties to the ASCII-least edits."""
    best = None
    for state, (cost, node) in run.heads.items():
        total, edits = cost + INSERT * last_inserts(state), "I" * last_inserts(state)
        if best is None or total < best[0] or (total == best[0] and run.less(node, edits, best[1], best[2])):
            best = (total, node, edits, state)
    return best[3]


def solve(codes: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation.

    A survivor is given up once it costs more than the answered one and a deletion: from there whatever it
    does could follow after deleting the one turn that doesn't fit.
    """
    run = Survivors(EMPTY)
    for code in codes:
        run.step(options(code))
        if ANSWERED in run.heads:
            most = run.heads[ANSWERED][0] + DELETE
            if late := [s for s, (cost, _) in run.heads.items() if cost > most]:
                run.drop(late)
    state = _choose(run)
    edits = "".join(label for label, _ in run.path(state))
    return run.heads[state][0] + INSERT * last_inserts(state), edits + "I" * last_inserts(state)


def between(codes: str, start: int) -> dict[int, tuple[int, str]]:
    """State -> least cost and edits of a part from ``start`` to it."""
    run = Survivors(start)
    for code in codes:
        run.step(options(code))
    return {s: (cost, "".join(label for label, _ in run.path(s))) for s, (cost, _) in run.heads.items()}


def _ranked(paths: dict[tuple[int, int], tuple]) -> tuple[list[int | None], list[int | None]]:
    """Costs by 4 * from + to, and each path's place among all of them."""
    order = {p: i for i, p in enumerate(sorted({p for _, p in paths.values()}))}
    cost, rank = [None] * 16, [None] * 16
    for (a, b), (c, p) in paths.items():
        cost[4 * a + b], rank[4 * a + b] = c, order[p]
    return cost, rank


def rewritten(edits: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """(role, text) of the turns that are left after ``edits``."""
    out, at = [], 0
    for edit in edits:
        if edit == "I":
            out.append(("assistant" if state == USER else "user", ""))
            state = _after(state)
            continue
        if edit == "R":
            out.append(("assistant" if state == USER else "user", texts[at]))
            state = _after(state)
        elif edit == "K":
            out.append((roles[at], texts[at]))
            state = SYSTEM if roles[at][:1] == "s" else _after(state)
        at += 1
    return out


class _Part:
    """What a part's rows are, as they come."""

    def __init__(self):
        self.codes, self.roles, self.texts, self.keys, self.seen = [], [], [], [], set()
        self.first = self.last = self.head = self.tail = None
        self.gaps = self.illegal = self.held = 0

    def add(self, turn: int | None, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            if turn is not None:
                self.gaps += max(turn - self.last - 1, 0) if self.last is not None else 0
                self.first, self.last = turn if self.first is None else self.first, turn
            initial = role[:1]
            if self.tail is not None:
                self.illegal += self.tail + initial not in LEGAL
            self.head, self.tail = initial if self.head is None else self.head, initial
            body = text.rstrip(SPACE)
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            if not body:
                code = "b"
            elif key in self.seen:
                code = "d"
            else:
                code = initial if initial and initial in "sua" else "x"
                code = code if body[-1] in ".!?" else code.upper()
            self.seen.add(key)
            self.codes.append(code)
            self.roles.append(role)
            self.texts.append("" if code in "bd" else text)
            self.keys.append(b"" if code in "bd" else key)
            self.held += len(self.texts[-1])

    def full(self) -> bool:
        return len(self.codes) >= PART_ROWS or self.held >= PART_BYTES


PARTS = "conv string, part long, alone boolean, codes string, roles array<string>, texts array<string>, keys array<binary>, gaps long, illegal long, first long, last long, head string, tail string"


def parts(rows: DataFrame) -> DataFrame:
    """Rows in order, gathered in parts; ``part`` rises with the order and is unique."""
    kind = rows.schema["conv_id"]
    ordered = rows.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("int").alias("copies"),
        F.monotonically_increasing_id().alias("nth"),  # equal rows may lie in several ranges
    )
    keys = ["conv", F.asc_nulls_first("turn"), "role", "text", "nth"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = StructType([kind, *StructType.fromDDL(PARTS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, base, n = to_arrow_schema(schema), TaskContext.get().partitionId() << INSIDE, 0
        done, part, now, nth, begun_here = [], None, None, 0, False

        def close(alone: bool) -> None:
            nonlocal n
            p = part
            done.append(
                (now[0], now[1], base + n, alone, "".join(p.codes), p.roles, p.texts, [] if alone else p.keys, p.gaps, p.illegal, p.first, p.last, p.head, p.tail)
            )
            n += 1

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        held = 0
        for batch in batches:
            for conv_id, conv, turn, role, text, copies, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[1] != conv:
                    if now is not None:
                        close(begun_here and nth == 0)
                        held += part.held
                    # a task's first conversation may have begun in an earlier range
                    begun_here, now, nth, part = now is not None, (conv_id, conv), 0, _Part()
                elif part.full():
                    close(False)
                    held += part.held
                    nth, part = nth + 1, _Part()
                part.add(turn, role, text, copies)
                if held >= PART_BYTES:
                    yield out()
                    held = 0
        if now is not None:
            close(False)  # the last may go on in the next range
        if done:
            yield out()

    return ordered.mapInArrow(run, schema)


FOUND = "edits string, repaired array<struct<role:string,text:string>>, blank long, duplicate long, truncated long, cost long"


def _finish(rows: DataFrame, whole: bool) -> DataFrame:
    """Edits and repaired turns of parts; those that are not whole conversations have ``start``, ``end``, ``added`` and ``late``."""
    kept = [f for f in rows.schema.fields if f.name in ("conv_id", "conv", "part", "alone", "gaps", "illegal")]
    schema = StructType([*kept, *StructType.fromDDL(FOUND).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                codes, start = row["codes"], EMPTY
                if whole:
                    cost, edits = solve(codes)
                else:
                    codes, start = _marked(codes, row["late"]), row["start"]
                    cost, edits = between(codes, start)[row["end"]]
                    cost, edits = cost + INSERT * row["added"], edits + "I" * row["added"]
                turns = rewritten(edits, row["roles"], row["texts"], start)
                counts = codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes), cost
                out.append((*(row[f.name] for f in kept), edits, [{"role": r, "text": t} for r, t in turns], *counts))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)


def _marked(codes: str, late: list[int] | None) -> str:
    """``codes`` with the rows that an earlier part already has as duplicates."""
    gone = set(late or [])
    return "".join("d" if i in gone else c for i, c in enumerate(codes))


NODE = "conv string, id long, task long, cost array<long>, rank array<int>, gaps long, illegal long, first long, last long, head string, tail string"


def _sums(pdf: pd.DataFrame) -> tuple:
    """gaps, illegal, first, last, head, tail of consecutive parts, the borders between them included."""
    gaps = illegal = 0
    first = last = head = tail = None
    for g, i, f, la, h, t in pdf[["gaps", "illegal", "first", "last", "head", "tail"]].astype(object).itertuples(index=False, name=None):
        gaps, illegal = gaps + g, illegal + i
        if not pd.isna(f):
            gaps += max(int(f) - last - 1, 0) if last is not None else 0
            first, last = int(f) if first is None else first, int(la)
        if h is not None:
            illegal += int(tail is not None and tail + h not in LEGAL)
            head, tail = h if head is None else head, t
    return gaps, illegal, first, last, head, tail


def _level(nodes: DataFrame, shift: int) -> DataFrame:
    """Nodes of one conversation whose tasks agree beyond ``shift`` bits become one: its children and the way through them for each (from, to)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        paths, ways = {}, [""] * 16
        steps = [
            [(k // 4, k % 4, int(c), int(r)) for k, (c, r) in enumerate(zip(cost, rank, strict=True)) if c is not None and not pd.isna(c)]
            for cost, rank in zip(pdf["cost"], pdf["rank"], strict=True)
        ]
        for start in range(4):
            run = Survivors(start)
            for step in steps:
                run.step(step)
            for end, (cost, _) in run.heads.items():
                path = run.path(end)
                paths[start, end] = (cost, tuple(label for label, _ in path))
                ways[4 * start + end] = str(start) + "".join(str(s) for _, s in path)
        cost, rank = _ranked(paths)
        ids = pdf["id"].tolist()
        row = (pdf["conv"].iloc[0], ids[0], int(pdf["task"].iloc[0]), cost, rank, *_sums(pdf), ids, ways)
        return pd.DataFrame([row], columns=[c.split()[0] for c in NODE.split(", ")] + ["children", "ways"]).astype({"first": "Int64", "last": "Int64"})

    grouped = nodes.withColumn("_key", F.shiftright("task", shift)).groupBy("conv", "_key")
    return grouped.applyInPandas(lambda pdf: run(pdf.drop(columns="_key", errors="ignore")), f"{NODE}, children array<long>, ways array<string>")


def _leaves(rows: DataFrame) -> DataFrame:
    """The first nodes: costs and ranks of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, ranks = [], []
            for codes, late in zip(batch["codes"].to_pylist(), batch["late"].to_pylist(), strict=True):
                codes = _marked(codes, late)
                cost, rank = _ranked({(a, b): found for a in range(4) for b, found in between(codes, a).items()})
                costs.append(cost)
                ranks.append(rank)
            names = ["conv", "part", "gaps", "illegal", "first", "last", "head", "tail"]
            made = [batch["conv"], batch["part"], pa.array([p >> INSIDE for p in batch["part"].to_pylist()], pa.int64())]
            made += [pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32())), *(batch[c] for c in names[2:])]
            yield pa.RecordBatch.from_arrays(made, [c.split()[0] for c in NODE.split(", ")])

    return rows.mapInArrow(run, NODE)


def _top(nodes: DataFrame) -> DataFrame:
    """For each conversation's only node: from nothing to the state that ends cheapest (id, start, end, added, gaps, illegal)."""

    @F.pandas_udf("int")
    def end(cost: pd.Series, rank: pd.Series) -> pd.Series:
        def best(c, r) -> int:
            known = [(int(c[s]) + INSERT * last_inserts(s), int(r[s]), s) for s in range(4) if c[s] is not None and not pd.isna(c[s])]
            return min(known)[2]

        return pd.Series([best(c, r) for c, r in zip(cost, rank, strict=True)])

    chosen = nodes.withColumn("end", end("cost", "rank"))
    added = F.when(F.col("end") == SYSTEM, last_inserts(SYSTEM)).when(F.col("end") == USER, last_inserts(USER)).otherwise(0)
    return chosen.select("id", F.lit(EMPTY).alias("start"), "end", added.alias("added"), "gaps", "illegal")


def _down(chosen: DataFrame, nodes: DataFrame) -> DataFrame:
    """The choice for a node as choices for its children; sums stay with the first, turns added at the end with the last."""
    way = F.element_at("ways", F.col("start") * 4 + F.col("end") + 1)
    rows = chosen.join(nodes.select("id", "children", "ways"), "id").select("*", way.alias("way"), F.size("children").alias("n"))
    rows = rows.select("way", "n", "added", "gaps", "illegal", F.posexplode("children").alias("i", "id"))
    first, final = F.col("i") == 0, F.col("i") == F.col("n") - 1
    return rows.select(
        "id",
        F.expr("int(substring(way, i + 1, 1))").alias("start"),
        F.expr("int(substring(way, i + 2, 1))").alias("end"),
        F.when(final, F.col("added")).otherwise(0).alias("added"),
        F.when(first, F.col("gaps")).otherwise(0).alias("gaps"),
        F.when(first, F.col("illegal")).otherwise(0).alias("illegal"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """Repair conversations: rows of conv_id, turn, role, text and copies (0: none of it, as if it were not there).

    Rows go by turn (nulls first), ties by role and text.  Returns one row for each part of a
    conversation, in order of ``part``: conv_id, conv (its key), part, alone (the only one), gaps, illegal,
    edits (K, R, D, I), repaired (role and text of what is left), blank, duplicate, truncated, cost;
    sums over a conversation's parts are its figures, and its texts joined are the whole.
    Null roles and texts are one space, an empty role has no initial and can't be kept, null ids are one conversation; a conversation without rows gives one empty part;
    an empty table gives no rows; other columns are ignored.
    """
    dealt = common.cut(parts(rows))
    whole = _finish(dealt.filter("alone"), True)
    rest = dealt.filter("not alone")
    keys = rest.select("conv", "part", F.posexplode("keys").alias("at", "key")).filter(F.length("key") > 0)
    first = keys.groupBy("conv", "key").agg(F.min("part").alias("first_part"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    late = keys.join(first, ["conv", "key"]).filter("part > first_part").groupBy("part").agg(F.collect_list("at").alias("late"))
    late = common.cut(late)
    small = rest.select("conv", "part", "codes", "gaps", "illegal", "first", "last", "head", "tail").join(late, "part", "left")
    levels = [common.cut(_leaves(small))]
    most = levels[0].agg(F.max("task")).first()[0] or 0
    shift = 0
    while True:
        levels.append(common.cut(_level(levels[-1], shift)))
        if most >> shift == 0:
            break
        shift += LEVEL
    chosen = _top(levels[-1])
    for nodes in reversed(levels[1:]):
        chosen = _down(chosen, nodes)
    found = rest.drop("gaps", "illegal").join(common.cut(chosen).withColumnRenamed("id", "part"), "part").join(late, "part", "left")
    return whole.unionByName(_finish(found, False))


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: its figures, its edits and the SHA-256 of its repaired turns.

    A hash reads its text in order, so a conversation of several parts streams through one task, which holds one part and the edits.
    """
    body = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    rows = repaired.select("conv_id", "conv", "part", "alone", *FIGURES, F.col("edits").alias("audit"), (F.size("repaired") > 0).alias("left"), body.alias("body"))
    whole = rows.filter("alone").select("conv_id", *FIGURES, "audit", F.sha2(F.col("body").cast("binary"), 256).alias("repaired_sha256"))
    ordered = rows.filter("not alone").drop("alone").repartition("conv").sortWithinPartitions("conv", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is None or row["conv"] != conv:
                    if held is not None:
                        out.append(held)
                    conv, held = row["conv"], {"id": row["conv_id"], "sums": dict.fromkeys(FIGURES, 0), "audit": [], "hash": hashlib.sha256(), "any": False}
                for f in FIGURES:
                    held["sums"][f] += row[f]
                held["audit"].append(row["audit"])
                if row["left"]:
                    held["hash"].update((("\n" if held["any"] else "") + row["body"]).encode())
                    held["any"] = True
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([held])

    schema = whole.schema

    def batch_of(done: list[dict]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        rows = [(d["id"], *d["sums"].values(), "".join(d["audit"]), d["hash"].hexdigest()) for d in done]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return whole.unionByName(ordered.mapInArrow(run, schema))
