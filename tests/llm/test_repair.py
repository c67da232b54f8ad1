"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from lodestrata.llm import repair as R

COLUMNS = "conv_id long, turn long, role string, text string, extra string, conv string, part int"
SPACES = " \t\n\x0b\x0c\r"


def fits(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def plain_edits(rows):
    """Least cost, then ASCII-least edits of (code, role initial) rows: every prefix by its initials, no states, no tree."""
    forms = {"": (0, "")}

    def inserted(known):
        out = dict(known)
        for _ in range(3):
            for s, (c, e) in list(out.items()):
                for x in "ua":
                    new = (c + 5, e + "I")
                    if s + x not in out or new < out[s + x]:
                        out[s + x] = new
        return out

    for code, initial in rows:
        following = {}

        def offer(s, c, e, following=following):
            if s not in following or (c, e) < following[s]:
                following[s] = (c, e)

        for s, (c, e) in inserted(forms).items():
            offer(s, c + 2, e + "D")
            if code != "gone":
                more = 5 if code == "truncated" else 0
                if initial:  # an empty role has none, so it can't stay
                    offer(s + initial, c + more, e + "K")
                for x in "ua":
                    offer(s + x, c + 1 + more, e + "R")
        forms = {s: v for s, v in following.items() if fits(s) or any(fits(s + t) for t in ("a", "ua"))}
    return min(v for s, v in inserted(forms).items() if fits(s))


def plain(table):
    """The contract, row by row."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r[:4] for r in table if r[0] == conv):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, coded, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            body = text.strip(SPACES)
            code = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "fine"
            seen.add((role, text))
            if code in counts:
                counts[code] += 1
            coded.append((code if code in ("truncated", "fine") else "gone", role[:1]))
        turns = {r[0] for r in rows if r[0] is not None}
        cost, edits = plain_edits(coded)
        left, at, kept = [], 0, ""
        for e in edits:
            if e in "KRI":
                role = rows[at][1] if e == "K" else "assistant" if kept.endswith("u") else "user"
                left.append(f"{role}:{'' if e == 'I' else rows[at][2]}")
                kept += role[:1]
            at += e != "I"
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *counts.values(),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost,
            edits,
            hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


def made(n, seed, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["So it is.", "Why?", "no end", "  ", "", None, f"Part {rng.randint(0, 4)}!", f"open {turn} \t", "é\x1c"])
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, 2, None]), role, text, "x", "y", 1))
    return rows


def got(spark, rows):
    found = R.digests(R.repair(R.damaged(spark.createDataFrame(rows, COLUMNS).repartition(3)))).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in found}


def test_same_as_plain(spark):
    rows = made(150, 1)
    assert got(spark, rows) == plain(rows)


def test_query_on_the_given_table(spark):
    from lodestrata.llm.queries import op12_repair

    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    found = op12_repair(spark, "/root/testdata/sf0.01").collect()
    mine = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in found}
    assert mine == plain([tuple(r) for r in table])


@pytest.mark.parametrize("size", [1, 4])
def test_parts_change_nothing(spark, monkeypatch, size):
    rows = made(8, size, 20)
    expected = plain(rows)
    monkeypatch.setattr(R, "PART_ROWS", size)
    monkeypatch.setattr(R, "LEVEL", 1)
    assert got(spark, rows) == expected


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    rows = [(7, t, ["tool", "user", "assistant"][t % 3], f"Turn {t % 40}.", "", "", 0) for t in range(110)] + made(10, 3)
    monkeypatch.setattr(R, "PART_ROWS", 16)
    assert got(spark, rows) == plain(rows)


def test_other_costs_use_inserts(monkeypatch):
    monkeypatch.setattr(R, "INSERT", 1)
    monkeypatch.setattr(R, "DELETE", 4)
    R.options.cache_clear()
    assert R.solve("sua") == (0, "KKK") and R.solve("uu") == (1, "KR") and R.solve("s") == (2, "IR")
    cost, edits = R.solve("uua")
    assert (cost, edits) == (1, "KIKK")
    monkeypatch.undo()
    R.options.cache_clear()


def test_survivors_emit_and_free():
    run = R.Survivors(R.EMPTY)
    for code in "ua" * 500:
        run.step(R.options(code))
        if R.ANSWERED in run.heads:
            most = run.heads[R.ANSWERED][0] + R.DELETE
            run.drop([s for s, (cost, _) in run.heads.items() if cost > most])
    assert len(run.emitted) > 990 and "".join(x for x, _ in run.path(R.ANSWERED)) == "K" * 1000


def test_long_tie_is_settled_by_whole_paths():
    # every row can be reroled: which one goes is open until the end, and the first is least
    assert R.solve("x" * 301) == (302, "D" + "R" * 300)


def test_parts_agree_with_whole():
    rng = random.Random(5)
    for _ in range(200):
        codes = "".join(rng.choices("suaxSUAXbd", k=rng.randint(0, 30)))
        ends = R.between(codes, R.EMPTY)
        least = min((c + 5 * R.last_inserts(s), e + "I" * R.last_inserts(s)) for s, (c, e) in ends.items())
        assert R.solve(codes) == least


def test_empty_and_odd(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert R.digests(R.repair(R.damaged(empty))).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "All of it.", "", "", 0)]
    assert got(spark, rows) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    long = [(3, 1, "user", "w " * 150_000 + ".", "", "", 0), (3, 2, "assistant", "So.", "", "", 0)]
    assert got(spark, long) == plain(long)
