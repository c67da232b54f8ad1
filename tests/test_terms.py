"""Terms by days, the n-th of a column, and rates against plain loops."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.discourse import first_term, speaker_party
from lodestrata.operators.training import _nth, replace_negatives

MEMBERS = "pos int, id string, person_id string, on_behalf_of_id string, start_date string, end_date string"
SPEECHES = "speech_id int, speaker_id string, person_id string, date string"


def day(n):
    return date(1960, 1, 1) + timedelta(days=n)


def test_parties_match_a_plain_search(spark):
    rng = random.Random(5)
    members = []
    for pos in range(400):
        a = rng.randint(0, 9000)
        b = a + rng.choice([-3, 0, 1, 2, 40, 700, 5000])
        members.append((pos, f"m{rng.randint(0, 300)}", rng.choice(["p1", "p2", "p3", None]), rng.choice(["x", "y", "z", None]), str(day(a)), rng.choice([str(day(b)), str(day(b)), None])))
    members.append((400, "m0", "p4", "w", "1969-12-30", "9999-12-31"))
    said = [(i, rng.choice([None, None, f"m{rng.randint(0, 350)}"]), rng.choice(["p1", "p2", "p3", "p4", "p5", None]), rng.choice([str(day(rng.randint(-5, 15000))), str(day(rng.randint(-5, 9000))), None])) for i in range(600)]
    said += said[:20]
    want = []
    for i, speaker, person, when in said:
        if speaker is not None:
            party = next((m[3] for m in reversed(members) if m[1] == speaker), None)
        else:
            held = (m[3] for m in members if None not in (person, when, m[5]) and m[2] == person and m[4] <= when <= m[5])
            party = next(held, None)
        want.append((i, party))
    extra = {"level": F.lit(1), "block": F.lit(2), "term": F.lit("t"), "party": F.lit("old"), "day": F.lit(0)}
    speeches = spark.createDataFrame(said, SPEECHES).withColumns(extra)
    got = speaker_party(speeches, spark.createDataFrame(members, MEMBERS)).select("speech_id", "party").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len({p for _, p in want}) == 5


def test_a_person_with_very_many_terms_spreads_over_blocks(spark):
    n = 100_000
    terms = spark.range(n).select(
        F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("id"), F.lit("p").alias("person_id"), F.concat(F.lit("party "), "id").alias("on_behalf_of_id"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") % 30_000).cast("int")).cast("string").alias("start_date"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") % 30_000 + F.col("id") % 7).cast("int")).cast("string").alias("end_date"),
    )
    days = spark.range(30_000).select(F.lit("p").alias("person_id"), F.date_add(F.lit(date(1900, 1, 1)), F.col("id").cast("int")).alias("day"))
    first = {}
    for i in range(n):
        for d in range(i % 30_000, i % 30_000 + i % 7 + 1):
            first.setdefault(d, i)
    got = first_term(days, terms).select(F.datediff("day", F.lit(date(1900, 1, 1))), "term.pos").collect()
    assert {d: p for d, p in got} == {d: p for d, p in first.items() if d < 30_000}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 119, 120, 500])
def test_nth(spark, n):
    values = [i * i % 37 for i in range(120)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 9, "v int").repartition(5)
    assert _nth(df, "v", n) == sorted(values)[min(n, 120) - 1]


def test_negatives_with_ties_nulls_and_empty_tables(spark):
    rows = [(1, "a", 0, 5), (2, "b", 0, 5), (3, "c", 1, 1), (4, "d", 0, 9), (5, "e", 0, None), (6, "f", None, 1), (7, "g", 1, None)]
    train = spark.createDataFrame(rows, "id int, text string, relevant int, seq int")
    extra = spark.createDataFrame([(8, "new")], "id int, text string")
    assert sorted(r.id for r in replace_negatives(train, extra).collect()) == [3, 4, 5, 6, 7, 8]
    assert sorted(r.id for r in replace_negatives(train, extra.limit(0)).collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert [r.id for r in replace_negatives(train.limit(0), extra).collect()] == [8]
