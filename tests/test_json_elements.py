"""Objects of JSON documents read in splits, against json.load."""

import json
import random

import pytest

from lodestrata.sources.json_elements import json_elements
from lodestrata.sources.tables import read_grant_projects, read_memberships

MARKS = ['}', '{', '"', '\\', ']', '[', ',', '\n', 'é', ' ', 'a', ':', '},{', '\\"', '"}']


def thing(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return "".join(rng.choices(MARKS, k=rng.randrange(8)))
    if kind < 4:
        return rng.choice([None, 1, -2.5, True])
    if kind == 4:
        return [thing(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(MARKS) + str(i): thing(rng, depth + 1) for i in range(rng.randrange(3))}


def member(rng, i):
    return {"id": i, "text": "".join(rng.choices(MARKS, k=rng.randrange(30))), "rest": thing(rng)}


def plain(members):
    return [(n, m["id"], None if m.get("text") is None else str(m["text"])) for n, m in enumerate(m for m in members if isinstance(m, dict))]


def read(spark, path, key):
    rows = json_elements(spark, str(path), key, "id long, text string").orderBy("pos").collect()
    assert len({r.path for r in rows}) <= 1
    return [(r.pos, r.m.id, r.m.text) for r in rows]


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "300")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_against_json_load(spark, tmp_path, splits, seed):
    rng = random.Random(seed)
    members = [member(rng, i) for i in range(60)]
    for at in (0, 9, 40):
        members.insert(at, rng.choice([None, 3, "}{", [{"id": -1}]]))
    other = {"posts": [member(rng, -5) for _ in range(5)], "meta": {"a": {"b": {}}, "c": [{"memberships": [{"id": -9}]}]}, "n": [1, 2], 'o"}': "x}"}
    document = dict(rng.sample([*other.items(), ("memberships", members)], 5))
    indent, ascii_only = rng.choice([None, 1, 4]), seed % 2 == 0
    path = tmp_path / "people.json"
    path.write_text(json.dumps(document, indent=indent, ensure_ascii=ascii_only) + rng.choice(["", "\n", " \n "]), encoding=rng.choice(["utf-8", "utf-8-sig"]))
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
    assert read(spark, path, "memberships") == plain(members)
    assert read(spark, path, "posts") == plain(document["posts"])
    assert read(spark, path, "absent") == []
    path = tmp_path / "list.json"
    path.write_text(json.dumps(members, indent=indent, ensure_ascii=ascii_only))
    assert read(spark, path, None) == plain(members)


def test_documents_cut_short(spark, tmp_path):
    text = json.dumps({"memberships": [{"id": 1, "text": "a}"}, {"id": 2, "text": "b"}], "persons": [{"id": 3}]})
    path = tmp_path / "d.json"
    for end in (1, 15, 25, 36, 43, 45, text.index("]") + 1, text.index("]") + 2, len(text) - 1):
        path.write_text(text[:end])
        with pytest.raises(ValueError, match="ends early"):
            json_elements(spark, str(path), "memberships", "id long")
    path.write_text('[{"id": 1}, ')
    with pytest.raises(ValueError, match="ends early"):
        json_elements(spark, str(path))


def test_empty_and_several(spark, tmp_path):
    for name, text in (("a", '{"memberships": []}'), ("b", '{"memberships": [{"id": "x", "pos2": {"q": 1}}, {"id": null}]}'), ("c", "{}")):
        (tmp_path / f"{name}.json").write_text(text)
    got = [(r.path[-6:], r.pos, r.id) for r in read_memberships(spark, str(tmp_path)).orderBy("pos").collect()]
    assert got == [("b.json", 0, "x"), ("b.json", 1, None)]
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "x.json").write_text("[]")
    assert read_grant_projects(spark, str(tmp_path / "list")).count() == 0
    with pytest.raises(ValueError, match="schema"):
        json_elements(spark, str(tmp_path / "list"))
    (tmp_path / "list" / "x.json").write_text('[{"abstractText": "one\\ntwo", "id": "i"}, {}]')
    assert sorted(map(tuple, read_grant_projects(spark, str(tmp_path / "list")).collect()), key=repr) == [("i", "one\ntwo"), (None, None)]


def test_no_task_holds_a_document(spark, tmp_path, splits):
    path = tmp_path / "big.json"
    path.write_text(json.dumps({"memberships": [{"id": i, "text": "t" * 40} for i in range(2000)]}))
    rows = json_elements(spark, str(path), "memberships", "id long, text string")
    assert rows.count() == 2000 and rows.selectExpr("max(m.id - pos)", "min(m.id - pos)").first() == (0, 0)
