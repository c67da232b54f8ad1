"""Files, snapshots, debates and streams on hand-made fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import fx, training
from lodestrata.plans.texts import dictionary
from lodestrata.sources import debates, tables
from lodestrata.sources.scratch import kept, release, scratch
from lodestrata.streaming import debates as streaming

ONE = """<publicwhip><major-heading id="a">Energy</major-heading><minor-heading id="b">Heat</minor-heading>
<speech id="s1" speakername="Ann" person_id="p1"><p>the first<br/>ing line</p></speech>
<major-heading id="c">Energy</major-heading><speech id="s2"><p>de la two</p></speech></publicwhip>"""
BROKEN = '<publicwhip><speech id="s3"><p>kept</p></speech><speech id="s4"><p>lost'


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "debates2020-01-02a.xml").write_text(ONE)
    (tmp_path / "debates2021-03-04b.xml").write_text(BROKEN)
    return tmp_path


def test_parse(spark, folder):
    got = {r["speech_id"]: r for r in debates.parse_debates(spark, str(folder)).collect()}
    assert set(got) == {"s1", "s2", "s3"}
    assert got["s1"]["speech"] == "the first ing line" and got["s1"]["minor_heading"] == "Heat" and got["s1"]["speaker_id"] == "NA"
    assert got["s2"]["minor_heading"] is None and got["s2"]["year"] == "2020" and got["s2"]["person_id"] == "NA"
    strict = {r["speech_id"]: r for r in debates.parse_debates(spark, str(folder), strict=True).collect()}
    assert set(strict) == {"s1", "s2"} and strict["s2"]["minor_heading"] == "Heat"


def test_stream_equals_batch(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    words = dictionary(spark)

    def run():
        query = streaming.stream_enrich(streaming.stream_debates(spark, str(folder)), words, f"{out}/stores", f"{out}/check")
        assert query.awaitTermination(120)

    run()
    (folder / "debates2022-05-06c.xml").write_text(ONE.replace("de la two", "de la three"))
    run()
    streaming.full_rebuild(spark, str(folder), words, f"{out}/full")
    for store, cols in (("debates", ["speech_id"]), ("keyword_labels", ["id", "mission_labels", "topic_labels"])):
        a, b = (streaming.read_store(spark, f"{out}/{x}/{store}").select(*cols) for x in ("stores", "full"))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0
    said = {r["speech_id"]: r["speech"] for r in streaming.read_store(spark, f"{out}/stores/debates").collect()}
    assert said["s2"] == "de la three"


def test_snapshots(spark, tmp_path):
    for day in ("2024-01-30", "2024-02-06", "2024-02-05"):
        spark.range(3).withColumn("day", F.lit(day)).write.parquet(f"{tmp_path}/Crunchbase_{day}/organizations.parquet")
    (tmp_path / "Crunchbase_bad").mkdir()
    root = str(tmp_path)
    assert tables.read_snapshot(spark, root, "Crunchbase", "organizations").first()["day"] == "2024-02-06"
    assert tables.read_snapshot(spark, root, "Crunchbase", "organizations", "2024-01-30").first()["day"] == "2024-01-30"
    assert tables.catalog(spark, root, "Crunchbase") == ["organizations"]
    with pytest.raises(ValueError):
        tables.read_snapshot(spark, root, "GtR", "projects")
    with pytest.raises(ValueError):
        tables.read_snapshot(spark, root, "Crunchbase", "organizations", use_latest=False)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    for suffix in ("csv", "parquet", "json"):
        tables.write_table(df, f"{tmp_path}/t.{suffix}")
    assert tables.read_table(spark, f"{tmp_path}/t.csv").count() == tables.read_table(spark, f"{tmp_path}/t.parquet").count() == 2
    with pytest.raises(NotImplementedError):
        tables.read_table(spark, "x.xlsx")
    schema = "id string, label string"
    store = f"{tmp_path}/store.parquet"
    assert tables.read_label_store(spark, store, schema).count() == 0
    tables.append_or_create(spark.createDataFrame([("1", "x")], schema), store)
    tables.append_or_create(spark.createDataFrame([("2", "y")], schema), store)
    assert tables.read_label_store(spark, store, schema).count() == 2
    tables.reset_label_store(spark, store, schema)
    assert tables.read_label_store(spark, store, schema).count() == 0
    good, bad = tables.validate_geojson(spark.createDataFrame([("Point",), ("Blob",), (None,)], "type string"))
    assert (good.count(), bad.count()) == (1, 2)
    paths = spark.createDataFrame([("/x/a.json",), ("/y/b.csv",), ("/z/b.txt",)], "path string")
    assert tables.resolve_file(paths, "a") == "/x/a.json"
    with pytest.raises(ValueError):
        tables.resolve_file(paths, "b")
    with pytest.raises(FileNotFoundError):
        tables.resolve_file(paths, "c")


def test_release(spark):
    release(spark)
    rows = kept(spark.range(5))
    other = scratch(spark, "never")
    path = rows.inputFiles()[0].rsplit("/", 1)[0]
    assert rows.count() == 5 and tables.exists(spark, path) and not tables.exists(spark, other)
    assert release(spark) == 1 and not tables.exists(spark, path) and release(spark) == 0


def test_currency(spark):
    day = datetime.date
    rates = spark.createDataFrame(
        [("GBP", day(2000, 1, 1), 1.0), ("GBP", day(2000, 1, 11), 2.0), ("USD", day(2000, 1, 1), 4.0), ("USD", day(2000, 1, 11), 4.0)],
        "currency string, rate_date date, units_per_eur double",
    )
    rows = [
        (1, day(2000, 1, 6), 8.0, "USD"), (2, day(2030, 1, 1), 8.0, "USD"), (3, day(1999, 1, 1), 8.0, "USD"),
        (4, day(1998, 1, 1), 8.0, "GBP"), (5, day(2000, 1, 6), 8.0, "XXX"), (6, None, 8.0, "USD"),
    ]
    df = spark.createDataFrame(rows, "id int, d date, amount double, cur string")
    got = {r["id"]: r["amount_gbp"] for r in fx.convert_currency(df, rates, "d", "amount", "cur").collect()}
    assert got == {1: 3.0, 2: 4.0, 3: None, 4: 8.0, 5: None, 6: None}


def test_upsert_and_split(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "id string, v int, pos int")
    new = spark.createDataFrame([("a", 2, 0), ("a", 3, 1), (None, 9, 2)], "id string, v int, pos int")
    assert {r["id"]: r["v"] for r in training.upsert(old, new).collect()} == {"a": 3, "b": 1, None: 9}
    rows = spark.range(101)
    for approx in (False, True):
        a, b = training.train_val_split(rows, 3, approx=approx)
        assert a.union(b).distinct().count() == a.count() + b.count() == 101
    texts = spark.createDataFrame([("k", "zz"), ("k", "aaaa")], "id string, text string")
    assert training.longest_per_key(texts).first()["text"] == "aaaa"
    assert training.longest_per_key(texts, by="lexicographic").first()["text"] == "zz"
    with pytest.raises(ValueError):
        training.negative_sample(texts, 5, 1)


def test_faulty_files_are_told(spark):
    rows = [("a", ONE.encode()), ("b", b"<x><speech id='1'>one</speech><speech>"), ("c", b""), ("d", None), ("e", b"<x><speech>1</speech></y>"), ("b", b"<")]
    files = spark.createDataFrame(rows, "path string, content binary").withColumn("pos", F.lit(1)).withColumn("fault", F.lit("x"))
    got = sorted((r.path, r.rows_kept, bool(r.fault)) for r in debates.faulty_files(files).collect())
    assert got == [("b", 0, True), ("b", 1, True), ("c", 0, True), ("d", 0, True), ("e", 1, True)]
    assert debates.parse_files(files).filter("path <> 'a'").count() == 2 and debates.faulty_files(files.limit(0)).count() == 0
