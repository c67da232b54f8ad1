"""Queries on files, stores and streams.

Each writes the given tables in the layout that the source reads, to a folder that driver
and executors share, and reads them back; the SQL says what must come.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import keywords as K
from ..operators import training as T
from ..sources import debates as X
from ..sources import stores as runs
from ..sources import tables
from ..sources.scratch import scratch
from ..streaming import debates as streaming
from .views import ORGS, load, sql

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str):
    def keep(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return keep


# --- snapshots

NEW, OLD = "2024-02-06", "2024-01-30"


def snapshots(spark, d):
    """Two dated snapshots of companies; the older one lacks the odd ids."""
    root, orgs = scratch(spark, "snapshots"), load(spark, d, ORGS)
    orgs.write.parquet(f"{root}/Crunchbase_{NEW}/organizations.parquet")
    orgs.filter("id % 2 = 0").write.parquet(f"{root}/Crunchbase_{OLD}/organizations.parquet")
    load(spark, d, "orders").selectExpr("o_orderkey AS id", "o_custkey AS org_id").write.parquet(f"{root}/Crunchbase_{NEW}/funding_rounds.parquet")
    return root


@query("A2_read_snapshot", f"SELECT id, name, 'latest' AS version FROM {sql(ORGS)} UNION ALL SELECT id, name, 'pinned' FROM {sql(ORGS)} WHERE id % 2 = 0")
def a2(spark, d):
    root = snapshots(spark, d)
    latest, pinned = (tables.read_snapshot(spark, root, "Crunchbase", "organizations", v).select("id", "name") for v in (None, OLD))
    return latest.withColumn("version", F.lit("latest")).unionByName(pinned.withColumn("version", F.lit("pinned")))


@query("A3_catalog", "SELECT c_custkey AS id, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def a3(spark, d):
    names = tables.catalog(spark, snapshots(spark, d), "Crunchbase")
    orgs, rounds = (spark.table(n) for n in sorted(names, reverse=True))
    return orgs.alias("o").join(rounds.alias("r"), F.col("r.org_id") == F.col("o.id"), "left").groupBy("o.id").agg(F.count("r.id").alias("n"))


#: What stands in for the sixteen tables of a snapshot: (id, org_id) over the given ones.
HELD = {
    "organizations": ("customer", "c_custkey AS id", "c_custkey AS org_id"),
    "organization_descriptions": ("customer", "c_custkey AS id", "c_custkey AS org_id"),
    "org_parents": ("customer", "c_custkey AS id", "c_nationkey AS org_id"),
    "funding_rounds": ("orders", "o_orderkey AS id", "o_custkey AS org_id"),
    "funds": ("orders", "o_orderkey AS id", "o_custkey % 100 AS org_id"),
    "acquisitions": ("orders", "o_orderkey AS id", "o_custkey + o_orderkey % 2 AS org_id"),
    "events": ("conversations", "conv_id AS id", "conv_id % 10 AS org_id"),
    "event_appearances": ("conversations", "conv_id AS id", "turn AS org_id"),
    "investors": ("supplier", "s_suppkey AS id", "s_suppkey AS org_id"),
    "investments": ("lineitem", "l_orderkey AS id", "l_suppkey AS org_id"),
    "ipos": ("lineitem", "l_orderkey AS id", "l_partkey AS org_id"),
    "jobs": ("lineitem", "l_partkey AS id", "l_suppkey AS org_id"),
    "people": ("documents", "doc_id AS id", "n_chars AS org_id"),
    "people_descriptions": ("documents", "doc_id AS id", "length(text) AS org_id"),
    "degrees": ("labels", "doc_id AS id", "quality AS org_id"),
    "category_groups": ("part", "p_partkey AS id", "p_size AS org_id"),
}


@query(
    "A3_catalog_all",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n, count(DISTINCT id) AS ids, count(DISTINCT org_id) AS orgs FROM {sql(v)}" for t, v in HELD.items()),
)
def a3b(spark, d):
    root = scratch(spark, "snapshot")
    for name, view in HELD.items():
        load(spark, d, view).write.parquet(f"{root}/Crunchbase_{NEW}/{name}.parquet")
    names = tables.catalog(spark, root, "Crunchbase")
    held = [spark.table(n).select(F.lit(n).alias("name"), F.col("id").cast("long").alias("id"), F.col("org_id").cast("long").alias("org_id")) for n in names]
    # ids and organisations are each made distinct before they are counted
    rows = reduce(DataFrame.unionAll, held)
    counts = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    for col, out in (("id", "ids"), ("org_id", "orgs")):
        counts = counts.join(rows.select("name", col).distinct().groupBy("name").agg(F.count(col).alias(out)), "name")
    return counts


@query("A4_read_enriched", f"SELECT id, name, mission_labels FROM {sql(ORGS)}")
def a4(spark, d):
    root = scratch(spark, "enriched")
    tables.export_parquet(load(spark, d, ORGS), f"{root}/enriched/organizations_full.parquet")
    return tables.read_enriched(spark, root, "organizations").select("id", "name", "mission_labels")


# --- files by suffix

PARTS = ("part", "p_partkey AS id", "p_name AS name", "p_retailprice AS price")


@query("A5_read_table", f"SELECT id, name, price, kind FROM {sql(PARTS)}, (VALUES ('csv'), ('parquet')) AS k(kind)")
def a5(spark, d):
    root, rows, out = scratch(spark, "tables"), load(spark, d, PARTS), []
    for kind in ("csv", "parquet"):
        tables.write_table(rows, f"{root}/t.{kind}")
        out.append(tables.read_table(spark, f"{root}/t.{kind}").select(F.col("id").cast("long").alias("id"), "name", "price", F.lit(kind).alias("kind")))
    return out[0].unionByName(out[1])


@query("A6_read_json_doc", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation")
def a6(spark, d):
    path = f"{scratch(spark, 'json')}/doc.json"
    one = load(spark, d, "nation").agg(F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))))
    one.coalesce(1).write.text(path)
    return tables.read_json_doc(spark, path).select("id", "name")


@query("A7_read_lines", "SELECT p_name AS value FROM part")
def a7(spark, d):
    path = f"{scratch(spark, 'lines')}/names.txt"
    tables.write_table(load(spark, d, "part").select("p_name"), path)
    return tables.read_lines(spark, path)


@query("A7_read_jsonl", f"SELECT CAST(id AS BIGINT) AS id, name, price FROM {sql(PARTS)}")
def a7b(spark, d):
    path = f"{scratch(spark, 'jsonl')}/parts.jsonl"
    tables.write_table(load(spark, d, PARTS), path)
    return tables.read_jsonl(spark, path).select("id", "name", "price")


@query("A8_read_text_doc", "SELECT array_to_string(list(n_name ORDER BY n_nationkey), chr(10)) || chr(10) AS value FROM nation")
def a8(spark, d):
    path = f"{scratch(spark, 'text')}/names.txt"
    names = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name")))
    load(spark, d, "nation").agg(F.array_join(F.transform(names, lambda x: x["n_name"]), "\n")).coalesce(1).write.text(path)
    return tables.read_text_doc(spark, path)


@query("A9_read_numeric_csv", "SELECT l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM lineitem")
def a9(spark, d):
    path = f"{scratch(spark, 'numbers')}/m.csv"
    load(spark, d, "lineitem").select("l_quantity", "l_extendedprice", "l_discount").write.csv(path)
    return tables.read_numeric_csv(spark, path, 3).select(*[F.col("row")[i].alias(c) for i, c in enumerate("abc")])


FILES = ("supplier", "concat('out/', s_suppkey % 7, '/', s_name, '.parquet') AS path")


@query("A10_resolve_file", f"SELECT min(path) AS path FROM {sql(FILES)} WHERE path LIKE '%' || (SELECT max(s_name) FROM supplier) || '%'")
def a10(spark, d):
    stem = load(spark, d, "supplier").agg(F.max("s_name")).first()[0]
    return spark.createDataFrame([(tables.resolve_file(load(spark, d, FILES), stem),)], "path string")


@query("A11_list_dirs", "SELECT 'event_type=' || event_type AS dir, count(*) AS n FROM events GROUP BY 1")
def a11(spark, d):
    root = scratch(spark, "events")
    load(spark, d, "events").write.partitionBy("event_type").parquet(root)
    dirs = spark.createDataFrame([(x,) for x in tables.list_dirs(spark, root)], "dir string")
    files = tables.list_files(spark, root, "*.parquet").select(F.regexp_extract("path", r"(event_type=[^/]+)", 1).alias("dir")).distinct()
    rows = spark.read.parquet(root).groupBy(F.concat(F.lit("event_type="), "event_type").alias("dir")).agg(F.count(F.lit(1)).alias("n"))
    return dirs.join(files, "dir").join(rows, "dir")


@query("A13_write_table", f"SELECT CAST(id AS BIGINT) AS id, name, kind FROM {sql(PARTS)}, (VALUES ('csv'), ('json'), ('parquet')) AS k(kind)")
def a13(spark, d):
    root, rows, out = scratch(spark, "written"), load(spark, d, PARTS), []
    for kind, read in (("csv", tables.read_table), ("json", tables.read_jsonl), ("parquet", tables.read_table)):
        tables.write_table(rows, f"{root}/t.{kind}")
        out.append(read(spark, f"{root}/t.{kind}").select(F.col("id").cast("long").alias("id"), "name", F.lit(kind).alias("kind")))
    return out[0].unionByName(out[1]).unionByName(out[2])


SHAPES = ("customer", "c_custkey AS id", "CASE c_custkey % 4 WHEN 0 THEN 'Point' WHEN 1 THEN 'Feature' WHEN 2 THEN 'Circle' END AS type")


@query("A14_validate_geojson", f"SELECT id, type, coalesce(type IN ('Point', 'Feature'), false) AS valid FROM {sql(SHAPES)}")
def a14(spark, d):
    good, bad = tables.validate_geojson(load(spark, d, SHAPES))
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))


# --- label stores

LABELS = ("supplier", "CAST(s_suppkey AS VARCHAR) AS id", "s_name AS label")
STORE = "id string, label string"


def labels(spark, d):
    return load(spark, d, ("supplier", "CAST(s_suppkey AS STRING) AS id", "s_name AS label"))


@query("A15_read_label_store", f"SELECT id, label FROM {sql(LABELS)}")
def a15(spark, d):
    root = scratch(spark, "labels")
    tables.append_or_create(labels(spark, d), f"{root}/there")
    return tables.read_label_store(spark, f"{root}/there", STORE).unionByName(tables.read_label_store(spark, f"{root}/missing", STORE))


@query("A16_reset_label_store", "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM supplier")
def a16(spark, d):
    path = f"{scratch(spark, 'reset')}/store"
    tables.append_or_create(labels(spark, d), path)
    before = tables.read_label_store(spark, path, STORE).count()
    tables.reset_label_store(spark, path, STORE)
    return tables.read_label_store(spark, path, STORE).agg(F.lit(before).cast("long").alias("before"), F.count(F.lit(1)).alias("after"))


@query("A26_append_or_create", f"SELECT id, label FROM {sql(LABELS)}")
def a26(spark, d):
    path, rows = f"{scratch(spark, 'append')}/store", labels(spark, d)
    for rest in (0, 1):
        tables.append_or_create(rows.filter(F.col("id").cast("long") % 2 == rest), path)
    return tables.read_label_store(spark, path, STORE)


@query("A26_compacted_store", "SELECT o_orderkey AS id, CAST(max(b) AS INT) AS label FROM orders, range(24) AS r(b) WHERE o_orderkey % (b + 2) = 0 GROUP BY 1")
def a26b(spark, d):
    """24 upserts, folded whenever eight folders of a size are there."""
    path, rows = f"{scratch(spark, 'compacted')}/store", load(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    for b in range(24):
        runs.append(rows.filter(F.col("id") % (b + 2) == 0).withColumn("label", F.lit(b)), path)
        runs.compact(spark, path, "id", "label", fan=8)
    return runs.read(spark, path, "id", "label")


@query("A27_exports", f"SELECT CAST(id AS BIGINT) AS id, name, kind FROM {sql(PARTS)}, (VALUES ('csv'), ('parquet')) AS k(kind)")
def a27(spark, d):
    root, rows = scratch(spark, "exports"), load(spark, d, PARTS)
    tables.export_csv(rows, f"{root}/t.csv")
    tables.export_parquet(rows, f"{root}/t.parquet")
    back = [tables.read_table(spark, f"{root}/t.{k}").select(F.col("id").cast("long").alias("id"), "name", F.lit(k).alias("kind")) for k in ("csv", "parquet")]
    return back[0].unionByName(back[1])


# --- curated tables and JSON documents


#: Objects in each JSON document that is written here.
LISTED = 50_000


def json_documents(spark, rows, opening, closing):
    """Write (at, m) rows as documents that list ``m`` in the order of ``at``, each document a range of it."""
    out, inside = scratch(spark, "documents"), Window.partitionBy("file").orderBy("at")
    lines = rows.withColumn("file", F.floor(F.col("at") / LISTED))
    before = F.when(F.lag(F.lit(1)).over(inside).isNull(), opening).otherwise(",")
    after = F.when(F.lead(F.lit(1)).over(inside).isNull(), closing).otherwise("")
    lines.select("file", F.concat(before, F.to_json("m"), after).alias("value")).write.partitionBy("file").text(out)
    return out


@query("A19_read_memberships", "SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INT) AS pos, 'm' || c_custkey AS id, 'p' || (c_custkey % 50) AS person_id FROM customer")
def a19(spark, d):
    member = F.expr("named_struct('id', concat('m', c_custkey), 'person_id', concat('p', c_custkey % 50))")
    path = json_documents(spark, load(spark, d, "customer").select(F.col("c_custkey").alias("at"), member.alias("m")), '{"posts":[{"id":"p"}],"memberships":[', '],"persons":[{"id":"x"}]}')
    found = tables.read_memberships(spark, path, "id string, person_id string").withColumn("file", F.regexp_extract("path", r"file=(\d+)", 1).cast("long"))
    # one row for each document
    sizes = found.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(sizes.select("file", before.alias("before")), "file").select((F.col("before") + F.col("pos")).cast("int").alias("pos"), "id", "person_id")


@query("A20_read_grant_projects", "SELECT p_name AS id, p_type AS text FROM part")
def a20(spark, d):
    project = F.struct(F.col("p_name").alias("id"), F.col("p_type").alias("abstractText"), "p_size")
    return tables.read_grant_projects(spark, json_documents(spark, load(spark, d, "part").select(F.col("p_partkey").alias("at"), project.alias("m")), "[", "]"))


@query("A21_read_curated", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def a21(spark, d):
    root = scratch(spark, "curated")
    tables.export_csv(load(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name"), f"{root}/investors.csv")
    return tables.read_curated(spark, root, "investors").select(F.col("id").cast("long").alias("id"), "name")


VECTORS = ("embeddings", "vec_id AS id", "label AS relevant", "embedding")


@query("A22_read_training_data", "SELECT vec_id AS id, CAST(label AS INT) AS relevant, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 5) AS first FROM embeddings")
def a22(spark, d):
    path = f"{scratch(spark, 'training')}/asf.csv"
    rows = load(spark, d, VECTORS)
    text = F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), " "), F.lit("]"))
    tables.export_csv(rows.withColumn("embedding", text), path)
    back = tables.read_training_data(spark, path)
    return back.select(
        F.col("id").cast("long").alias("id"), F.col("relevant").cast("int").alias("relevant"), F.size("embedding").cast("long").alias("n"), F.round(F.col("embedding")[0], 5).alias("first")
    )


# --- debates: conversations as sittings on 28 days, a file for every 16 of them

TURN = """(SELECT printf('debates2020-%02d-%02da%d.xml', CAST(1 + (conv_id % 28) % 3 AS INT), CAST(1 + conv_id % 28 AS INT), conv_id // 448) AS file, conv_id, turn,
 CASE WHEN role = 'assistant' THEN 'speech' WHEN turn % 4 = 0 THEN 'major-heading' ELSE 'minor-heading' END AS tag,
 'x' || conv_id || '.' || turn AS id, trim(regexp_replace(text, '[^ -~]+', ' ', 'g')) AS text FROM conversations)"""
Q_ROWS = f"(SELECT *, row_number() OVER (PARTITION BY file ORDER BY conv_id, turn) - 1 AS pos FROM {TURN})"
UPTO = "OVER (PARTITION BY file{0} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
Q_SPEECHES = f"""(SELECT id AS speech_id, substring(file, 8, 10) AS date, text AS speech, major_heading,
 last_value(CASE WHEN tag = 'minor-heading' THEN text END IGNORE NULLS) {UPTO.format(', part')} AS minor_heading, tag, file FROM
 (SELECT *, last_value(CASE WHEN tag = 'major-heading' THEN text END IGNORE NULLS) {UPTO.format('')} AS major_heading,
  sum(CAST(tag = 'major-heading' AS INT)) {UPTO.format('')} AS part FROM {Q_ROWS}))"""
Q_SPEECHES = f"(SELECT * EXCLUDE (tag) FROM {Q_SPEECHES} WHERE tag = 'speech')"
SAID = ["speech_id", "date", "speech", "major_heading", "minor_heading"]


def sittings(spark, d, root, chosen="true", torn="false"):
    """Write the debate files whose day fits ``chosen``, those of ``torn`` days without their end.

    Rows are streamed into their files in order; files are then given their names.
    """
    turns = load(spark, d, "conversations").filter(chosen)
    day = F.col("conv_id") % 28
    name = F.format_string("debates2020-%02d-%02da%d.xml", (1 + day % 3).cast("int"), (1 + day).cast("int"), F.expr("conv_id div 448"))
    tag = F.when(F.col("role") == "assistant", "speech").when(F.col("turn") % 4 == 0, "major-heading").otherwise("minor-heading")
    text = F.trim(F.regexp_replace("text", r"[^ -~]+", " "))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    element = F.format_string('<%s id="x%s.%s">%s</%s>', tag, F.col("conv_id"), F.col("turn"), text, tag)
    inside = Window.partitionBy("file").orderBy("conv_id", "turn")
    lines = turns.select(name.alias("file"), "conv_id", "turn", element.alias("xml"), F.expr(torn).alias("torn"))
    lines = lines.withColumns({"first": F.lag(F.lit(1)).over(inside).isNull(), "last": F.lead(F.lit(1)).over(inside).isNull() & ~F.col("torn")})
    body = F.concat(F.when(F.col("first"), "<publicwhip>").otherwise(""), "xml", F.when(F.col("last"), "</publicwhip>").otherwise(""))
    made = scratch(spark, "made")
    lines.select("file", body.alias("value")).write.partitionBy("file").text(made)
    fs, _ = tables._fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(root))
    for folder in tables.list_dirs(spark, made):
        part = next(s.getPath() for s in fs.listStatus(path(f"{made}/{folder}")) if s.getPath().getName().startswith("part-"))
        fs.rename(part, path(f"{root}/{folder.removeprefix('file=')}"))
    return root


@query("A18_all_debate_files", f"SELECT DISTINCT file, '2020' AS year FROM {TURN}")
def a18(spark, d):
    files = tables.files_for_year(tables.all_debate_files(spark, sittings(spark, d, scratch(spark, "debates"))), "2020")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), tables.year_of_file(F.col("path")).alias("year"))


@query("A17_incremental_files", f"SELECT DISTINCT file FROM {TURN} WHERE conv_id % 28 < 20 AND conv_id % 28 >= 5")
def a17(spark, d):
    root = sittings(spark, d, scratch(spark, "debates"))
    names = tables.all_debate_files(spark, root).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    day = F.regexp_extract("name", r"-(\d\d)a", 1).cast("int") - 1
    manifest = f"{scratch(spark, 'manifest')}/files_to_sync.log"
    names.filter(day < 20).write.text(manifest)
    return tables.incremental_files(spark, manifest, root, names.filter(day < 5)).select(F.col("name").alias("file"))


@query("A23_parse_debates", f"SELECT {', '.join(SAID)} FROM {Q_SPEECHES}")
def a23(spark, d):
    return X.parse_debates(spark, sittings(spark, d, scratch(spark, "debates"))).select(*SAID)


@query("A23_faulty_files", f"SELECT file, count(*) AS rows_kept FROM {TURN} WHERE conv_id % 28 IN (3, 11) GROUP BY file")
def a23b(spark, d):
    files = streaming.all_files(spark, sittings(spark, d, scratch(spark, "debates"), torn="conv_id % 28 IN (3, 11)"))
    return X.faulty_files(files).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "rows_kept")


@query("E3_upsert_debates", "SELECT o_orderkey AS speech_id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS speech FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def e3(spark, d):
    rows = load(spark, d, "orders").selectExpr("o_orderkey AS speech_id", "0 AS pos")
    old, new = (rows.filter(f"speech_id % {n} = 0").withColumn("speech", F.lit(s)) for n, s in ((2, "old"), (3, "new")))
    return T.upsert_debates(old, new).select("speech_id", "speech")


@query("E3_upsert_debates_reset", "SELECT o_orderkey AS speech_id FROM orders WHERE o_orderkey % 3 = 0")
def e3b(spark, d):
    rows = load(spark, d, "orders").selectExpr("o_orderkey AS speech_id", "0 AS pos")
    return T.upsert_debates(rows.filter("speech_id % 2 = 0"), rows.filter("speech_id % 3 = 0"), reset=True).select("speech_id")


SHEET = [("Heat", "the, of"), ("Heat", "heat"), ("Food", "and, in, to"), ("Food", "la"), ("General terms", "e")]


def dictionary(spark):
    return K.keyword_dictionary(spark.createDataFrame(SHEET, "Subcategory string, Keywords string"), "ASF")


def long_texts(rows):
    return rows.withColumn("asf_preds", (F.length("text") > 100).cast("int"))


def stores(spark, d):
    """A rebuild of the first days, then a stream over all, then the same stream again without new files."""
    root, out = scratch(spark, "debates"), scratch(spark, "stores")
    sittings(spark, d, root, "conv_id % 28 < 9")
    streaming.update(spark, root, dictionary(spark), out, f"{out}/check", long_texts)
    sittings(spark, d, root, "conv_id % 28 >= 9")
    for _ in range(2):
        streaming.update(spark, root, dictionary(spark), out, f"{out}/check", long_texts)
    return root, out


@query("I1_stream_debates", f"SELECT DISTINCT file FROM {TURN}")
def i1(spark, d):
    root, out = sittings(spark, d, scratch(spark, "debates")), scratch(spark, "seen")
    files = streaming.stream_debates(spark, root).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"))
    files.writeStream.format("parquet").option("path", f"{out}/files").option("checkpointLocation", f"{out}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/files")


@query("I2_stream_enrich", f"SELECT {', '.join(SAID)} FROM {Q_SPEECHES}")
def i2(spark, d):
    return streaming.read_store(spark, f"{stores(spark, d)[1]}/debates").select(*SAID)


def _holds(*terms: str) -> str:
    return "(" + " AND ".join(f"contains(speech, '{t}')" for t in terms) + ")"


@query(
    "I2_keyword_labels",
    f"""SELECT id, 'ASF' AS mission_labels, concat_ws(',', CASE WHEN food THEN 'Food' END, CASE WHEN general THEN 'General terms' END, CASE WHEN heat THEN 'Heat' END) AS topic_labels
 FROM (SELECT speech_id AS id, {_holds('and', 'in', 'to')} OR {_holds('la')} AS food, {_holds('the', 'of')} OR {_holds('heat')} AS heat, {_holds('e')} AS general FROM {Q_SPEECHES})
 WHERE food OR heat OR general""",
)
def i2b(spark, d):
    return streaming.read_store(spark, f"{stores(spark, d)[1]}/keyword_labels").select("id", "mission_labels", "topic_labels")


@query("I3_full_rebuild", f"SELECT speech_id AS id, speech AS text, CAST(length(speech) > 100 AS INT) AS asf_preds FROM {Q_SPEECHES} WHERE file LIKE '%-01-%'")
def i3(spark, d):
    """A rebuild after the files of two months of three went replaces what the stream had gathered."""
    root, out = stores(spark, d)
    fs, _ = tables._fs(spark, root)
    for name in [r["path"].rsplit("/", 1)[1] for r in tables.all_debate_files(spark, root).collect()]:
        if "-01-" not in name[:16]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), False)
    streaming.update(spark, root, dictionary(spark), out, f"{out}/check", long_texts, full=True)
    return streaming.read_store(spark, f"{out}/ml_labels").select("id", "text", "asf_preds")
