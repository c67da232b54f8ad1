"""Reading and writing: snapshots, documents, lists, label stores."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables of a company snapshot and of a grants snapshot.
COMPANY_TABLES = (
    "organizations organization_descriptions org_parents funding_rounds funds acquisitions events event_appearances investors investments "
    "ipos jobs people people_descriptions degrees category_groups"
).split()
GRANT_TABLES = "projects organisations persons funds".split()
GEOJSON_TYPES = "Point MultiPoint LineString MultiLineString Polygon MultiPolygon GeometryCollection Feature FeatureCollection".split()


def latest_version(paths: DataFrame, pattern: str, col: str = "path") -> DataFrame:
    """One row: the greatest version that ``pattern`` (group 1) finds among the paths; null if none."""
    return paths.agg(F.max(F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))).alias("version"))


def latest_timestamp_dir(paths: DataFrame, col: str = "path") -> DataFrame:
    """One row: the path that holds the greatest ``yyyymmdd_hhmmss``."""
    ts = F.nullif(F.regexp_extract(col, r"(\d{8}_\d{6})", 1), F.lit(""))
    return paths.withColumn("_ts", ts).filter("_ts is not null").agg(F.max_by(col, F.struct("_ts", col)).alias("path"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_dirs(spark: SparkSession, root: str) -> list[str]:
    fs, p = _fs(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path")


def resolve_version(spark: SparkSession, root: str, dataset: str, version: str | None = None, use_latest: bool = True) -> str:
    """A pinned version, or the newest ``<dataset>_<date>`` folder."""
    if version:
        return version
    if not use_latest:
        raise ValueError("give a version or ask for the latest")
    found = [m[1] for d in list_dirs(spark, root) if (m := re.fullmatch(rf"{re.escape(dataset)}_(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})", d))]
    if not found:
        raise ValueError(f"no snapshot of {dataset} in {root}")
    return max(found)


def read_snapshot(spark: SparkSession, root: str, dataset: str, table: str, version: str | None = None, use_latest: bool = True) -> DataFrame:
    v = resolve_version(spark, root, dataset, version, use_latest)
    return read_table(spark, f"{root}/{dataset}_{v}/{table}.parquet")


def catalog(spark: SparkSession, root: str, dataset: str, tables: list[str] = COMPANY_TABLES, version: str | None = None) -> list[str]:
    """Register a snapshot's tables as temporary views (lazily read); the names registered."""
    v, done = resolve_version(spark, root, dataset, version), []
    for t in tables:
        path = f"{root}/{dataset}_{v}/{t}.parquet"
        if exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(t)
            done.append(t)
    return done


def read_enriched(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/enriched/{name}_full.parquet")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=True)
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raise NotImplementedError(f"no reader for {path}")


def read_json_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def read_text_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def read_numeric_csv(spark: SparkSession, path: str, columns: int) -> DataFrame:
    names = [f"c{i}" for i in range(columns)]
    rows = spark.read.schema(", ".join(f"{n} double" for n in names)).csv(path)
    return rows.select(F.array(*names).alias("row"))


def resolve_file(paths: DataFrame, stem: str, col: str = "path") -> str:
    """The one path whose file name without suffix is ``stem``."""
    found = paths.filter(F.regexp_extract(col, r"([^/]+)\.[^./]+$", 1) == stem).select(col).take(2)
    if not found:
        raise FileNotFoundError(stem)
    if len(found) > 1:
        raise ValueError(f"several files named {stem}")
    return found[0][0]


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    kinds = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".geojson": "json", ".txt": "text"}
    kind = next((k for s, k in kinds.items() if path.endswith(s)), None)
    if not kind:
        raise NotImplementedError(f"no writer for {path}")
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def export_csv(df: DataFrame, path: str) -> None:
    """The table as CSV with a header and no index, replacing what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def validate_geojson(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a known ``type``, and the others."""
    if "type" not in df.columns:
        raise AttributeError("geojson needs a type member")
    ok = F.coalesce(F.col("type").isin(*GEOJSON_TYPES), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def read_label_store(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The store, or an empty table if there is none yet; other errors raise."""
    from . import stores

    rows = stores.read(spark, path, schema=schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def reset_label_store(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def append_or_create(df: DataFrame, path: str) -> None:
    """Add the rows to the store; earlier appends fold together as they gather."""
    from . import stores

    stores.append(df, path)
    stores.compact(df.sparkSession, path)


def incremental_files(spark: SparkSession, manifest: str, root: str, done: DataFrame | None = None) -> DataFrame:
    """Files named in the manifest that exist and were not done before."""
    wanted = spark.read.text(manifest).select(F.trim("value").alias("name")).filter("name <> ''").distinct()
    files = list_files(spark, root).withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    out = files.join(wanted, "name", "left_semi")
    return out if done is None else out.join(done.select("name"), "name", "left_anti")


def all_debate_files(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root, "*.xml")


def year_of_file(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"debates(\d{4})-", 1), F.lit(""))


def files_for_year(files: DataFrame, year: str) -> DataFrame:
    return files.filter(year_of_file(F.col("path")) == year)


def read_memberships(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Memberships of people documents: the document's ``path``, the place in its list (``pos``), and the members' fields."""
    from .json_elements import json_elements

    return json_elements(spark, path, "memberships", schema).select("path", "pos", "m.*")


def read_grant_projects(spark: SparkSession, path: str) -> DataFrame:
    """Id and abstract of the projects that documents list."""
    from .json_elements import json_elements

    return json_elements(spark, path, schema="id string, abstractText string").select("m.id", F.col("m.abstractText").alias("text"))


def read_curated(spark: SparkSession, root: str, name: str) -> DataFrame:
    for suffix in (".parquet", ".csv"):
        if exists(spark, f"{root}/{name}{suffix}"):
            return read_table(spark, f"{root}/{name}{suffix}")
    raise FileNotFoundError(name)


def read_training_data(spark: SparkSession, path: str) -> DataFrame:
    from ..functions.scalars import vector_from_text

    rows = read_table(spark, path)
    return rows.withColumn("embedding", vector_from_text(F.col("embedding"))) if dict(rows.dtypes).get("embedding") == "string" else rows
