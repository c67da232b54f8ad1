"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common

WEIGHTS = (5, 2, 1)
#: Sources whose running sums one task takes.
PART = 100_000


def word_count(text_col: str = "text") -> Column:
    """Number of words of the text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(common.WORD)), F.lit(0)).cast("long")


def _before(rows: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """``before_<name>`` for each of ``sums``: its sum over the rows that come earlier in ``order`` (which tells all rows apart).

    Rows are ranged by the order, PART to a task; the tasks' totals, a row each, give the ranges' starts.
    """
    parts = max(1, -(-rows.count() // PART))
    ranged = common.cut(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    totals = sorted(ranged.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums]).collect())
    starts, so_far = [], [0] * len(sums)
    for part, *values in totals:
        starts.append((part, *so_far))
        so_far = [a + b for a, b in zip(so_far, values, strict=True)]
    # an Arrow table is read by the JVM itself; a list of rows would start Python workers in the executors
    kinds = pa.schema([("part", pa.int32()), *[(f"start_{c}", pa.int64()) for c in sums]])
    start = rows.sparkSession.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in starts], kinds))
    earlier = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(start), "part")
    out = out.withColumns({f"before_{c}": F.col(f"start_{c}") + F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums})
    return out.drop("part", *[f"start_{c}" for c in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the
    total of all sizes; a target stops at ``most`` times its source's size and the
    excess goes to the others by weight until none is above.  In order of
    ``most * size / weight`` the stopped sources come first, so the level at which
    sharing ends follows from running sums over the sources (one row each).
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    name = F.col("source").asc_nulls_last()
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = _before(by.withColumn("one", F.lit(1).cast("long")), [name], ["one"])
    weight = F.element_at(turn, (F.col("before_one") % len(weights) + 1).cast("int")).cast("long").alias("weight")
    ranked = ranked.select("source", "source_size", weight)
    levels = ranked.withColumn("stop", F.col("source_size") * most / F.col("weight"))
    levels = common.cut(_before(levels, [F.col("stop").asc(), name], ["source_size", "weight"]))
    total, all_weights = (x or 0 for x in levels.agg(F.sum("source_size"), F.sum("weight")).first())
    level = (F.lit(total) - F.col("before_source_size") * most) / (F.lit(all_weights) - F.col("before_weight"))
    # the first source that its share doesn't stop sets the level for all
    found = levels.withColumn("level", level).filter("level <= stop").agg(F.min(F.struct("stop", "level")).alias("one")).first()["one"]
    share = F.lit(found["level"]) if found else F.col("stop")
    target = F.least(F.col("source_size") * most, F.col("weight") * share)
    return levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def draw(id_col: str, seed: int) -> Column:
    """A number in [0, 1) from the id's text and the seed, the same in every run and engine."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: float = 3.0,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each document: ``row`` (a struct of all input columns), size, source_size, target, copies.

    A source's rate is target / size; a document comes floor(rate) times, plus once
    more if a draw seeded by its id falls below the fraction.  Null text has size 0;
    null sources are one source; a null id draws as the text "null"; repeated rows
    draw alike; an empty table gives no rows; a source of size 0 has target 0 and no
    copies.  The per-source figures, one row a source, join on the source; a source that holds much of
    the table is split by adaptive skew handling or broadcast by size.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    sized = docs.select(whole, F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    targets = source_targets(sized, weights, most).withColumnRenamed("source", "of")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["of"]), "left")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(f"row.`{id_col}`", seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as many times as it is taken, with the input's columns."""
    again = mix(docs, **options).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return again.select("row.*")


def mixing_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    mixed = mix(docs, id_col=id_col, **options)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select(F.col(f"row.`{id_col}`").alias("doc_id"), "size", "source_size", "target", taken)


#: The same rows in DuckDB.  The level is found as the smallest stop at which the share fits.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS stop,
    (sum(source_size) OVER () - coalesce(sum(source_size) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3.0::DOUBLE)
    / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT source, source_size,
    least(source_size * 3.0::DOUBLE, weight * (SELECT arg_min(level, stop) FROM l WHERE level <= stop)) AS target
  FROM l
)
SELECT d.doc_id, d.size, t.source_size, coalesce(t.target, 0.0) AS target,
  (d.size * (floor(coalesce(target / nullif(source_size, 0), 0)) + CASE WHEN
     ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':7'), 1, 12))::BIGINT::DOUBLE / 281474976710656.0
       < coalesce(target / nullif(source_size, 0), 0) - floor(coalesce(target / nullif(source_size, 0), 0)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
