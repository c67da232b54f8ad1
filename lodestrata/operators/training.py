"""Training sets: de-duplication, sampling, splits, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import sample_key
from ..sources.scratch import kept


def usable_text(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "NA"))


def map_annotations(df: DataFrame) -> DataFrame:
    rows = df.filter(F.col("prediction") != "Not-specified")
    return rows.withColumn("relevant", F.when(F.col("prediction") == "Relevant", 1).when(F.col("prediction") == "Not-relevant", 0))


def longest_per_key(df: DataFrame, key: str = "id", text: str = "text", by: str = "length") -> DataFrame:
    """The longest text of each key (``by="lexicographic"``: the greatest)."""
    order = F.struct(F.length(text), text) if by == "length" else F.col(text)
    return df.groupBy(key).agg(F.max_by(text, order).alias(text))


def distinct_on(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def upsert(store: DataFrame, new: DataFrame, key: str = "id", order: str = "pos") -> DataFrame:
    """Both tables, keeping each key's last row: new before old, then the highest ``order``."""
    both = store.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(key).orderBy(F.col("_batch").desc(), F.col(order).desc())
    return both.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "_batch")


def upsert_debates(old: DataFrame | None, new: DataFrame, reset: bool = False) -> DataFrame:
    """Speeches by ``speech_id``, new before old; ``reset`` replaces all that was there."""
    return upsert(new.limit(0) if reset or old is None else old, new, "speech_id")


def stamp_labels(df: DataFrame, label_type: str, dataset: str, ts: Column | None = None) -> DataFrame:
    """How and for what the labels were made, and when (``ts``; now if not given)."""
    stamp = F.date_format(F.current_timestamp() if ts is None else ts, "yyyyMMdd-HHmm")
    return df.withColumns({"label_type": F.lit(label_type), "dataset": F.lit(dataset), "label_date": stamp})


def _cut_at(df: DataFrame, n: int | None, seed: int, id_col: str, frac: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows (or ``frac`` of all) in a repeatable random order, and the others.

    Counts by the first digits of the key (65,536 at most) tell in which of these parts the cut
    lies; only that part's rows are ranked, so nothing is sorted as a whole.
    """
    rows = df.withColumn("_key", sample_key(F.col(id_col), seed)).withColumn("_part", F.substring("_key", 1, 4))
    counts = sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect())
    left, at = int(sum(c for _, c in counts) * frac) if n is None else n, ""
    for at, count in counts:
        if count >= left:
            break
        left -= count
    ranked = rows.filter(F.col("_part") == at).withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy("_key", id_col)))
    drop = ["_key", "_part"]
    first = rows.filter(F.col("_part") < at).drop(*drop).unionByName(ranked.filter(F.col("_n") <= left).drop("_n", *drop))
    return first, rows.filter(F.col("_part") > at).drop(*drop).unionByName(ranked.filter(F.col("_n") > left).drop("_n", *drop))


def sample_n(df: DataFrame, n: int, seed: int, id_col: str = "id") -> DataFrame:
    """Exactly ``n`` rows, the first in a repeatable random order (all, if there are fewer)."""
    return _cut_at(df, n, seed, id_col)[0]


def sample_per_bucket(df: DataFrame, bucket: str, n: int, seed: int, id_col: str = "id") -> DataFrame:
    first = Window.partitionBy(bucket).orderBy(sample_key(F.col(id_col), seed), id_col)
    return df.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n).drop("_n")


def train_val_split(df: DataFrame, seed: int, frac: float = 0.8, id_col: str = "id", approx: bool = False) -> tuple[DataFrame, DataFrame]:
    """Disjoint training and validation rows; ``approx`` splits by a hash threshold, without a sort."""
    if approx:
        u = F.conv(F.substring(sample_key(F.col(id_col), seed), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
        return df.filter(u < frac), df.filter(u >= frac)
    return _cut_at(df, None, seed, id_col, frac)


def negative_sample(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Sample, then drop unusable texts; label 0.  More rows than there are is an error."""
    if n > df.count():
        raise ValueError("sample is larger than the table")
    return usable_text(sample_n(df, n, seed)).withColumn("relevant", F.lit(0))


def assemble_training(positives: DataFrame, sources: list[tuple[DataFrame, float]], seed: int) -> DataFrame:
    """Positives and a share of their number of negatives from each source."""
    n, out = positives.count(), positives.select("id", "text", F.lit(1).alias("relevant"))
    for df, share in sources:
        out = out.unionByName(negative_sample(df, int(n * share), seed).select("id", "text", "relevant"))
    return usable_text(out)


def _nth(df: DataFrame, order: str, n: int):
    """The ``n``-th smallest value of a column, nulls aside (the greatest, if there are fewer; None for none).

    Equal values are counted first and the counts dealt by ranges; only the range that holds the answer is run through in order.
    """
    counts = df.filter(F.col(order).isNotNull()).groupBy(order).agg(F.count(F.lit(1)).alias("_rows"))
    ranged = kept(counts.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.sum("_rows").alias("rows"), F.max(order).alias("top")).orderBy("_part").collect()
    before = 0
    for r in sizes:
        if before + r["rows"] >= n:
            upto = F.sum("_rows").over(Window.partitionBy("_part").orderBy(order))
            return ranged.filter(F.col("_part") == r["_part"]).withColumn("_upto", upto).filter(F.col("_upto") >= n - before).agg(F.min(order)).first()[0]
        before += r["rows"]
    return sizes[-1]["top"] if sizes else None


def replace_negatives(train: DataFrame, extra: DataFrame, seq: str = "seq") -> DataFrame:
    """Drop the first negatives in order of ``seq``, as many as ``extra`` has, and append ``extra`` as negatives.

    Negatives that share the last one's ``seq`` go with it; those without a ``seq`` stay and don't count.
    """
    n = extra.count()
    last = _nth(train.filter("relevant = 0"), seq, n) if n else None
    left = train if last is None else train.filter(~F.coalesce((F.col("relevant") == 0) & (F.col(seq) <= F.lit(last)), F.lit(False)))
    return left.select("id", "text", "relevant").unionByName(extra.select("id", "text", F.lit(0).alias("relevant")))


def new_rows(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    return new.join(old.select(key), key, "left_anti")


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row: the four counts, precision, recall, accuracy."""

    def n(p: int, t: int):
        return F.count(F.when((F.col(pred) == p) & (F.col(label) == t), 1))

    out = df.agg(n(1, 1).alias("tp"), n(1, 0).alias("fp"), n(0, 1).alias("fn"), n(0, 0).alias("tn"))
    return out.withColumns(
        {
            "precision": F.try_divide("tp", F.col("tp") + F.col("fp")),
            "recall": F.try_divide("tp", F.col("tp") + F.col("fn")),
            "accuracy": F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
        }
    )
