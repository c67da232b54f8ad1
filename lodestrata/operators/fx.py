"""Currency conversion by daily rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_rates(rates: DataFrame) -> DataFrame:
    """(currency, day, rate) for every day between a currency's first and last: gaps are filled along a line."""
    span = rates.groupBy("currency").agg(F.min("rate_date").alias("a"), F.max("rate_date").alias("b"))
    days = span.select("currency", F.explode(F.sequence("a", "b")).alias("day"))
    known = rates.filter(F.col("units_per_eur").isNotNull()).select("currency", F.col("rate_date").alias("day"), F.col("units_per_eur").alias("r"))
    w = Window.partitionBy("currency").orderBy("day")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    had = F.when(F.col("r").isNotNull(), F.struct("day", "r"))
    out = days.join(known, ["currency", "day"], "left")
    out = out.withColumn("p", F.last(had, ignorenulls=True).over(back)).withColumn("n", F.first(had, ignorenulls=True).over(ahead))
    part = F.datediff("day", "p.day") / F.datediff("n.day", "p.day")
    rate = F.when(F.col("r").isNotNull(), F.col("r")).when(F.col("p").isNull(), F.col("n.r")).when(F.col("n").isNull(), F.col("p.r"))
    return out.select("currency", "day", rate.otherwise(F.col("p.r") + (F.col("n.r") - F.col("p.r")) * part).alias("rate"))


def convert_currency(
    df: DataFrame, rates: DataFrame, date_col: str, amount_col: str, currency_col: str, out: str | None = None, target: str = "GBP", since: int = 2000
) -> DataFrame:
    """Convert amounts on their day.

    Null for a null date, a year before ``since`` or an unknown currency; days outside
    the table take its nearest; amounts already in ``target`` stay whatever their day.
    An amount column that is null throughout stays null throughout.
    """
    out = out or f"{amount_col}_{target.lower()}"
    dense = dense_rates(rates)
    # the first and last days by currency are one value, as long as the list of currencies
    ends = F.struct(F.min("day").alias("a"), F.max("day").alias("b"))
    spans = dense.groupBy("currency").agg(ends.alias("ends")).agg(F.map_from_entries(F.collect_list(F.struct("currency", "ends")))).scalar()
    day = F.to_date(date_col)

    def held(ends: Column) -> Column:
        return F.greatest(F.least(F.col("_real"), ends["b"]), ends["a"])

    own, to = F.try_element_at("_spans", F.col(currency_col)), F.try_element_at("_spans", F.lit(target))
    from_ = df.withColumns({"_spans": spans, "_real": day}).withColumns({"_day": F.when(own.isNotNull(), held(own)), "_to_day": held(to)}).drop("_spans")
    rates_from = dense.select(F.col("currency").alias("_c"), F.col("day").alias("_day"), F.col("rate").alias("_from"))
    from_ = from_.withColumn("_c", F.col(currency_col)).join(rates_from, ["_c", "_day"], "left")
    rates_to = dense.filter(F.col("currency") == target).select(F.col("day").alias("_to_day"), F.col("rate").alias("_to"))
    from_ = from_.join(rates_to, "_to_day", "left")
    amount = F.col(amount_col).cast("double")
    converted = F.when((F.year("_real") >= since) & F.col("_real").isNotNull(), amount / F.col("_from") * F.col("_to"))
    value = F.when(F.col(currency_col) == target, amount).otherwise(converted)
    return from_.withColumn(out, value).drop("_c", "_day", "_real", "_to_day", "_from", "_to")
