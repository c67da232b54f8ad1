"""Companies, funding rounds and investors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import step_decay

#: Investor types that count as smart money (fixed values).
SMART_TYPES = ("accelerator", "entrepreneurship_program", "incubator", "startup_competition")
#: Amounts are in thousands.
MIN_INVESTMENT, MAX_INVESTMENT, MAX_EMPLOYEES = 1e3, 10e3, 100


def restrict_ids(df: DataFrame, ids: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    return df if ids is None else df.join(ids.select(id_col), id_col, "left_semi")


def after_year(df: DataFrame, col: str, cutoff: int = 2000) -> DataFrame:
    return df.filter(F.year(col) > cutoff)


def normalise_rounds(rounds: DataFrame, cutoff: int = 2000) -> DataFrame:
    """Rounds after the cutoff year, renamed, amounts in thousands, with date and year.  (Sorting is left to the sink.)"""
    out = rounds.withColumnsRenamed({"id": "funding_round_id", "name": "funding_round_name"})
    out = out.withColumn("announced_on", F.to_date("announced_on")).withColumn("raised_amount", F.col("raised_amount") / 1000)
    return after_year(out, "announced_on", cutoff).withColumn("year", F.year("announced_on"))


def org_rounds(orgs: DataFrame, rounds: DataFrame) -> DataFrame:
    return orgs.select(F.col("id").alias("org_id"), F.col("name").alias("org_name")).join(rounds, "org_id", "left")


def round_investors(rounds: DataFrame, investments: DataFrame, investors: DataFrame, null_safe: bool = False) -> DataFrame:
    """One row per round and investor; rounds without investors stay.  ``null_safe`` lets null keys meet, as some tools do."""
    links = investments.select("funding_round_id", "investor_id", "is_lead_investor")
    who = investors.select(F.col("id").alias("_investor"), "investor_types", "cb_url")
    out = rounds.join(links, "funding_round_id", "left")
    key = out["investor_id"]
    on = key.eqNullSafe(who["_investor"]) if null_safe else key == who["_investor"]
    return out.join(who, on, "left").drop("_investor")


def smart_money(rounds_inv: DataFrame, curated: DataFrame, types: tuple[str, ...] = SMART_TYPES, null_auto: str = "false") -> DataFrame:
    """Flags by investor type, by the curated list, and combined.

    A null type makes the combined flag false even for a curated investor, unless
    ``null_auto`` is ``"as_false"``.
    """
    listed = curated.select(F.col("url").alias("cb_url")).distinct().withColumn("_listed", F.lit(True))
    out = rounds_inv.join(listed, "cb_url", "left")
    auto, manual = F.col("investor_types").rlike("|".join(types)), F.col("_listed").isNotNull()
    both = F.coalesce(auto, F.lit(False)) | manual
    if null_auto != "as_false":
        both = F.when(auto.isNull(), F.lit(False)).otherwise(both)
    return out.withColumns({"smart_auto": F.coalesce(auto, F.lit(False)), "smart_manual": manual, "smart_money": both}).drop("_listed")


def date_range(df: DataFrame, col: str = "announced_on") -> DataFrame:
    return df.agg(F.min(col).alias("first_date"), F.max(col).alias("last_date"))


def org_funding(rounds: DataFrame, start: str | None = None, end: str | None = None, per_round: bool = False, more: tuple[Column, ...] = ()) -> DataFrame:
    """Grant and other totals and counts per company, dates inclusive; every company of ``rounds`` has a row.

    A row per round and investor counts a round once for each; ``per_round`` counts it once.
    ``more``: aggregates to take in the same pass.
    """
    inside = F.lit(True)
    if start:
        inside = inside & (F.col("announced_on") >= F.lit(start).cast("date"))
    if end:
        inside = inside & (F.col("announced_on") <= F.lit(end).cast("date"))
    inside = F.coalesce(inside, F.lit(False))
    if per_round:
        rounds = rounds.dropDuplicates(["funding_round_id"])
    grant = F.col("investment_type").eqNullSafe("grant")

    def total(kind: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind & inside, F.col("raised_amount_gbp"))), F.lit(0.0))

    out = rounds.groupBy("org_id").agg(
        total(grant).alias("total_grants"),
        F.count(F.when(grant & inside, F.col("funding_round_id"))).alias("num_grants"),
        total(~grant).alias("total_rounds"),
        F.count(F.when(~grant & inside, F.col("funding_round_id"))).alias("num_rounds"),
        *more,
    )
    return out.withColumn("total_funding", F.col("total_grants") + F.col("total_rounds"))


def attach_funding(orgs: DataFrame, funding: DataFrame) -> DataFrame:
    return orgs.join(funding.withColumnRenamed("org_id", "id"), "id", "left")


def investment_flags(
    orgs: DataFrame,
    scope: tuple[str, ...],
    home: str = "GBR",
    least: float = MIN_INVESTMENT,
    most: float = MAX_INVESTMENT,
    max_employees: int = MAX_EMPLOYEES,
) -> DataFrame:
    """Opportunity metric and the three opportunity columns of each company."""
    total = F.coalesce("total_funding", F.lit(0.0))
    small = F.coalesce(F.col("employees") <= max_employees, F.lit(False))
    at_home = F.coalesce(F.col("country_code") == home, F.lit(False))
    active = F.coalesce((F.col("num_rounds") > 0) | (F.col("num_grants") > 0), F.lit(False))
    metric = F.bround(step_decay(total, most), 3)
    zero = F.lit(0.0)
    return orgs.withColumns(
        {
            "investment_metric": metric,
            "potential_investment_opp": small & at_home & F.coalesce(F.col("total_funding") < least, F.lit(False)),
            "investment_opp": F.when(small & at_home & (total >= least), metric).otherwise(zero),
            "interesting_foreign_opp": F.when(small & F.coalesce(F.col("country_code").isin(*scope), F.lit(False)) & active, metric).otherwise(zero),
        }
    )


def has_smart_money(orgs: DataFrame, rounds: DataFrame) -> DataFrame:
    ids = rounds.filter("smart_money").select(F.col("org_id").alias("id")).distinct().withColumn("_hit", F.lit(True))
    return orgs.join(ids, "id", "left").withColumn("has_smart_money", F.col("_hit").isNotNull()).drop("_hit")


def is_smart_money(orgs: DataFrame, rounds: DataFrame, relevant: DataFrame) -> DataFrame:
    """Companies that are smart investors: curated ones, and those by type among the relevant ids."""
    by = rounds.groupBy(F.col("investor_id").alias("id")).agg(F.max("smart_manual").alias("_manual"), F.max("smart_auto").alias("_auto"))
    by = by.filter("_manual or _auto").join(relevant.select("id", F.lit(True).alias("_relevant")).distinct(), "id", "left")
    ids = by.filter("_manual or _relevant").select("id", F.lit(True).alias("_hit"))
    return orgs.join(ids, "id", "left").withColumn("smart_money_investor", F.coalesce("_hit", F.lit(False))).drop("_hit")


def description_text(orgs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Short and long description in one text; companies with neither go."""
    both = orgs.select("id", "short_description").join(descriptions.select("id", "description"), "id", "left")
    both = both.filter(F.col("short_description").isNotNull() | F.col("description").isNotNull())
    return both.select("id", F.concat(F.coalesce("short_description", F.lit("")), F.lit(". "), F.coalesce("description", F.lit(""))).alias("text"))


def latest_per_key(df: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    newest = Window.partitionBy(key).orderBy(F.col(date).desc_nulls_last(), F.col(tie))
    return df.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def org_flags(orgs: DataFrame, scope: tuple[str, ...], home: str = "GBR") -> DataFrame:
    """Fourteen derived flags of a company with missions, funding and smart-money columns."""
    uk, smart = F.col("country_code") == home, F.col("has_smart_money")
    mission = F.coalesce(F.col("mission_labels"), F.lit("")) != ""
    grants, rounds = F.coalesce(F.col("num_grants") > 0, F.lit(False)), F.coalesce(F.col("num_rounds") > 0, F.lit(False))
    high = F.coalesce(F.col("investment_opp") >= 0.75, F.lit(False))
    foreign = F.coalesce(F.col("interesting_foreign_opp") >= 0.75, F.lit(False))
    potential, investor = F.col("potential_investment_opp"), F.col("smart_money_investor")
    flags = {
        "is_uk": uk, "in_scope": F.col("country_code").isin(*scope), "has_mission": mission, "has_grants": grants, "has_rounds": rounds,
        "uk_smart_money": uk & smart, "foreign_smart_money": ~uk & smart, "uk_potential": uk & potential, "uk_opportunity": uk & high,
        "uk_opportunity_smart": uk & high & smart, "foreign_opportunity": foreign & ~uk, "foreign_opportunity_smart": foreign & ~uk & smart,
        "uk_investor": uk & investor, "uk_grants": uk & grants,
    }
    return orgs.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})


def conditional_counts(flags: DataFrame, by: str, names: list[str]) -> DataFrame:
    """Rows and true flags per value of an exploded, comma-joined label column (empty text is a value)."""
    rows = flags.withColumn(by, F.explode(F.split(F.coalesce(by, F.lit("")), ",")))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("total"), *[F.sum(F.col(n).cast("long")).alias(f"total_{n}") for n in names])


def attach_topic_labels(orgs: DataFrame, labels: DataFrame) -> DataFrame:
    return orgs.join(labels.select("id", "topic_labels"), "id", "left")


def attach_taxonomy(rows: DataFrame, taxonomy: DataFrame, by: str) -> DataFrame:
    """The category of each row's subcategory (``by``); null where the taxonomy lacks it."""
    return rows.join(taxonomy.select(F.col("Subcategory").alias(by), F.col("Category").alias("category")), by, "left")


def topic_summary(flags: DataFrame, taxonomy: DataFrame, by: str, names: list[str]) -> DataFrame:
    return attach_taxonomy(conditional_counts(flags, by, names), taxonomy, by).orderBy("category", by)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
