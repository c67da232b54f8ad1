"""How the given tables stand in for the toolkit's inputs; the expressions are valid in Spark and in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ORGS = (
    "customer",
    "c_custkey AS id",
    "c_name AS name",
    "CASE c_custkey % 3 WHEN 0 THEN '51-100' WHEN 1 THEN '10000+' END AS employee_count",
    "CASE WHEN c_nationkey < 5 THEN 'GBR' WHEN c_nationkey < 15 THEN 'FRA' ELSE 'USA' END AS country_code",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS short_description",
    "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN NULL WHEN c_custkey % 5 = 2 THEN 'AHL' ELSE 'AFS,ASF' END AS mission_labels",
)
DESCRIPTIONS = ("customer", "c_custkey AS id", "CASE WHEN c_custkey % 7 = 0 OR c_custkey % 22 = 0 THEN NULL ELSE c_name END AS description")
ROUNDS = (
    "orders",
    "o_orderkey AS id",
    "o_orderstatus AS name",
    "o_custkey AS org_id",
    "CAST(o_orderdate AS DATE) AS announced_on",
    "o_totalprice AS raised_amount",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'grant' WHEN '5-LOW' THEN NULL ELSE 'seed' END AS investment_type",
    "CASE o_orderkey % 4 WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'XXX' END AS raised_amount_currency_code",
)
INVESTMENTS = ("lineitem", "l_orderkey AS funding_round_id", "l_suppkey AS investor_id", "l_linenumber = 1 AS is_lead_investor")
INVESTORS = (
    "supplier",
    "s_suppkey AS id",
    "CASE s_suppkey % 5 WHEN 0 THEN 'accelerator,venture_capital' WHEN 1 THEN NULL ELSE 'venture_capital' END AS investor_types",
    "s_name AS cb_url",
)
CURATED = ("supplier", "CASE WHEN s_suppkey % 7 = 0 THEN s_name END AS url")
TEXTS = ("documents", "doc_id AS id", "text", "lang", "source", "n_chars")
SPEECHES = (
    "documents",
    "doc_id AS id",
    "text",
    "lang",
    "CAST(2005 + doc_id % 20 AS INT) AS year",
    "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS party",
)
#: Turns of conversations as elements of a debate file.
ELEMENTS = (
    "conversations",
    "conv_id AS path",
    "CAST(turn AS INT) AS pos",
    "CASE WHEN role = 'assistant' THEN 'speech' WHEN turn % 4 = 0 THEN 'major-heading' ELSE 'minor-heading' END AS tag",
    "text",
)


def load(spark: SparkSession, sf_dir: str, view: tuple[str, ...] | str) -> DataFrame:
    """A table, or a view over one.  Python workers find this package where the driver found it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    name, *exprs = (view,) if isinstance(view, str) else view
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.selectExpr(*exprs) if exprs else df


def sql(view: tuple[str, ...]) -> str:
    name, *exprs = view
    return f"(SELECT {', '.join(exprs)} FROM {name})"
