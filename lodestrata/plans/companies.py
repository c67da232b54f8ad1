"""Queries on companies, rounds and investors (customer, orders, lineitem, supplier, part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import funding as O
from ..operators import fx
from ..operators import training as T
from ..sources import tables
from .views import CURATED, DESCRIPTIONS, INVESTMENTS, INVESTORS, ORGS, ROUNDS, load, sql

CUTOFF = 1996
SCOPE = ("GBR", "FRA", "DEU", "ROM")
QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return keep


# --- shared parts, in Spark and in SQL

RATES = """SELECT CASE n WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' END AS currency, d AS rate_date,
 CASE WHEN n = 2 THEN 1.0 ELSE (100 + n * 7 + s % 13) / 100.0 END AS units_per_eur
 FROM (SELECT CAST(s_suppkey % 3 AS INT) AS n, CAST(s_suppkey AS INT) AS s, min(CAST(o_orderdate AS DATE)) AS d
 FROM supplier JOIN orders ON o_custkey = s_suppkey GROUP BY s_suppkey)"""


def rates(spark, d):
    """Sparse rates (a supplier gives a currency's rate on a day); of one day's the highest counts."""
    suppliers, orders = load(spark, d, "supplier"), load(spark, d, "orders")
    first = orders.join(suppliers, F.col("o_custkey") == F.col("s_suppkey")).groupBy("s_suppkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("rate_date"))
    n = F.col("s_suppkey") % 3
    currency = F.when(n == 0, "GBP").when(n == 1, "USD").otherwise("EUR").alias("currency")
    rows = first.select(currency, "rate_date", F.when(n == 2, 1.0).otherwise((100 + n * 7 + F.col("s_suppkey") % 13) / 100.0).alias("units_per_eur"))
    return rows.groupBy("currency", "rate_date").agg(F.max("units_per_eur").cast("double").alias("units_per_eur"))


def rounds(spark, d):
    return O.normalise_rounds(load(spark, d, ROUNDS), CUTOFF).withColumn("raised_amount_gbp", F.col("raised_amount"))


def rounds_inv(spark, d):
    links = O.round_investors(rounds(spark, d), load(spark, d, INVESTMENTS), load(spark, d, INVESTORS))
    return O.smart_money(links, load(spark, d, CURATED))


def funded(spark, d):
    orgs = load(spark, d, ORGS).withColumn("employees", S.employee_max(F.col("employee_count")))
    return O.attach_funding(orgs, O.org_funding(rounds_inv(spark, d)))


def flagged(spark, d):
    """One pass over rounds and investors for each company's figures, one for each investor's."""
    links = rounds_inv(spark, d)
    orgs = load(spark, d, ORGS).withColumn("employees", S.employee_max(F.col("employee_count")))
    orgs = O.attach_funding(orgs, O.org_funding(links, more=(F.max("smart_money").alias("has_smart_money"),)))
    orgs = O.investment_flags(orgs, SCOPE).withColumn("has_smart_money", F.coalesce("has_smart_money", F.lit(False)))
    orgs = O.is_smart_money(orgs, links, load(spark, d, ORGS).filter(F.col("id") % 2 == 0))
    return O.org_flags(orgs, SCOPE)


Q_ROUNDS = f"""(SELECT id AS funding_round_id, name AS funding_round_name, org_id, announced_on, raised_amount / 1000 AS raised_amount,
 raised_amount / 1000 AS raised_amount_gbp, investment_type, raised_amount_currency_code, CAST(year(announced_on) AS INT) AS year
 FROM {sql(ROUNDS)} WHERE year(announced_on) > {CUTOFF})"""
Q_LINKS = f"""(SELECT r.*, i.investor_id, i.is_lead_investor, v.investor_types, v.cb_url,
 coalesce(regexp_matches(v.investor_types, 'accelerator|entrepreneurship_program|incubator|startup_competition'), false) AS smart_auto,
 c.url IS NOT NULL AS smart_manual,
 CASE WHEN v.investor_types IS NULL THEN false ELSE regexp_matches(v.investor_types, 'accelerator|entrepreneurship_program|incubator|startup_competition')
   OR c.url IS NOT NULL END AS smart_money
 FROM {Q_ROUNDS} r LEFT JOIN {sql(INVESTMENTS)} i USING (funding_round_id) LEFT JOIN {sql(INVESTORS)} v ON v.id = i.investor_id
 LEFT JOIN (SELECT DISTINCT url FROM {sql(CURATED)}) c ON c.url = v.cb_url)"""
Q_FUNDING = f"""(SELECT org_id, coalesce(sum(raised_amount_gbp) FILTER (investment_type = 'grant'), 0) AS total_grants,
 count(*) FILTER (investment_type = 'grant') AS num_grants,
 coalesce(sum(raised_amount_gbp) FILTER (investment_type IS DISTINCT FROM 'grant'), 0) AS total_rounds,
 count(*) FILTER (investment_type IS DISTINCT FROM 'grant') AS num_rounds FROM {Q_LINKS} GROUP BY org_id)"""
Q_EMP = "coalesce(CAST(regexp_extract(employee_count, '(\\d+)\\+?$', 1) AS INT), 0)"
Q_FUNDED = f"""(SELECT o.*, {Q_EMP} AS employees, total_grants, num_grants, total_rounds, num_rounds, total_grants + total_rounds AS total_funding
 FROM {sql(ORGS)} o LEFT JOIN {Q_FUNDING} f ON f.org_id = o.id)"""
Q_METRIC = "round(CASE WHEN coalesce(total_funding, 0) <= 10000 THEN 1.0 ELSE exp(ln(0.1) / 10000 * (coalesce(total_funding, 0) - 10000)) END, 3)"
Q_OPP = f"""(SELECT *, {Q_METRIC} AS investment_metric,
 employees <= 100 AND country_code = 'GBR' AND coalesce(total_funding < 1000, false) AS potential_investment_opp,
 CASE WHEN employees <= 100 AND country_code = 'GBR' AND coalesce(total_funding, 0) >= 1000 THEN {Q_METRIC} ELSE 0.0 END AS investment_opp,
 CASE WHEN employees <= 100 AND country_code IN ('GBR','FRA','DEU','ROM') AND coalesce(num_rounds > 0 OR num_grants > 0, false) THEN {Q_METRIC} ELSE 0.0 END
   AS interesting_foreign_opp FROM {Q_FUNDED})"""
Q_SMART = f"""(SELECT o.*, o.id IN (SELECT org_id FROM {Q_LINKS} WHERE smart_money) AS has_smart_money,
 o.id IN (SELECT investor_id FROM {Q_LINKS} WHERE smart_manual UNION SELECT investor_id FROM {Q_LINKS} WHERE smart_auto AND investor_id % 2 = 0)
   AS smart_money_investor FROM {Q_OPP} o)"""
FLAGS = (
    "is_uk in_scope has_mission has_grants has_rounds uk_smart_money foreign_smart_money uk_potential uk_opportunity uk_opportunity_smart "
    "foreign_opportunity foreign_opportunity_smart uk_investor uk_grants"
).split()
Q_FLAGS = f"""(SELECT *, country_code = 'GBR' AS is_uk, country_code IN ('GBR','FRA','DEU','ROM') AS in_scope, coalesce(mission_labels, '') <> '' AS has_mission,
 coalesce(num_grants > 0, false) AS has_grants, coalesce(num_rounds > 0, false) AS has_rounds,
 country_code = 'GBR' AND has_smart_money AS uk_smart_money, country_code <> 'GBR' AND has_smart_money AS foreign_smart_money,
 country_code = 'GBR' AND potential_investment_opp AS uk_potential, country_code = 'GBR' AND investment_opp >= 0.75 AS uk_opportunity,
 country_code = 'GBR' AND investment_opp >= 0.75 AND has_smart_money AS uk_opportunity_smart,
 interesting_foreign_opp >= 0.75 AND country_code <> 'GBR' AS foreign_opportunity,
 interesting_foreign_opp >= 0.75 AND country_code <> 'GBR' AND has_smart_money AS foreign_opportunity_smart,
 country_code = 'GBR' AND smart_money_investor AS uk_investor, country_code = 'GBR' AND coalesce(num_grants > 0, false) AS uk_grants FROM {Q_SMART})"""


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


# --- queries


@query("A1_latest_version", "SELECT max(nullif(regexp_extract(url, '/(\\d+)', 1), '')) AS version FROM pages")
def a1(spark, d):
    return tables.latest_version(load(spark, d, "pages"), r"/(\d+)", "url")


@query(
    "A12_latest_timestamp_dir",
    """SELECT max_by(path, ts || path) AS path FROM (SELECT path, nullif(regexp_extract(path, '(\\d{8}_\\d{6})', 1), '') AS ts FROM
 (SELECT 'run_' || strftime(ts, '%Y%m%d_%H%M%S') || '/' || event_type AS path FROM events)) WHERE ts IS NOT NULL""",
)
def a12(spark, d):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd_HHmmss")
    return tables.latest_timestamp_dir(load(spark, d, "events").select(F.concat(F.lit("run_"), stamp, F.lit("/"), "event_type").alias("path")))


@query("B1_restrict_ids", f"SELECT * FROM {sql(ORGS)} WHERE id IN (SELECT s_suppkey FROM supplier)")
def b1(spark, d):
    return O.restrict_ids(load(spark, d, ORGS), load(spark, d, INVESTORS))


@query("B2_after_year", f"SELECT * FROM {sql(ROUNDS)} WHERE year(announced_on) > {CUTOFF}")
def b2(spark, d):
    return O.after_year(load(spark, d, ROUNDS), "announced_on", CUTOFF)


@query("B3_normalise_rounds", f"SELECT * EXCLUDE (raised_amount_gbp) FROM {Q_ROUNDS}")
def b3(spark, d):
    return O.normalise_rounds(load(spark, d, ROUNDS), CUTOFF)


Q_RATES = f"(SELECT currency, rate_date, CAST(max(units_per_eur) AS DOUBLE) AS r FROM ({RATES}) GROUP BY 1, 2)"
Q_DENSE = f"""(SELECT currency, day, CASE WHEN r IS NOT NULL THEN r WHEN pd IS NULL THEN nr WHEN nd IS NULL THEN pr
   ELSE pr + (nr - pr) * (date_diff('day', pd, day)::DOUBLE / date_diff('day', pd, nd)) END AS rate FROM (
 SELECT s.currency, s.day, k.r, last_value(k.rate_date IGNORE NULLS) OVER a AS pd, last_value(k.r IGNORE NULLS) OVER a AS pr,
   first_value(k.rate_date IGNORE NULLS) OVER b AS nd, first_value(k.r IGNORE NULLS) OVER b AS nr
 FROM (SELECT currency, CAST(unnest(generate_series(min(rate_date), max(rate_date), INTERVAL 1 DAY)) AS DATE) AS day FROM {Q_RATES} GROUP BY currency) s
 LEFT JOIN {Q_RATES} k ON k.currency = s.currency AND k.rate_date = s.day
 WINDOW a AS (PARTITION BY s.currency ORDER BY s.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        b AS (PARTITION BY s.currency ORDER BY s.day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


@query(
    "B4_convert_currency",
    f"""WITH den AS {Q_DENSE}, span AS (SELECT currency, min(day) AS a, max(day) AS b FROM den GROUP BY 1)
SELECT o.id, o.raised_amount_currency_code AS currency, round(CASE WHEN o.raised_amount_currency_code = 'GBP' THEN o.raised_amount
 WHEN year(o.announced_on) >= 2000 THEN o.raised_amount / f.rate * t.rate END, 6) AS raised_amount_gbp
FROM {sql(ROUNDS)} o LEFT JOIN span s ON s.currency = o.raised_amount_currency_code
LEFT JOIN den f ON f.currency = s.currency AND f.day = greatest(least(o.announced_on, s.b), s.a)
LEFT JOIN span g ON g.currency = 'GBP' LEFT JOIN den t ON t.currency = 'GBP' AND t.day = greatest(least(o.announced_on, g.b), g.a)""",
)
def b4(spark, d):
    out = fx.convert_currency(load(spark, d, ROUNDS), rates(spark, d), "announced_on", "raised_amount", "raised_amount_currency_code")
    return out.select("id", F.col("raised_amount_currency_code").alias("currency"), *r6("raised_amount_gbp"))


@query("E10_dense_rates", f"SELECT currency, day, round(rate, 9) AS rate FROM {Q_DENSE}")
def e10(spark, d):
    return fx.dense_rates(rates(spark, d)).select("currency", "day", F.round("rate", 9).alias("rate"))


@query("B5_employee_max", f"SELECT id, {Q_EMP} AS employees FROM {sql(ORGS)}")
def b5(spark, d):
    return load(spark, d, ORGS).select("id", S.employee_max(F.col("employee_count")).alias("employees"))


@query(
    "B6_step_decay",
    "SELECT o_orderkey, round(CASE WHEN o_totalprice <= 100000 THEN 1.0 ELSE exp(ln(0.1) / 100000 * (o_totalprice - 100000)) END, 6) AS decay FROM orders",
)
def b6(spark, d):
    return load(spark, d, "orders").select("o_orderkey", F.round(S.step_decay(F.col("o_totalprice"), 1e5), 6).alias("decay"))


OPP = ["investment_metric", "potential_investment_opp", "investment_opp", "interesting_foreign_opp"]


@query("B7_investment_flags", f"SELECT id, {', '.join(OPP)} FROM {Q_OPP}")
def b7(spark, d):
    return O.investment_flags(funded(spark, d), SCOPE).select("id", *OPP)


@query(
    "B8_description_text",
    f"""SELECT o.id, coalesce(short_description, '') || '. ' || coalesce(description, '') AS text
 FROM {sql(ORGS)} o LEFT JOIN {sql(DESCRIPTIONS)} x ON x.id = o.id WHERE short_description IS NOT NULL OR description IS NOT NULL""",
)
def b8(spark, d):
    return O.description_text(load(spark, d, ORGS), load(spark, d, DESCRIPTIONS))


@query("B20_split_list", "SELECT p_partkey, len(string_split(p_name, ' ')) AS n, array_to_string(string_split(p_name, ' '), '|') AS words FROM part")
def b20(spark, d):
    words = S.split_list(F.col("p_name"), " ")
    return load(spark, d, "part").select("p_partkey", F.size(words).cast("long").alias("n"), F.array_join(words, "|").alias("words"))


@query("B25_org_flags", f"SELECT id, {', '.join(FLAGS)} FROM {Q_FLAGS}")
def b25(spark, d):
    return flagged(spark, d).select("id", *FLAGS)


@query("B26_has_mission", f"SELECT id, regexp_matches(coalesce(mission_labels, ''), 'ASF|AHL|AFS') AS has_mission FROM {sql(ORGS)}")
def b26(spark, d):
    return load(spark, d, ORGS).select("id", S.has_mission(F.col("mission_labels")).alias("has_mission"))


@query(
    "B22_preds_to_label",
    "SELECT s_suppkey AS id, concat_ws(',', CASE WHEN s_suppkey % 2 = 0 THEN 'AHL' END, CASE WHEN s_suppkey % 3 = 0 THEN 'ASF' END, CASE WHEN s_suppkey % 5 = 0 THEN 'AFS' END) AS label FROM supplier",
)
def b22(spark, d):
    rows = load(spark, d, "supplier").selectExpr("s_suppkey AS id", *[f"int(s_suppkey % {n} = 0) AS p{n}" for n in (2, 3, 5)])
    return rows.select("id", S.preds_to_label({"AHL": "p2", "ASF": "p3", "AFS": "p5"}).alias("label"))


@query(
    "B23_stamp_labels",
    f"""SELECT id, short_description, 'model' AS label_type, 'companies' AS dataset, (SELECT strftime(max(o_orderdate), '%Y%m%d-%H%M') FROM orders) AS label_date
 FROM {sql(ORGS)}""",
)
def b23(spark, d):
    at = load(spark, d, "orders").agg(F.max("o_orderdate").cast("timestamp")).scalar()
    return T.stamp_labels(load(spark, d, ORGS).select("id", "short_description"), "model", "companies", at)


@query("C1_org_rounds", f"SELECT o.id AS org_id, o.name AS org_name, r.* EXCLUDE (org_id) FROM {sql(ORGS)} o LEFT JOIN {Q_ROUNDS} r ON r.org_id = o.id")
def c1(spark, d):
    return O.org_rounds(load(spark, d, ORGS), rounds(spark, d))


@query(
    "C2_round_investors",
    f"SELECT funding_round_id, org_id, investor_id, is_lead_investor, investor_types, cb_url FROM {Q_LINKS}",
)
def c2(spark, d):
    out = O.round_investors(rounds(spark, d), load(spark, d, INVESTMENTS), load(spark, d, INVESTORS))
    return out.select("funding_round_id", "org_id", "investor_id", "is_lead_investor", "investor_types", "cb_url")


@query("C3_smart_money", f"SELECT funding_round_id, investor_id, smart_auto, smart_manual, smart_money FROM {Q_LINKS}")
def c3(spark, d):
    return rounds_inv(spark, d).select("funding_round_id", "investor_id", "smart_auto", "smart_manual", "smart_money")


@query(
    "C4_attach_funding",
    f"SELECT id, round(total_grants, 6) AS total_grants, num_grants, round(total_rounds, 6) AS total_rounds, num_rounds FROM {Q_FUNDED}",
)
def c4(spark, d):
    return funded(spark, d).select("id", "num_grants", "num_rounds", *r6("total_grants", "total_rounds"))


@query("C5_has_smart_money", f"SELECT id, has_smart_money FROM {Q_SMART}")
def c5(spark, d):
    return O.has_smart_money(load(spark, d, ORGS), rounds_inv(spark, d)).select("id", "has_smart_money")


@query("C6_is_smart_money", f"SELECT id, smart_money_investor FROM {Q_SMART}")
def c6(spark, d):
    orgs = load(spark, d, ORGS)
    return O.is_smart_money(orgs, rounds_inv(spark, d), orgs.filter(F.col("id") % 2 == 0)).select("id", "smart_money_investor")


TOPICS = ("supplier", "s_suppkey AS id", "s_name AS topic_labels")


@query("C7_attach_topic_labels", f"SELECT o.id, o.name, x.topic_labels FROM {sql(ORGS)} o LEFT JOIN {sql(TOPICS)} x ON x.id = o.id")
def c7(spark, d):
    return O.attach_topic_labels(load(spark, d, ORGS).select("id", "name"), load(spark, d, TOPICS))


Q_TAX = "(SELECT p_type AS \"Subcategory\", min(p_brand) AS \"Category\" FROM part WHERE p_size < 25 GROUP BY 1)"


@query(
    "C9_attach_taxonomy",
    f'SELECT s.p_type, s.n, t."Category" AS category FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1) s LEFT JOIN {Q_TAX} t ON t."Subcategory" = s.p_type',
)
def c9(spark, d):
    parts = load(spark, d, "part")
    tax = parts.filter("p_size < 25").groupBy(F.col("p_type").alias("Subcategory")).agg(F.min("p_brand").alias("Category"))
    return O.attach_taxonomy(parts.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")), tax, "p_type")


@query(
    "C10_org_export",
    f"""SELECT f.id, f.name, f.mission_labels, f.investment_metric, l.last_round FROM {Q_FLAGS} f
 LEFT JOIN (SELECT org_id, max(announced_on) AS last_round FROM {Q_ROUNDS} GROUP BY 1) l ON l.org_id = f.id WHERE has_mission AND in_scope AND is_uk""",
)
def c10(spark, d):
    last = O.latest_per_key(rounds(spark, d), "org_id", "announced_on", "funding_round_id").select(F.col("org_id").alias("id"), F.col("announced_on").alias("last_round"))
    kept = flagged(spark, d).filter("has_mission AND in_scope AND is_uk").select("id", "name", "mission_labels", "investment_metric")
    return kept.join(last, "id", "left")


FUND = ["total_grants", "total_rounds", "total_funding"]


@query(
    "D1_org_funding",
    f"SELECT org_id, num_grants, num_rounds, round(total_grants, 6) AS total_grants, round(total_rounds, 6) AS total_rounds, round(total_grants + total_rounds, 6) AS total_funding FROM {Q_FUNDING}",
)
def d1(spark, d):
    return O.org_funding(rounds_inv(spark, d)).select("org_id", "num_grants", "num_rounds", *r6(*FUND))


@query("D2_date_range", f"SELECT min(announced_on) AS first_date, max(announced_on) AS last_date FROM {Q_ROUNDS}")
def d2(spark, d):
    return O.date_range(rounds(spark, d))


def _summary(by: str) -> str:
    return f"SELECT {by}, count(*) AS total, {', '.join(f'CAST(sum(CAST({f} AS INT)) AS BIGINT) AS total_{f}' for f in FLAGS)}"


@query(
    "D7_mission_summary",
    f"{_summary('mission_labels')} FROM (SELECT * EXCLUDE (mission_labels), unnest(string_split(coalesce(mission_labels, ''), ',')) AS mission_labels FROM {Q_FLAGS}) GROUP BY 1",
)
def d7(spark, d):
    return O.conditional_counts(flagged(spark, d), "mission_labels", FLAGS)


Q_SEGMENTS = """(SELECT c_mktsegment AS "Subcategory", min(r_name) AS "Category" FROM customer JOIN nation ON n_nationkey = c_nationkey
 JOIN region ON r_regionkey = n_regionkey WHERE c_mktsegment < 'M' GROUP BY 1)"""


@query(
    "D8_topic_summary",
    f"""SELECT s.*, t."Category" AS category FROM
 ({_summary('short_description')} FROM (SELECT * REPLACE (coalesce(short_description, '') AS short_description) FROM {Q_FLAGS}) GROUP BY 1) s
 LEFT JOIN {Q_SEGMENTS} t ON t."Subcategory" = s.short_description""",
)
def d8(spark, d):
    nations = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tax = load(spark, d, "customer").filter("c_mktsegment < 'M'").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    tax = tax.groupBy(F.col("c_mktsegment").alias("Subcategory")).agg(F.min("r_name").alias("Category"))
    return O.topic_summary(flagged(spark, d), tax, "short_description", FLAGS)


@query("D17_org_categories", "SELECT DISTINCT p_brand AS category_group, unnest(string_split(p_name, ' ')) AS category FROM part")
def d17(spark, d):
    words = F.explode(S.split_list(F.col("p_name"), " ")).alias("category")
    return load(spark, d, "part").select(F.col("p_brand").alias("category_group"), words).distinct()


@query("D18_unique_ids", "SELECT DISTINCT o_custkey AS id FROM orders")
def d18(spark, d):
    return load(spark, d, "orders").select(F.col("o_custkey").alias("id")).distinct()


@query(
    "E1_latest_per_key",
    f"SELECT org_id, funding_round_id, announced_on FROM {Q_ROUNDS} QUALIFY row_number() OVER (PARTITION BY org_id ORDER BY announced_on DESC, funding_round_id) = 1",
)
def e1(spark, d):
    return O.latest_per_key(rounds(spark, d), "org_id", "announced_on", "funding_round_id").select("org_id", "funding_round_id", "announced_on")


@query(
    "E2_upsert",
    """SELECT id, v, pos FROM (SELECT o_custkey AS id, o_totalprice AS v, o_orderkey AS pos, o_orderkey % 2 AS b FROM orders)
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY b DESC, pos DESC) = 1""",
)
def e2(spark, d):
    rows = load(spark, d, "orders").selectExpr("o_custkey AS id", "o_totalprice AS v", "o_orderkey AS pos")
    return T.upsert(rows.filter("pos % 2 = 0"), rows.filter("pos % 2 = 1"))


@query("E5_distinct_on", "SELECT p_brand, p_type, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1")
def e5(spark, d):
    return T.distinct_on(load(spark, d, "part").select("p_brand", "p_type", "p_partkey"), ["p_brand", "p_type"], ["p_partkey"])


@query("F1_sort_rounds", f"SELECT funding_round_id, announced_on FROM {Q_ROUNDS} ORDER BY announced_on, funding_round_id")
def f1(spark, d):
    return rounds(spark, d).select("funding_round_id", "announced_on").orderBy("announced_on", "funding_round_id")


@query("F2_first_n_ids", f"SELECT id FROM {sql(ORGS)} ORDER BY id LIMIT 10")
def f2(spark, d):
    return load(spark, d, ORGS).select("id").orderBy("id").limit(10)


@query("G2_union_all", "SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS url FROM customer UNION ALL SELECT s_suppkey, s_name, s_name FROM supplier")
def g2(spark, d):
    a = load(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    b = load(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_name AS url")
    return a.unionByName(b, allowMissingColumns=True)


@query("G3_id_union", "SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier")
def g3(spark, d):
    return load(spark, d, "customer").select(F.col("c_custkey").alias("id")).union(load(spark, d, "supplier").select("s_suppkey")).distinct()


@query("G3_id_intersect", "SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders")
def g3b(spark, d):
    return load(spark, d, "customer").select(F.col("c_custkey").alias("id")).intersect(load(spark, d, "orders").select("o_custkey"))


@query("G4_except_rows", "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def g4(spark, d):
    return T.new_rows(load(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), load(spark, d, "orders"), "o_orderkey")


@query("G5_new_rows", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 = 0")
def g5(spark, d):
    rows = load(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    return T.new_rows(rows.filter("id % 3 <> 0"), rows)

