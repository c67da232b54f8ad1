"""URL filtering: rules, and a character language-model ratio where no rule fits.

URLs that a rule allows or blocks train one variable-order Markov model each.  The
probability of a character after a context of up to ``ORDER`` characters interpolates
the orders (Witten-Bell): P_k = (c + t * P_(k-1)) / (n + t) with c the count of the
character there, n of the context, t its distinct followers.  A URL's score is its
mean log-ratio a character; the cut is calibrated where accepted and rejected
URLs of a fold kept from training are parted with the least balanced error.  The models have
one number for each of the 37^4 grams, whatever the table's size, so they are held as
an array in which a URL's characters are looked up where the URL is.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common

#: (host, path, verdict); a rule fits its host and all subdomains, and paths that start with its own.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
ORDER = 3
#: Symbols the models tell apart: start, end, letters, digits as one, the punctuation of URLs; all else is one symbol.
SYMBOLS = "^$*abcdefghijklmnopqrstuvwxyz0-._~/%:"
SIZE = len(SYMBOLS)
#: One in so many of the URLs that a rule judges calibrates the cut instead of training the models.
FOLDS = 5


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    u = F.col(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return common.lower_ascii(host), path


def rule_of(rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) columns over host and path: the longest fitting rule's, else null."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def fits(r) -> Column:
        return ((F.col("host") == r[0]) | F.col("host").endswith("." + r[0])) & F.col("path").startswith(r[1])

    rule = reduce(lambda c, r: c.when(fits(r), r[0] + r[1]), ordered[1:], F.when(fits(ordered[0]), ordered[0][0] + ordered[0][1]))
    verdict = reduce(lambda c, r: c.when(fits(r), r[2]), ordered[1:], F.when(fits(ordered[0]), ordered[0][2]))
    return rule, verdict


def symbols(host: str = "host", path: str = "path") -> Column:
    """The numbers of the URL's symbols, with a start context before them and an end mark after them."""
    folded = F.regexp_replace(F.translate(F.lower(F.concat(host, path)), "123456789", "000000000"), r"[^a-z0\-._~/%:]", "*")
    numbers = [SYMBOLS.find(chr(i)) for i in range(128)]
    codes = F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), lambda c: F.element_at(F.lit(numbers), F.ascii(c) + 1))
    start, end = F.array(*[F.lit(SYMBOLS.index("^"))] * ORDER), F.array(F.lit(SYMBOLS.index("$")))
    return F.concat(start, codes, end)


def _numbers(codes: str) -> Column:
    """The number, in base SIZE, of each gram of ORDER + 1 symbols."""
    at = F.sequence(F.lit(0), F.size(codes) - ORDER - 1)
    return F.transform(at, lambda i: sum(F.get(F.col(codes), i + j) * F.lit(SIZE ** (ORDER - j)) for j in range(ORDER + 1)).cast("long"))


def positions(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per scored character: the columns of ``keep`` and the number of its gram."""
    coded = urls.select(*keep, symbols().alias("_codes"))
    return coded.select(*keep, F.explode(_numbers("_codes")).alias("gram"))


def train(urls: DataFrame) -> DataFrame:
    """One row, ``scores``: for each gram, by its first symbol and the rest, the log-ratio of accepted to rejected probability.

    ``urls``: (host, path, verdict).  At most SIZE^(ORDER + 1) grams meet.
    """
    spark = urls.sparkSession
    told = positions(urls, "verdict").groupBy("gram").agg(
        *[F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).alias(f"c_{m}") for m, v in (("a", "allow"), ("b", "block"))]
    )
    told = common.cut(told)
    lower = None
    for k in range(ORDER + 1):
        below = SIZE**k
        own = told.groupBy((F.col("gram") % (below * SIZE)).alias("gram")).agg(F.sum("c_a").alias("c_a"), F.sum("c_b").alias("c_b"))
        sums = [(F.sum(f"c_{m}").alias(f"n_{m}"), F.sum(F.when(F.col(f"c_{m}") > 0, 1).otherwise(0)).alias(f"t_{m}")) for m in "ab"]
        context = own.groupBy(F.expr(f"gram div {SIZE}").alias("context")).agg(*[x for both in sums for x in both])
        every = spark.range(below * SIZE).select(F.col("id").alias("gram"), F.expr(f"id div {SIZE}").alias("context"), (F.col("id") % below).alias("rest"))
        every = every.join(own, "gram", "left").join(context, "context", "left")
        if lower is None:
            every = every.withColumns({f"q_{m}": F.lit(1.0 / SIZE) for m in "ab"})
        else:
            every = every.join(F.broadcast(lower), "rest")  # SIZE^ORDER rows at most
        p = []
        for m in "ab":
            c, n, t = (F.coalesce(F.col(f"{x}_{m}"), F.lit(0)) for x in "cnt")
            p.append(F.when(n > 0, (c + t * F.col(f"q_{m}")) / (n + t)).otherwise(F.col(f"q_{m}")).alias(f"q_{m}"))
        lower = every.select(F.col("gram").alias("rest"), *p)
    rows = lower.select(F.col("rest").alias("gram"), (F.log("q_a") - F.log("q_b")).cast("float").alias("score"))
    first = F.expr(f"gram div {SIZE**ORDER}")
    rows = rows.groupBy(first.alias("first")).agg(F.sort_array(F.collect_list(F.struct("gram", "score"))).alias("of"))
    rows = rows.select(F.struct("first", F.col("of.score").alias("scores")).alias("row"))
    return common.cut(rows.agg(F.sort_array(F.collect_list("row")).alias("rows")).select(F.col("rows.scores").alias("scores")))


def scores(urls: DataFrame, model: DataFrame, key: str) -> DataFrame:
    """(key, score): each URL's mean log-ratio of accepted to rejected probability."""
    of_first = F.element_at(model.scalar(), (F.expr(f"gram div {SIZE**ORDER}") + 1).cast("int"))
    ratio = F.element_at(of_first, (F.col("gram") % SIZE**ORDER + 1).cast("int"))
    return positions(urls, key).groupBy(key).agg(F.avg(ratio).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The score at which accepted and rejected URLs are parted with the least balanced error.

    ``scored``: (score, verdict, held).  URLs of the held fold count, or all if that lacks a kind.  Candidates
    are a fixed grid of scores, so what meets is bounded.  Without both kinds: minus infinity (all pass).
    """
    kinds = [(f"{m}{h}", (F.col("verdict") == v) & (F.col("held") | F.lit(bool(h)))) for m, v in (("a", "allow"), ("b", "block")) for h in (0, 1)]
    grid = scored.groupBy(F.round("score", 2).alias("cut")).agg(*[F.sum(F.when(x, 1).otherwise(0)).alias(k) for k, x in kinds]).filter("cut is not null")
    total = grid.agg(*[F.sum(k) for k, _ in kinds]).first()
    a0, a1, b0, b1 = (x or 0 for x in total)
    h, a, b = (0, a0, b0) if a0 and b0 else (1, a1, b1)
    if not (a and b):
        return float("-inf")
    below = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    error = F.sum(f"a{h}").over(below) / a + 1 - F.sum(f"b{h}").over(below) / b
    return float(grid.withColumn("error", error).orderBy("error", "cut").select("cut").first()[0]) + 0.005


def judge(pages: DataFrame, rules: tuple = RULES, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Judge every URL: page_id, host, path, rule, verdict, score, one row per input row.

    A rule decides where one fits; else the model does: allow if the score reaches the
    calibrated cut.  A null URL, or one without ``://``, has empty host and path and is
    scored as such.  If the rules allow none
    or block none of the rows, the model allows all.  An empty table gives no rows;
    other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url"))
    host, path = host_and_path("_url")
    rule, verdict = rule_of(rules)
    rows = rows.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("verdict", verdict)
    held = F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS)) == 0
    # written, so that a row's number stays
    rows = common.cut(rows.withColumn("held", held).withColumn("row", F.monotonically_increasing_id()))
    model = train(rows.filter(F.col("verdict").isNotNull() & ~F.col("held")))
    scored = common.cut(rows.join(scores(rows, model, "row"), "row"))
    cut_at = calibrate(scored.filter(F.col("verdict").isNotNull()))
    told = F.coalesce("verdict", F.when(F.col("score") >= F.lit(cut_at), "allow").otherwise("block")).alias("verdict")
    return scored.select("page_id", "host", "path", "rule", told, "score")
