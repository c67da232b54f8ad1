"""Density clusters with outliers: a hierarchy over a nearest-neighbour graph, cut by excess of mass.

Edges weigh the mutual reachability distance: the larger of their length and of the core
distances of both ends.  From the least threshold to the greatest, the components that edges
up to it join are merged, so each round works on what the round before left over.  A component of
``least`` points is a cluster while it loses only smaller ones.  Sizes, stabilities and
choices are aggregated along the merges, upwards and back; no task ever sees a
whole component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .nearest import nearest

#: Copies of a table of moves, over which the rows that follow one move are spread.
SALTS = 8
#: Distances below count as this, so that densities stay finite.
CLOSEST = 1e-9


def _follow(rows: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    """``rows`` with ``column`` moved (moves: node, to); a node that many rows hold is spread over several tasks."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    copies = moves.select(F.col("node").alias(column), F.col("to").alias("_to"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return salted.join(copies, [column, "_salt"], "left").withColumn(column, F.coalesce("_to", column)).select(*rows.columns)


def merged(pairs: DataFrame) -> DataFrame | None:
    """node -> to, the same for all nodes that ``pairs`` (a, b) connect; None without pairs.

    Each node moves to the one of least hash among itself and its neighbours, then pairs are renamed, until
    none is left.  Hashes keep chains short, whatever the order of ids.
    """
    total = None
    pairs = kept(pairs.filter("a <> b").distinct())
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))).alias("m"))
        moves = kept(least.select("node", F.least(F.col("m"), F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("to")))["to"].alias("to")))
        total = moves if total is None else kept(_follow(total, "to", moves))
        pairs = kept(_follow(_follow(pairs, "a", moves), "b", moves).filter("a <> b").distinct())
    return total


def reachability(points: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct points (id: the least, v, weight, core) and the edges of their nearest-neighbour graph (a, b, w).

    core: the distance within which ``k`` points lie, a point itself and its copies included.
    """
    distinct = kept(points.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")))
    near = kept(nearest(distinct.select("id", "v"), distinct.select("id", "v"), k))
    sized = near.join(distinct.select(F.col("id").alias("n_id"), "weight"), "n_id")
    ordered = sized.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "n_id", "weight"))).alias("near"))  # k entries at most
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("core"))

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + x["weight"]
        return F.struct(n.alias("n"), F.when(acc["core"].isNull() & (n >= k), x["d"]).otherwise(acc["core"]).alias("core"))

    found = F.aggregate("near", start, add)["core"]
    cores = ordered.select("id", F.coalesce(found, F.element_at("near", -1)["d"]).alias("core"))  # fewer than k points: the farthest
    distinct = kept(distinct.join(cores, "id"))
    edges = near.filter("id <> n_id").join(cores, "id").join(cores.select(F.col("id").alias("n_id"), F.col("core").alias("n_core")), "n_id")
    return distinct, kept(edges.select(F.col("id").alias("a"), F.col("n_id").alias("b"), F.greatest("d", "core", "n_core").alias("w")))


def density_clusters(points: DataFrame, k: int = 5, least: int = 5, levels: int = 12) -> DataFrame:
    """Topic and membership probability of each point (id long unique, v array<double>): id, topic, probability.

    The topic is the smallest id of its cluster, -1 for outliers (probability 0).  Neighbours are exact.  The
    hierarchy has at most ``levels`` thresholds, quantiles of the edges' weights, and a merge counts at the
    first threshold that reaches it.  A cluster is chosen if its stability (points times the density range in
    which they belong to it) is at least that of the best choice inside it; where all of the dense points form one cluster
    it is not chosen.  The probability is a point's density over the cluster's greatest.  Vectors must not hold nulls; an
    empty table gives no rows.
    """
    distinct, edges = reachability(points.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v")), k)
    cuts = edges.agg(F.percentile_approx("w", [i / levels for i in range(1, levels)], 10_000).alias("q"), F.max("w").alias("most"), F.max("w").isNull().alias("none")).first()
    top_core = distinct.agg(F.max("core")).first()[0]
    ends = sorted({float(x) for x in [*(cuts["q"] or []), cuts["most"], top_core] if x is not None})
    if not ends:
        return points.select(F.col("id").cast("long").alias("id"), F.lit(-1).cast("long").alias("topic"), F.lit(0.0).alias("probability"))
    density = [1 / max(t, CLOSEST) for t in ends] + [0.0]

    def level(w: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(t) for t in ends]), lambda t: t < F.col(w)))

    pairs = edges.select("a", "b", level("w").alias("at"))
    nodes = distinct.select(
        F.col("id").alias("comp"),
        F.col("weight").cast("long").alias("size"),
        level("core").alias("active"),  # copies are one only from their core distance on
        F.lit(False).alias("big"),
        F.lit(0.0).alias("own"),
        F.lit(0.0).alias("inside"),
        F.lit(-1).alias("bottom"),
    )
    children = []
    for n in range(len(ends)):
        moves = merged(pairs.filter(F.col("at") <= n).select("a", "b"))
        renamed = nodes.withColumn("parent", F.col("comp"))
        if moves is not None:
            renamed = _follow(renamed, "parent", moves)
            left = _follow(_follow(pairs.filter(F.col("at") > n), "a", moves), "b", moves)
            pairs = kept(left.filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("at").alias("at")))
        grown = renamed.withColumn("best", F.when(F.col("big"), F.greatest("own", "inside")))
        children.append(kept(grown))
        one = F.col("n_big") == 1
        total = children[-1].groupBy("parent").agg(
            F.sum("size").alias("size"),
            F.min("active").alias("active"),
            F.count(F.when(F.col("big"), 1)).alias("n_big"),
            F.max(F.when(F.col("big"), F.col("own"))).alias("own_1"),
            F.max(F.when(F.col("big"), F.col("inside"))).alias("inside_1"),
            F.max(F.when(F.col("big"), F.col("bottom"))).alias("bottom_1"),
            F.sum("best").alias("bests"),
        )
        nodes = kept(
            total.select(
                F.col("parent").alias("comp"),
                "size",
                "active",
                ((F.col("size") >= least) & (F.col("active") <= n)).alias("big"),
                (F.when(one, F.col("own_1")).otherwise(0.0) + F.col("size") * F.lit(density[n] - density[n + 1])).alias("own"),
                F.when(one, F.col("inside_1")).when(F.col("n_big") > 1, F.col("bests")).otherwise(0.0).alias("inside"),
                F.when(one, F.col("bottom_1")).otherwise(F.lit(n)).alias("bottom"),
            )
        )
    # back down: the topmost chosen cluster on a point's way names it; ``left`` is the level at which it left the dense part
    several = nodes.filter("big").limit(2).count() > 1
    chosen = F.col("big") & F.lit(several) & (F.col("own") >= F.col("inside"))
    down = nodes.select(
        "comp",
        "big",
        F.when(chosen, F.struct(F.lit(len(ends)).alias("at"), F.col("comp").alias("comp"), F.col("bottom").alias("bottom"))).alias("label"),
        F.when(~F.col("big"), F.lit(len(ends))).alias("left"),
    )
    for n in range(len(ends) - 1, -1, -1):
        above = down.select(F.col("comp").alias("parent"), F.col("big").alias("up"), F.col("label").alias("up_label"), F.col("left").alias("up_left"))
        splits = children[n].filter("big").groupBy("parent").agg((F.count(F.lit(1)) > 1).alias("splits"))
        rows = children[n].join(above, "parent").join(splits, "parent", "left")
        fresh = F.col("big") & F.coalesce("splits", F.lit(False)) & (F.col("own") >= F.col("inside"))
        label = F.when(fresh, F.struct(F.lit(n).alias("at"), F.col("comp").alias("comp"), F.col("bottom").alias("bottom")))
        down = kept(
            rows.select(
                "comp",
                "big",
                F.coalesce("up_label", label).alias("label"),
                F.when(F.col("big"), F.lit(None)).when(F.col("up"), F.lit(n)).otherwise(F.col("up_left")).cast("int").alias("left"),
            )
        )
    density_at = F.array(*[F.lit(x) for x in density])
    own, best = F.element_at(density_at, F.col("left") + 1), F.element_at(density_at, F.col("label.bottom") + 1)
    labelled = down.select(F.col("comp").alias("rep"), "label", F.when(F.col("label").isNotNull(), F.least(own, best) / best).alias("probability"))
    members = points.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v")).join(distinct.select("v", F.col("id").alias("rep")), "v")
    members = kept(members.select("id", "rep").join(labelled, "rep"))
    names = members.filter("label is not null").groupBy("label").agg(F.min("id").alias("topic"))
    return members.join(names, "label", "left").select("id", F.coalesce("topic", F.lit(-1).cast("long")).alias("topic"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
