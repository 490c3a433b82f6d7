"""Connected components and bucketed linking without all-pairs expansion.

``connected_components`` alternates large-star and small-star over an edge
table.  Both are written as a partial ``min`` per node and a join back, so a
hub with millions of neighbours is never collected.

``link`` turns buckets (rows that share a key are candidates) into components
under an exact test, without emitting all pairs of a bucket:

1. Every bucket proposes only its star: each member with the least member.
   Each node keeps its likeliest proposal; the test confirms or refuses it;
   components follow.
2. Pairs that are still in different components, and only those, are then
   proposed from every bucket: within a bucket the members outside its largest
   component meet all members of other components.  A group of n copies that
   step 1 has joined adds no pair here.  An exact bound (``possible``) is tested
   inside the join, so that pairs that cannot pass are never made, and
   ``finer`` may replace the buckets by keys that part those nodes better.
   The likeliest pair of two components is tested first; where it links them,
   their other pairs need no test.

Every bucket pair ends up in one component or is tested, so components equal
those of the full pair list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm._scratch import materialize

MAX_ROUNDS = 60          # doublings; a chain of 2**30 nodes needs fewer


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, v)`` edges -> ``(node, component)`` with component = least node of it.

    Nodes without an edge are not listed.  Loops, NULL ends and repeated edges
    are ignored.  Each half round is written out, so a lost executor never
    replays the rounds before it.
    """
    state = materialize(edges.filter("u is not null and v is not null and u <> v")
                        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    for _ in range(MAX_ROUNDS):
        state = materialize(_small_star(_large_star(state)), name)
        # order-free fingerprint of the edge set: unchanged means converged
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
    raise RuntimeError("components did not converge")


def shared_buckets(buckets: DataFrame, name: str) -> DataFrame:
    """``(key, node)`` rows of buckets with two or more nodes, with the bucket's ``first`` node.

    Not broadcast: the planner does not see how many keys a node was exploded into, so
    millions of keys would pass as a small table and fill the driver.
    """
    ends = (buckets.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
            .filter("first < last").select("key", "first"))
    return materialize(buckets.join(ends.hint("merge"), "key"), f"{name}-buckets")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (key, node, component, ...) of keys with several components, with the key's largest component ``top``."""
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = (sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("groups"))
           .filter("groups > 1").select("key", F.col("top.component").alias("top")))
    return rows.join(top, "key")


def _across(mixed: DataFrame, possible: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs (a < b) of nodes that share a key, lie in different components and are possible."""
    rest = mixed.filter("component <> top").select("key", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("f").alias("fx"))
    # a pair of two rest components is met from both sides; keep one
    met = rest.join(mixed.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & (F.col("component") != F.col("cx"))
                    & ((F.col("component") == F.col("top")) | (F.col("component") < F.col("cx")))
                    & possible(F.col("f"), F.col("fx")))
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _groups(links: DataFrame, name: str) -> DataFrame:
    return connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), name)


def _placed(rows: DataFrame, groups: DataFrame, node: str, component: str) -> DataFrame:
    """``rows`` with the component of ``node`` (the node itself where it has no link)."""
    own = groups.select(F.col("node").alias(node), F.col("component").alias(component))
    return rows.join(own, node, "left").withColumn(component, F.coalesce(component, node))


def link(shared: DataFrame, score: Callable[[DataFrame], DataFrame], confirm: Callable[[DataFrame], DataFrame],
         name: str, possible: Callable[[Column, Column], Column],
         finer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(node, component)`` of the nodes that link, from ``shared_buckets``.

    ``score``   (a, b) -> (a, b, score): drops hopeless pairs, rates the others.
    ``confirm`` (a, b) -> (a, b): keeps the pairs that pass the exact test.
    ``possible`` condition on the structs ``f`` of two rows that every passing pair
                fulfils under one of its shared keys; without ``finer``, f is (node).
    ``finer``   (node) -> (key, node, f) for the nodes left in mixed buckets, such that
                every passing pair of them shares a key.
    """
    stars = shared.select(F.col("first").alias("a"), F.col("node").alias("b")).filter("a < b").distinct()
    best = (score(stars).groupBy("b").agg(F.max(F.struct("score", "a")).alias("best"))
            .select(F.col("best.a").alias("a"), "b"))
    links = materialize(confirm(best), f"{name}-stars")
    groups = _groups(links, f"{name}-1")

    def placed(rows: DataFrame) -> DataFrame:
        return _placed(rows, groups, "node", "component")

    mixed = _mixed(placed(shared.select("key", "node", F.struct("node").alias("f"))))
    if finer:
        mixed = _mixed(materialize(placed(finer(materialize(mixed.select("node").distinct(), f"{name}-left"))), f"{name}-finer"))
    rated = materialize(score(_across(mixed, possible)), f"{name}-rated")
    # the likeliest pair of two components speaks for them; the others only where it fails
    apart = _placed(_placed(rated, groups, "a", "ca"), groups, "b", "cb")
    likeliest = materialize(apart.groupBy(F.least("ca", "cb"), F.greatest("ca", "cb"))
                            .agg(F.max(F.struct("score", "a", "b")).alias("p")).select("p.a", "p.b"), f"{name}-first")
    links = materialize(links.unionByName(confirm(likeliest)), f"{name}-likeliest")
    groups = _groups(links, f"{name}-2")
    others = _placed(_placed(rated, groups, "a", "ca"), groups, "b", "cb").filter("ca <> cb").select("a", "b")
    more = materialize(confirm(others.join(likeliest, ["a", "b"], "left_anti")), f"{name}-rest")
    return _groups(links.unionByName(more), f"{name}-3")
