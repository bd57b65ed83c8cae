"""Distributed union-find on DataFrames and the linking of bucketed candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest member of each component for edges ``(a, b)`` with a < b; returns ``(node, component)``.

    Alternates large-star and small-star steps until the edges no longer change. Every step is a
    grouped minimum and a join on the node; each round is written to the shared folder. Nodes
    without an edge are not returned; no edges give an empty result.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(edges.select("a", "b").where("a < b").distinct(), name)
    now = state(edges)
    while now[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        old, edges = edges, written(small.unionAll(low.select(F.col("m").alias("a"), "b")).distinct(), name)
        discard(old)
        before, now = now, state(edges)
        if before == now:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def link_buckets(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], cross: Callable[[DataFrame], DataFrame] | None = None, name: str = "links", rounds: int = 1, carry: tuple[str, ...] = (), fits: str = "true") -> DataFrame:
    """Components of items that share a bucket and pass ``verify``; returns ``(node, component)``.

    ``postings`` has ``(bucket, item, ...)``; ``verify`` takes distinct pairs ``(a, b)`` with a < b and
    returns those that are links. In each star round the items of a bucket are compared with one of them: first with the hub, the item with the most bucket
    mates over all (the original of a group of copies), then with others. Buckets whose items are all
    in one component are done, and so is the first hub. Once the pairs left between components are fewer than the postings, or
    a round finds no link, those pairs are compared, so that no link between components is lost.
    ``cross`` may find those links from the postings (with columns ``component`` and ``hub``, the first round's) by an operator's
    own candidate filter. ``fits`` is a cheap, symmetric test of star pairs over the postings' columns
    ``carry``, which it sees as ``<name>_a`` and ``<name>_b``.
    """
    sizes = postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    posted = postings.join(sizes, "bucket")
    hubs = posted.groupBy("item").agg(F.sum("mates").alias("weight"))
    posted = written(posted.drop("mates").join(hubs, "item").withColumn("component", F.col("item")), name)
    links, components = None, None
    for turn in range(rounds):
        order = F.struct("weight", "item") if turn % 2 == 0 else F.struct(F.xxhash64(F.lit(turn), "item"), "item")
        # later hubs come from the items that the bucket's hub so far has not drawn in
        center = F.struct("item", "component", *carry)
        centers = posted.groupBy("bucket").agg(F.max_by(center, order).alias("c"))
        if turn and turn % 2 == 0:
            away = posted.join(centers, "bucket").where("component <> c.component").drop("c")
            centers = away.groupBy("bucket").agg(F.max_by(center, order).alias("c"))
        star = posted.select("bucket", "item", "component", *carry).join(centers, "bucket").where("component <> c.component")
        star = star.withColumns({f"{c}_a": F.col(c) for c in carry} | {f"{c}_b": F.col(f"c.{c}") for c in carry}).where(fits)
        pairs = star.select(F.least("item", "c.item").alias("a"), F.greatest("item", "c.item").alias("b")).distinct()
        found = written(verify(pairs).select("a", "b"), name)
        new = found.count()
        links = found if links is None else links.unionAll(found)
        if new:
            components = written(connected_components(links, name), name)
        if new or not turn:
            old, posted = posted, written(_mixed(posted, components, None if turn else order), name)
            discard(old)
        if turn + 1 == rounds:
            break
        per = posted.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        all_, own = (per.groupBy("bucket").agg(F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("s")).agg(F.sum((F.col("n") * F.col("n") - F.col("s")) / 2), F.sum("n")).first())
        if not new or (all_ or 0) <= (own or 0):
            break
    if cross is None:
        one, two = (posted.select("bucket", F.col("item").alias(i), F.col("component").alias(c)) for i, c in (("x", "cx"), ("y", "cy")))
        found = verify(one.join(two, "bucket").where("x < y and cx <> cy").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    else:
        found = cross(posted)
    found = written(found.select("a", "b"), name)
    discard(posted)
    if components is None or not found.isEmpty():
        components = connected_components(links.unionAll(found), name)
    return components


def link_hubs(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], cross: Callable[[DataFrame], DataFrame], name: str = "links") -> DataFrame:
    """:func:`link_buckets` in one round, of postings ``(bucket, item, mates)`` of which each is there once; ``mates`` counts the bucket's items.

    The postings are dealt twice, by item for the hubs' order and by bucket for the hubs; those of hubs end
    there, and those of buckets of two once their pair has been compared.
    """
    weighed = postings.withColumn("weight", F.sum("mates").over(W.partitionBy("item")))
    hubbed = weighed.withColumn("hub", F.max_by("item", F.struct("weight", "item")).over(W.partitionBy("bucket")))
    met = written(hubbed.where("item <> hub").select("bucket", "item", "hub", "mates"), name)
    links = written(verify(met.select(F.least("item", "hub").alias("a"), F.greatest("item", "hub").alias("b")).distinct()).select("a", "b"), name)
    components = written(connected_components(links, name), name)
    posted = written(_mixed(met.where("mates > 2").drop("mates"), components), name)
    discard(met)
    found = written(cross(posted).select("a", "b"), name)
    discard(posted)
    return components if found.isEmpty() else connected_components(links.unionAll(found), name)


def _mixed(postings: DataFrame, components: DataFrame | None, order: Column | None = None) -> DataFrame:
    """The postings, with each item's component, of the buckets that hold more than one component.

    With the ``order`` of the hubs, a bucket's ``hub`` is a column, and no row: it has been compared with all others.
    """
    with_component = postings
    if components is not None:
        with_component = postings.drop("component").join(components.withColumnRenamed("node", "item"), "item", "left").withColumn("component", F.coalesce("component", "item"))
    own = W.partitionBy("bucket")
    if order is not None:
        with_component = with_component.withColumn("hub", F.max_by("item", order).over(own)).where("item <> hub")
    return with_component.withColumns({"lo": F.min("component").over(own), "hi": F.max("component").over(own)}).where("lo <> hi").drop("lo", "hi")
