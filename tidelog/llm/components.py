"""Connected components of a link table, as a distributed union-find.

Alternates the large star and the small star (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every node hangs its larger neighbours, then
its smaller ones, on the smallest node it sees. Links stay linear in number and the
rounds grow with the square of the logarithm of the nodes at most. The smallest
neighbour of a node comes from a partial and a final aggregate; the join that
follows may be split by adaptive execution, as one node may hold a third of all
links. Rounds end once one aggregate shows that all links are stars. Links that come
later join the components known so far, so that only these are contracted again. Each
round is a table in the shared folder, so a lost executor costs one round at most, and
nothing is gathered on the driver but whether a node has several tops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, written
from tidelog.session import fits_broadcast


def _nearest(pairs: DataFrame) -> DataFrame:
    """The smallest of `u` and its partners `v`, for each u."""
    return pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _round(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
    # larger partners go to the smallest one, and the node itself keeps its link to that
    large = both.join(_nearest(both), "u").where("v > u OR v = m").selectExpr("greatest(u, v) AS u", "m AS v")
    # here u > v: every partner of u is smaller
    return large.join(_nearest(large), "u").selectExpr("IF(v = m, u, v) AS u", "m AS v").distinct()


def _nodes(links: DataFrame) -> DataFrame:
    """(node, component) of every end of links whose `v` is a component."""
    tops = links.selectExpr("v AS node", "v AS component")
    return links.selectExpr("u AS node", "v AS component").unionByName(tops)


def _are_stars(links: DataFrame) -> bool:
    """True when every node has one component only."""
    several = _nodes(links).groupBy("node").agg(F.min("component").alias("a"), F.max("component").alias("z"))
    return several.where("a < z").isEmpty()


def with_component(rows: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """`rows` with the component of the node in column `node`: itself where it has no links."""
    named = found.selectExpr(f"node AS {node}", f"component AS {name}")
    return rows.join(named, node, "left").withColumn(name, F.coalesce(name, node))


def components(links: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(node, component) of every node in `links` (u, v); the component is its smallest node.

    With `found`, the result for other links, both count. The result is a written table,
    marked for broadcasts if its measured size allows.
    """
    if found is not None:
        links = with_component(with_component(links, found, "u", "p"), found, "v", "q").selectExpr("p AS u", "q AS v")
    links = written(links.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "links")
    while not _are_stars(links):
        last, links = links, written(_round(links), "links")
        discard(last)
    rows = _nodes(links)
    if found is not None:
        # a top is the component of itself
        tops = links.selectExpr("u AS node", "v AS component")
        before = found.selectExpr("node AS before", "component AS node")
        rows = rows.unionByName(
            with_component(before, tops, "node", "component").selectExpr("before AS node", "component")
        )
    made = written(rows.distinct(), "components")
    discard(links)
    marked = F.broadcast(made) if fits_broadcast(made) else made
    marked._scratch = made._scratch
    return marked
