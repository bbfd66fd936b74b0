"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.llm.scratch import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``; a component's name is its smallest id.

    Each round points every id at its smallest neighbour, follows the pointers to their roots by doubling, and
    replaces both ends of every edge by their roots.  Every id that is not the smallest among its neighbours
    disappears, so rounds are few, and edges only become fewer.  Minima are combined in each task before the
    shuffle; an id with very many edges is split by adaptive execution in the joins.  Each round is written to the
    shared folder, and what only an earlier round has read is deleted; the result is a table that ``discard`` takes.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    names = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(
            both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up")).select("id", F.least("id", "up").alias("up")),
            "parents",
        )
        while True:
            above = parents.select(F.col("id").alias("up"), F.col("up").alias("top"))
            jumped = stored(
                parents.select("id", "up").join(above, "up").select("id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "roots"
            )
            discard(parents)
            parents = jumped
            if jumped.where("moved").isEmpty():
                break
        if names is None:
            names = stored(parents.select("id", F.col("up").alias("component")), "components")
        else:
            moved = parents.select(F.col("id").alias("component"), F.col("up").alias("root"))
            before, names = names, stored(
                names.join(moved, "component", "left").select("id", F.coalesce("root", "component").alias("component")),
                "components",
            )
            discard(before)
        low, high = parents.select("id", "up").toDF("a", "root_a"), parents.select("id", "up").toDF("b", "root_b")
        before, edges = edges, stored(
            edges.join(low, "a")
            .join(high, "b")
            .where("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct(),
            "edges",
        )
        discard(before, parents)
    if names is None:
        names = stored(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), "components")
    discard(edges)
    return names
