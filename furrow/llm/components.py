"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.workspace import materialize


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links (a long, b long)``: the smallest node it is connected with.

    Each round a node takes the smallest root among its own and its neighbours' and then that root's root, so paths
    halve. A round is written to the workspace, which cuts the lineage; only the number of changes comes back.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a != b").distinct(), "links")
    roots = materialize(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")),
        "roots",
    )
    changed = roots.limit(1).count()
    while changed:
        offered = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("near"))
        taken = materialize(
            roots.join(offered, roots["node"] == offered["a"]).select(
                "node", F.col("root").alias("before"), F.least("root", "near").alias("root")
            ),
            "roots-taken",
        )
        of_root = taken.select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = materialize(
            taken.join(of_root, "root").select("node", "before", F.col("further").alias("root")), "roots"
        )
        changed = roots.where("root != before").count()
        roots = roots.drop("before")
    return roots
