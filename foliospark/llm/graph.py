"""Connected components of a table of links, never held by one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.tables import narrow


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the links (a, b); root is the smallest node reachable.

    Every round takes the smallest root among the neighbours and then the root of
    that root, so the number of rounds follows the logarithm of a chain's length.
    Each round is a table in the shared folder. No links give no rows.
    """
    both = narrow(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    roots = narrow(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("a").alias("b"), F.col("root").alias("r")), "b")
        least = near.groupBy("a").agg(F.min("r").alias("r"))
        hooked = roots.join(least, "a").select(
            "a", F.col("root").alias("old"), F.least("root", "r").alias("root")
        )
        above = roots.select(F.col("a").alias("root"), F.col("root").alias("top"))
        moved = hooked.join(above, "root").select(
            "a", F.col("top").alias("root"), (F.col("top") != F.col("old")).alias("moved")
        )
        moved = narrow(moved, "roots")
        roots = moved.select("a", "root")
        if moved.where("moved").isEmpty():
            return roots.withColumnRenamed("a", "node")
