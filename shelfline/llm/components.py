"""Connected components by label spreading and pointer jumping, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's smallest node.

    Each round takes the smallest label among a node's neighbours, then the label of that
    label, and is written to the shared folder. Rounds grow with the logarithm of the
    longest chain. The neighbours' minimum is aggregated before the shuffle, so a node with
    very many neighbours costs one row per task; joins on such a node meet a side that has
    one row per node, which adaptive execution splits. No edges give no rows.
    """
    both = staged(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges"
    )
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("heard"))
        heard = staged(
            labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "heard").alias("next")),
            "labels",
        )
        # The label of a label; a root always is a node itself.
        jump = heard.select(F.col("node").alias("next"), F.col("next").alias("further"))
        labels = staged(
            heard.join(jump, "next").select("node", F.least("next", "further").alias("root"), (F.least("next", "further") < F.col("root")).alias("moved")),
            "labels",
        )
        if labels.filter("moved").isEmpty():
            return labels.select("node", "root")
