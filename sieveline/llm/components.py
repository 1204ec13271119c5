"""Connected components by spreading least labels and jumping along them; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(v, c, and c before the last round) for every end of an edge (a, b): c is the smallest vertex of its component."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("c")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("least"))
        spread = labels.join(near, labels["v"] == near["a"]).select("v", "c", F.least("c", "least").alias("least"))
        far = labels.select(F.col("v").alias("least"), F.col("c").alias("further"))
        step = spread.join(far, "least").select("v", F.col("c").alias("before"), F.least("least", "further").alias("c"))
        old, labels = labels, stored(step, "labels")
        discard(old)
        if labels.filter(F.col("c") < F.col("before")).isEmpty():
            discard(both)
            return labels
