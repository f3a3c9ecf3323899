"""Connected components by label spreading with pointer jumping; each round's state is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.exchange import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b: long); component is the smallest reachable id.

    Each round a vertex takes the smallest label among its neighbours' and then its label's label, so long chains
    close in a logarithmic number of rounds; it runs until nothing changes. Only one count a round reaches the driver.
    """
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")),
                                          F.struct(F.col("b").alias("id"), F.col("a").alias("to")))).alias("e")).select("e.*")
    links = written(both.where(F.col("id") != F.col("to")).distinct(), "links")
    state = written(links.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("component")), "labels")
    while True:
        seen = links.join(state.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("component").alias("near"))
        step = state.join(seen, "id").select("id", F.least("component", "near").alias("new"), F.col("component").alias("old"))
        up = state.select(F.col("id").alias("new"), F.col("component").alias("top"))
        after = written(step.join(up, "new").select("id", F.least("new", "top").alias("component"),
                                                    (F.least("new", "top") != F.col("old")).alias("moved")), "labels")
        changed = after.where("moved").limit(1).count()
        drop_written(state)
        state = after.select("id", "component")
        if not changed:
            drop_written(links)
            return state
