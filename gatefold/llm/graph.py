"""Connected components of a large edge table, without collecting it and without hot joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatefold.llm.common import discard, join_hot, stored


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex that isn't the smallest of its component; edges: (a, b).

    Edges point from the larger vertex to the smaller.  Each round links all smaller neighbours of a
    vertex to the least of them (so every vertex ends with one parent) and then replaces parents by
    grandparents, until nothing is left to do: a logarithmic number of rounds on shallow graphs.
    Each round is a written table, so a lost executor never replays the loop.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("c"), F.least("a", "b").alias("p"))
    now = stored(links.distinct(), "edges")
    while True:
        least = now.groupBy("c").agg(F.min("p").alias("q"))
        both = now.join(least, "c").select(F.explode(F.array(F.struct("c", F.col("q").alias("p")), F.struct(F.col("p").alias("c"), F.col("q").alias("p")))).alias("e"))
        star = stored(both.select("e.c", "e.p").filter("c <> p").distinct(), "star")
        up = star.groupBy("c").agg(F.min("p").alias("q"), F.count(F.lit(1)).alias("n"))
        sons = star.groupBy("p").agg(F.count(F.lit(1)).alias("w"))
        # roots are in this table too, without a parent: they have the most sons
        parents = sons.join(up.select(F.col("c").alias("p"), "q"), "p", "left")
        jumped = join_hot(star, parents, ["p"], "w").select("c", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved"))
        jumped = stored(jumped, "jump")
        discard(now, star)
        todo = jumped.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.max("moved").alias("m")).filter("n > 1 or m").limit(1).count()
        now = jumped.select("c", "p").distinct()
        if not todo:
            return now.select(F.col("c").alias("v"), F.col("p").alias("root"))
        now = stored(now, "edges")
        discard(jumped)
