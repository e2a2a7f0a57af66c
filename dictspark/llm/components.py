"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of a link; ``root`` is the smallest node that it can reach.

    ``links`` holds pairs of long ids in any order; repeated pairs, both directions, loops and pairs with a null are allowed.
    A round hangs the larger neighbours of every node under its smallest neighbour, then the smaller ones, and writes the
    links to the shared folder. The rounds grow with the logarithm of the longest path. A node with very many neighbours is
    aggregated before the shuffle, and the join that gives its smallest neighbour back can be split by Spark.
    """
    small, large = F.least(a, b), F.greatest(a, b)
    now = cut(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(large.cast("long").alias("u"), small.cast("long").alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        ends = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        up = now.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        was, mark, now = mark, _mark(after), after
        if mark == was:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
