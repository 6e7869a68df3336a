"""Connected components of a link table by alternating large and small stars, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; `b` is the smaller end of a link."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is the least node in reach. Columns a, b."""
    stars = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    while True:
        after = materialize(_small(_large(stars)), "stars")
        # done when every node points to one root and no root points on
        roots = after.select("b").distinct().withColumnRenamed("b", "a")
        pending = (after.join(roots, "a", "left_semi").limit(1).count()
                   or after.groupBy("a").count().where("count > 1").limit(1).count())
        stars = after
        if not pending:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
