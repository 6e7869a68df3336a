"""Equi-joins with the care that outer joins and key checks need on skewed data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def keyed(rows: DataFrame, name: str, alias: str) -> DataFrame:
    """The unique side of a join: its rows with a key, and a computed copy of the key to join on.

    That side usually comes out of a deduplication and is partitioned by the key already. The copy
    hides this, so Spark shuffles it once more for the join. AQE splits a hot key of the other side
    only where both inputs come straight from a shuffle; joined in place, behind the window of the
    deduplication, a key that holds a third of the facts would stay in one task. The copy is
    declared non-null: no extra filter reaches the deduplication, whose shuffle stays shareable.
    """
    present = rows.where(F.col(name).isNotNull())
    if isinstance(rows.schema[name].dataType, T.StringType):
        return present.withColumn(alias, F.coalesce(F.concat(F.col(name), F.lit("")), F.lit("")))
    return present.withColumn(alias, F.col(name))


def lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str,
           columns: dict[str, str], spread_by: Sequence[str] = (), matched: str | None = None) -> DataFrame:
    """Left join that adds ``columns`` (dimension name -> output name) to the facts.

    ``spread_by`` names fact columns that vary from row to row. Fact rows without a key can match
    nothing, yet an outer join would send all of them to one task; with ``spread_by`` their join
    key is replaced by a hash of those columns, and a second key keeps them from ever matching.
    ``matched`` names an optional flag that tells whether the key was found.
    """
    picked = [F.col(name).alias(f"_dim_{name}") for name in columns]
    side = keyed(dimension, dimension_key, "_dim_key").select("_dim_key", *picked)
    probe, absent = F.col(fact_key), F.col(fact_key).isNull()
    if spread_by:
        scattered = F.concat(F.lit("absent-"), F.xxhash64(*[F.col(name) for name in spread_by]).cast("string"))
        probe = F.coalesce(probe, scattered)
        side = side.withColumn("_dim_absent", F.lit(False))
        facts = facts.withColumn("_probe", probe).withColumn("_absent", absent)
        condition = (F.col("_probe") == F.col("_dim_key")) & (F.col("_absent") == F.col("_dim_absent"))
    else:
        condition = probe == F.col("_dim_key")
    added = [F.col(f"_dim_{name}").alias(output) for name, output in columns.items()]
    if matched:
        added.append(F.col("_dim_key").isNotNull().alias(matched))
    kept = [name for name in facts.columns if name not in ("_probe", "_absent")]
    return facts.join(side, condition, "left").select(*kept, *added)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent, each with the number of child rows that carry it.

    Children are counted per key first: the join sees each key once, however often it occurs.
    """
    references = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("orphan_key")).agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(F.col(parent_key).alias("_known"))
    return references.join(known, F.col("orphan_key") == F.col("_known"), "left_anti")


def known_key_share(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: how many non-null foreign keys there are, and how many of them have a parent."""
    references = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("_key")).agg(F.count("*").alias("_rows"))
    )
    known = parent.select(F.col(parent_key).alias("_known")).distinct().withColumn("_found", F.lit(True))
    found = references.join(known, F.col("_key") == F.col("_known"), "left")
    return found.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum(F.when(F.col("_found"), F.col("_rows"))), F.lit(0)).alias("known_count"),
    )
