"""Different vectors of a table, with the ids that stand for each; results spread from vectors to rows.

A vector takes part if it is not null, not empty, and has only finite components. Equal vectors are one point,
called by its smallest id; of its other ids the `many` smallest are kept, which is enough to answer any query
for fewer nearest rows: rows of one vector have one score, and smaller ids win. Rows with a null id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def with_point(rows: DataFrame) -> DataFrame:
    """vec_id, v and `point`, the smallest id with the same v."""
    least = rows.groupBy("v").agg(F.min("vec_id").alias("point"))
    return rows.join(least, "v")


def points(rows: DataFrame, many: int) -> DataFrame:
    """point, v, ids (ascending, the `many` smallest): one row for each different v of (vec_id, v)."""
    ranked = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
    return (ranked.where(F.col("n") <= many).groupBy("v")
            .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
            .select(F.col("ids")[0].alias("point"), "v", "ids"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows of lists as a matrix; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def best(scores: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the `many` highest scores in each row, ties to smaller ids (of the columns)."""
    order = np.argsort(ids, kind="stable")
    scores = scores[:, order]
    if scores.shape[1] > many:
        least = -np.partition(-scores, many - 1, axis=1)[:, many - 1]
        row, column = np.nonzero(scores >= least[:, None])
    else:
        row, column = (x.ravel() for x in np.indices(scores.shape))
    by_score = np.lexsort((column, -scores[row, column], row))
    row, column = row[by_score], column[by_score]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < many], order[column[nth < many]]


def spread(found: DataFrame, queries: DataFrame, sources: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of every query row. found: (query, point, score) with the k + 1 best
    points of each query point; queries: (vec_id, point); sources: (point, ids)."""
    rows = (found.join(sources.select("point", "ids"), "point")
            .select("query", "score", F.explode("ids").alias("vec_id")))
    own = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = rows.withColumn("n", F.row_number().over(own)).where(F.col("n") <= k + 1).drop("n")
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(short, "query").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
