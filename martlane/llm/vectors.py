"""Vectors as numpy blocks: shared by the two vector searches.

Both searches deal the candidates into blocks of at most ``BLOCK`` rows (by
row number, so no key can make a block large), build an index per block in
one task, and pass the queries over each block's index in blocks of their
own.  The first block is searched before the others: its k-th best score is a
floor for every query, below which no candidate of another block can be among
the k best.  Blocks' best hits are merged per query by a window over at most k
rows per query and block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from martlane.llm.common import ship_package, stored

BLOCK = 8192        # candidate rows per index
QUERY_BLOCK = 4096  # query rows that a task holds at a time
NO_FLOOR = -(1 << 62)


def usable(vectors: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """id, v (array<double>) of rows whose vector is present, not empty and
    finite in every component; rows with a null id take no part.  Vectors of
    zeros only with ``zero``."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    return rows if zero else rows.filter(F.exists("v", lambda x: x != 0))


def blocks(rows: DataFrame, n: int, size: int) -> DataFrame:
    """Deal ``rows`` (n of them) into blocks of about ``size``, whatever their keys."""
    count = max(1, -(-n // size))
    return rows.withColumn("block", F.pmod(F.xxhash64("id", "row"), F.lit(count)).cast("int"))


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row", F.monotonically_increasing_id())


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def merge_top(hits: DataFrame, k: int, score: Column) -> DataFrame:
    """query_id, rank, vec_id, score of each query row's k best of all blocks."""
    w = Window.partitionBy("query_row").orderBy(score.desc(), F.col("vec_id"), F.col("vec_row"))
    return (hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def best(query: np.ndarray, member: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best pairs: by score, then smaller id."""
    order = np.lexsort((member, ids[member], -score, query))
    q = query[order]
    first = np.searchsorted(q, q)  # where each query's pairs begin
    return order[np.arange(len(q)) - first < k]


def search(vectors: DataFrame, k: int, is_query: Column, id_col: str, vector_col: str, zero: bool,
           prepare: Column, one_block, score_type: str, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Run ``one_block(queries, query rows, candidates, their ids, their rows, k,
    floors)`` -> (query position, candidate position, score) over every pair of
    a candidate block and a query block of the same number of components.  A
    query's floor is ``NO_FLOOR`` where none is known."""
    ship_package(vectors.sparkSession)
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = stored(numbered(usable(vectors, id_col, vector_col, zero).withColumn("v", prepare)
                           .withColumn("dim", F.size("v"))), "vectors")
    queries = rows.filter(is_query)
    n, m = rows.count(), queries.count()
    n_blocks, n_query = max(1, -(-n // block)), max(1, -(-m // query_block))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = blocks(rows, n, block).withColumn("qblock", each(n_query))
    right = (blocks(queries, m, query_block).withColumnRenamed("block", "qblock")
             .withColumn("block", each(n_blocks)))

    def run(members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "query_row": [], "vec_id": [], "vec_row": [], "score": []}
        if len(members) and len(asked):
            members = members.sort_values("row", ignore_index=True)
            asked = asked.sort_values("row", ignore_index=True)
            q, c, s = one_block(matrix(asked["v"]), asked["row"].to_numpy(), matrix(members["v"]),
                                members["id"].to_numpy(), members["row"].to_numpy(), k, asked["floor"].to_numpy())
            out = {"query_id": asked["id"].to_numpy()[q], "query_row": asked["row"].to_numpy()[q],
                   "vec_id": members["id"].to_numpy()[c], "vec_row": members["row"].to_numpy()[c], "score": s}
        return pd.DataFrame(out)

    keys = ["block", "qblock", "dim"]

    def hits(members: DataFrame, asked: DataFrame) -> DataFrame:
        # columns of their own: both sides come from the same table
        asked = asked.select(*keys, "id", "row", "v", "floor").toDF(*keys, "id", "row", "v", "floor")
        return (members.select(*keys, "id", "row", "v").groupBy(*keys)
                .cogroup(asked.groupBy(*keys))
                .applyInPandas(run, f"query_id {id_type}, query_row long, vec_id {id_type}, vec_row long, "
                                    f"score {score_type}"))

    none = F.lit(NO_FLOOR).cast(score_type)
    first = hits(left.filter("block = 0"), right.filter("block = 0").withColumn("floor", none))
    if n_blocks == 1:
        return merge_top(first, k, F.col("score"))
    first = stored(first, "first-block")
    floors = (first.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
              .filter(F.col("n") == k).select(F.col("query_row").alias("row"), "floor"))
    asked = (right.filter("block > 0").join(floors, "row", "left")
             .withColumn("floor", F.coalesce("floor", none)))
    return merge_top(first.unionByName(hits(left.filter("block > 0"), asked)), k, F.col("score"))
