"""Row groups cut into tiles: pairs of row blocks that one task solves in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import edges_batch, shuffle_parts


def tile_rows(near: DataFrame, payload: DataFrame, columns: list[str], block_rows: int) -> DataFrame:
    """Rows (grp, i, j, block, node, columns) of all tiles, sorted by tile within partitions.

    ``near`` has (node, root) and any of the columns; ``payload`` has the others, in rows that are equal
    where a node repeats. A group of more than ``block_rows``
    nodes is cut into row blocks and each pair of blocks is a tile.
    """
    many = near.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    own = [c for c in columns if c in near.columns]
    rows = near.join(many, "root").select("node", *own, F.col("root").alias("grp"), F.ceil(F.col("members") / block_rows).cast("int").alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(payload, "node")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", *columns)
    return rows.repartition(shuffle_parts(near.sparkSession), "grp", "i", "j").sortWithinPartitions("grp", "i", "j")


EDGES = 16_384  # of many small tiles that go out together


def each_tile(batches, columns: list[str], solve: Callable) -> Iterator:
    """Calls ``solve(left, right, same)`` for each tile, rows being (node, *columns), each node once; the
    edges (a, b) that it returns go out together with those of other tiles."""
    a: list[int] = []
    b: list[int] = []

    def side(rows, block):
        return list({r[1]: r[1:] for r in rows if r[0] == block}.values())

    def one(key, rows):
        _, i, j = key
        left = side(rows, i)
        right = left if i == j else side(rows, j)
        if left and right:
            x, y = solve(left, right, i == j)
            a.extend(x)
            b.extend(y)

    was, rows = None, []
    for batch in batches:
        for grp, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "i", "j", "block", "node", *columns)), strict=True):
            if was is not None and (grp, i, j) != was:
                one(was, rows)
                rows = []
                if len(a) >= EDGES:
                    yield edges_batch(np.array(a, np.int64), np.array(b, np.int64))
                    a.clear()
                    b.clear()
            was = (grp, i, j)
            rows.append(row)
    if was is not None:
        one(was, rows)
    yield edges_batch(np.array(a, np.int64), np.array(b, np.int64))
