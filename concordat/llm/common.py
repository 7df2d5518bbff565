"""Shared parts: Arrow text access, 64-bit hashing, checkpoints, bucket exchange and components."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK = 1 << 20
EDGES_PER_TASK = 250_000
EDGES_IN_ONE = 1_000_000  # 16 MB: edges that one task can join


# --- session -------------------------------------------------------------------------------


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_concordat_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    if not root.is_dir():  # this package already came as an archive
        return
    target = os.path.join(tempfile.mkdtemp(prefix="concordat"), "concordat_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "concordat").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(target)
    sc._concordat_shipped = True


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names. A folder of our own stands in on one machine only:
    the executors of a cluster couldn't read it."""
    sc = spark.sparkContext
    folder = sc._jsc.sc().getCheckpointDir()
    if folder.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="concordat-ckpt"))
        folder = sc._jsc.sc().getCheckpointDir()
    return folder.get()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of our own in whatever store it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage and survives lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table of ``cut`` that nothing reads any more."""
    written = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if written.isDefined():
        remove_folder(df.sparkSession, written.get())


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column_types(df: DataFrame, end: int | None = None) -> str:
    """The schema of the first columns, as text."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields[:end])


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps that nothing refers to any more; else
    they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Of tables made in here Spark removes the shuffle files as soon as an action on them ends.

    ``release`` alone can't promise that: a thread of its own tells the JVM what Python has dropped, with
    pauses of a second, so that often the JVM's collection comes first and the files stay. Tables that
    go out of here with shuffles of their own to run should be made after it.
    """
    was = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if was is None else spark.conf.set(SHUFFLES_GO, was)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# --- Arrow text ----------------------------------------------------------------------------


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1] if offs is not None and n else np.zeros(n + 1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def text_chunks(column, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: first row, end row, bytes, offsets from 0."""
    data, offsets = text_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def strings(column) -> list[str]:
    """Python strings of a column; null reads as empty."""
    return [x or "" for x in column.to_pylist()]


# --- hashing -------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, on a copy."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mix(np.arange(256, dtype=U64))
_POW = _INV = np.zeros(0, U64)


def _powers(n: int) -> None:
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, CHUNK + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, base, U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW, _INV = out


class SpanHash:
    """64-bit hashes of byte spans of some data, equal for equal bytes wherever they stand; with ``fold``
    letters A-Z count as a-z."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        _powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, U64)
        each = (_BYTES[LOWER] if fold else _BYTES)[data]
        each *= _POW[: len(data)]
        np.cumsum(each, out=self.total[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * _INV[starts]
        return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHash(data)(starts, ends)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a row: starts, ends, row of each."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    opens = inside[turn]
    start, end = turn[opens], turn[~opens]
    at = offsets[1:-1]
    at = np.unique(at[(at > 0) & (at < n)])
    at = at[inside[at - 1] & inside[at]]  # runs that go on into the next row
    if inside[0]:
        start = np.r_[0, start]
    if inside[-1]:
        end = np.r_[end, n]
    if len(at):
        start, end = (np.sort(np.concatenate([x, at]), kind="stable") for x in (start, end))
    return start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every white-space separated word, A-Z lower-cased."""
    start, end, row = spans(~SPACE[data], offsets)
    return SpanHash(data, fold=True)(start, end), row


# --- bucket exchange -----------------------------------------------------------------------

BUCKETS_SCHEMA = "bucket int, keys binary, ids binary"
KEY_BYTES = 5


def range_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> U64(32)) * U64(buckets) >> U64(32)


def short_keys(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys as they come back from ``bucket_blobs``: the low bytes, and the bucket above them."""
    return (keys & U64((1 << 8 * KEY_BYTES) - 1)) | range_of(keys, buckets) << U64(8 * KEY_BYTES)


def bucket_blobs(keys: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Entries (key, ids) as one binary row a bucket, sorted by key; ids are longs, one or more, or
    rows of some other type of fixed size.

    Buckets are ranges of keys, so that a bucket only sends the 5 low bytes of each key: with some
    million entries a bucket, other keys agree with them about once in a million entries.
    """
    order = np.argsort(keys)
    keys, wide = keys[order], ids[order]
    bucket = range_of(keys, buckets).astype(np.int32)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    ends = np.r_[edges[1:], len(bucket)][: len(edges)]
    low = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[edges]),
            pa.array([low[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
            pa.array([wide[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
        ],
        names=["bucket", "keys", "ids"],
    )


def read_blobs(batches, width: int = 1, kind=None) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a partition of blobs whose key another entry shares, as keys and an id matrix,
    or rows of ``kind``, sorted by key."""
    keys, ids = [], []
    for b in batches:
        for n, x in zip(b.column("bucket").to_pylist(), b.column("keys").to_pylist(), strict=True):
            k = np.zeros((len(x) // KEY_BYTES, 8), np.uint8)
            k[:, :KEY_BYTES] = np.frombuffer(x, np.uint8).reshape(-1, KEY_BYTES)
            keys.append(k.view(U64)[:, 0] | U64(n) << U64(8 * KEY_BYTES))
        ids += [np.frombuffer(x, kind or np.int64) for x in b.column("ids").to_pylist()]
    if not keys:
        return np.zeros(0, U64), np.zeros(0, kind) if kind else np.zeros((0, width), np.int64)
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    shared = np.r_[False, same] | np.r_[same, False]
    ids = np.concatenate(ids)
    return keys[shared], (ids if kind else ids.reshape(-1, width))[order[shared]]


def star_edges(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key with several ids, an edge from each id to the smallest; each edge once."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    if not len(keys):
        return ids, ids
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    least = np.repeat(ids[first], np.diff(np.r_[first, len(keys)]))
    keep = ids != least
    return distinct_pairs(ids[keep], least[keep])


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def edges_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def bucket_edges(blobs: DataFrame, of=star_edges) -> DataFrame:
    """Star edges (a, b) between ids that share a key; every bucket is read by one task."""

    def run(batches):
        keys, ids = read_blobs(batches)
        a, b = of(keys, np.ascontiguousarray(ids[:, 0]))
        yield edges_batch(a, b)

    parts = shuffle_parts(blobs.sparkSession)
    return blobs.repartition(parts, "bucket").mapInArrow(run, "a long, b long")


# --- connected components ------------------------------------------------------------------


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an undirected graph, root being the smallest node it reaches.

    Alternating large-star and small-star steps over DataFrames. Minima are taken by aggregation
    and joined back, so that a node of any degree never has to fit in one task. Up to ``EDGES_IN_ONE``
    edges, as counted, one task joins at once, with the same result.
    """
    parts = shuffle_parts(edges.sparkSession)

    def at_once(batches):
        got = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in batches]
        node, at = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *got]), return_inverse=True)
        u, v = at.reshape(-1, 2).T
        label = np.arange(len(node))
        while len(u):
            low = np.minimum(label[u], label[v])
            np.minimum.at(label, u, low)
            np.minimum.at(label, v, low)
            while ((further := label[label]) != label).any():
                label = further
            apart = label[u] != label[v]
            u, v = label[u[apart]], label[v[apart]]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label])], names=["node", "root"])

    def settled(rows: DataFrame) -> tuple[DataFrame, tuple]:
        """Checkpointed edges in as many partitions as their number calls for, and their digest."""
        rows = cut(rows)
        mark = tuple(rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        return rows.coalesce(min(parts, 1 + mark[0] // EDGES_PER_TASK)), mark

    e, was = settled(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    if was[0] <= EDGES_IN_ONE:
        release(edges.sparkSession)
        return e.coalesce(1).mapInArrow(at_once, "node long, root long")
    while was[0]:
        few = min(parts, 1 + 2 * was[0] // EDGES_PER_TASK)
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(few)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(few)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e, now = settled(small.unionAll(low.select("u", F.col("m").alias("v"))).coalesce(few).distinct())
        if now == was:
            break
        was = now
    release(edges.sparkSession)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


# --- a bounded filter of candidate keys ------------------------------------------------------

FILTER_BITS = 1 << 26  # at most 8 MB on the driver and in each worker, whatever the data


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bit filter of keys that are hashes, as Spark's runtime filters are: a row that it lets
    through may not be a candidate, a row that it stops is none. Its size is fixed, so larger
    inputs only let more rows through to the join that follows.
    """
    at = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    rows = keys.select(at.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:  # buckets count from 1, of 32768 bits each
        out[(r["n"] - 1) * 4096 : r["n"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(np.int64) & (FILTER_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
