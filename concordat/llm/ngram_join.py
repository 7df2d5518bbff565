"""Exact n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

1. Every text becomes its set of distinct word n-grams (64-bit hashes). Equal sets are one node, by a
   hash of 58 bits; where a second one of 64 bits shows that unequal sets share it, they get another.
2. A link needs num / den of either set, so that of each set's n-grams, in any one order, the first
   n - ceil(n * num / den) + 1 must share one. These are the keys. The order puts n-grams first that
   few documents hold, by counts in a table of fixed size, so that passages which many texts share
   are keys only of texts that hold little else. Collisions in the table change the order and so the
   work, never the result. Keys meet in buckets, where each yields star edges only, by pairs of
   neighbouring size classes; from these the row groups of the product are made.
3. Each row group is multiplied, X times X transposed, in tiles of row blocks and over blocks of
   columns. Overlap counts accumulate; a pair is discarded as soon as its count and what is left
   of the columns can't reach the bound that its sizes give. A tile returns a spanning forest of
   its links, never all pairs.
4. Components of the links give every document the smallest doc_id that it reaches.

Null, empty and blank texts have an empty set and link with nothing; they are their own component.
Rows with equal ids would be one document; columns other than id and text are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BUCKETS_SCHEMA, U64, bucket_blobs, bucket_edges, components, cut, distinct_pairs, drop_cut, in_filter, key_filter, mix, release, ship, shuffle_parts, shuffles_freed, text_chunks, words
from .tiles import each_tile, tile_rows

SLOTS = 1 << 24  # counters of the order: 16 MB on the driver and in each worker, whatever the data
SLOT_BLOCK = 1 << 16
LEVELS = 16  # of each doubling of a counter: the order takes a byte of each
TILE_ROWS = 2048
COLUMN_BLOCK = 4096
GRAM_BYTES = 6  # of each hash that a tile reads: unequal n-grams of two sets agree about once in 10^14 pairs


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each row, end to end, and the number of each row."""
    rows = len(offsets) - 1
    h, row = words(data, offsets)
    per = np.bincount(row, minlength=rows)
    first = np.cumsum(per) - per
    grams = np.maximum(per - n + 1, (per > 0).astype(np.int64))
    total = int(grams.sum())
    owner = np.repeat(np.arange(rows), grams)
    at = np.arange(total) - np.repeat(np.cumsum(grams) - grams, grams) + first[owner]
    length = np.minimum(per, n)[owner]
    out = length.astype(U64) * U64(0xA24BAED4963EE407)
    for k in range(n):
        have = length > k
        weight = U64((0x9FB21C651E98DF25 * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF)
        out[have] += mix(h[at[have] + k] ^ U64(k)) * weight
    out = mix(out)
    ends = np.cumsum(grams)
    for a, b in zip((ends - grams).tolist(), ends.tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(total, bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.bincount(owner[new], minlength=rows)


def size_classes(num: int, den: int) -> np.ndarray:
    """The least size of each class: sizes two classes apart can't link. The last one has no end."""
    low = [1]
    while len(low) < 64:
        low.append(low[-1] * den // num + 1)
    return np.array([x for x in low if x < 1 << 62], np.int64)


def set_sums(grams: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each whole set."""
    out = np.zeros(len(sizes), U64)
    if len(grams):
        some = sizes > 0
        out[some] = np.add.reduceat(mix(grams ^ U64(salt)), (np.cumsum(sizes) - sizes)[some])
    return mix(out + sizes.astype(U64))


CHECK = 0x6A09E667F3BCC909


def set_keys(grams: np.ndarray, sizes: np.ndarray, low: np.ndarray, clashes: np.ndarray) -> np.ndarray:
    """The node of each set, as a signed long: 6 bits of size class, 58 of a hash. Sets whose nodes are
    among the ``clashes``, which unequal sets share, take a second hash."""
    level = np.maximum(np.searchsorted(low, sizes, "right") - 1, 0).astype(U64) << U64(58)
    out = (level | set_sums(grams, sizes, 0) >> U64(6)).view(np.int64)
    if len(clashes) and (again := np.isin(out, clashes)).any():
        out[again] = (level | set_sums(grams, sizes, CHECK) >> U64(6)).view(np.int64)[again]
    return out


def class_edges(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key and pair of neighbouring size classes, an edge from each node to the smallest."""
    level = (nodes.view(U64) >> U64(58)).astype(np.int64)
    keys, upper, nodes = np.r_[keys, keys], np.r_[level, level + 1], np.r_[nodes, nodes]
    order = np.lexsort((nodes, upper, keys))
    keys, upper, nodes = keys[order], upper[order], nodes[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (upper[1:] != upper[:-1])][: len(keys)])
    least = np.repeat(nodes[first], np.diff(np.r_[first, len(keys)]))
    keep = nodes != least
    return distinct_pairs(nodes[keep], least[keep])


def slots(grams: np.ndarray) -> np.ndarray:
    return (grams & U64(SLOTS - 1)).astype(np.int64)


def prefix_keys(grams: np.ndarray, sizes: np.ndarray, held: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n-grams of each row in the order of (counter, hash), as many as a link may miss and
    one more, and the row of each. Rows that link share one at least."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((held[slots(grams)], owner))  # stable, and hashes ascend within a row
    rank = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = rank < (sizes - -(-sizes * num // den) + 1)[owner]
    return grams[order[first]], owner[first]


def counted(table: DataFrame) -> np.ndarray:
    """How many documents hold the n-grams of each slot, as logarithms: the sum of the tasks' counters."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for n, x in zip(b.column("slot_block").to_pylist(), b.column("held").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(x), np.uint16)
                total[n] = total[n] + x if n in total else x.astype(np.uint64)
        levels = [np.minimum(np.rint(LEVELS * np.log2(x + 1.0)), 255).astype(np.uint8) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in levels], pa.binary())], names=["slot_block", "held"])

    parts = table.where("held IS NOT NULL").select("slot_block", "held").repartition(shuffle_parts(table.sparkSession), "slot_block")
    out = np.zeros(SLOTS, np.uint8)
    for n, x in parts.mapInArrow(add, "slot_block int, held binary").collect():  # SLOTS bytes at most
        out[n * SLOT_BLOCK : (n + 1) * SLOT_BLOCK] = np.frombuffer(zlib.decompress(bytes(x)), np.uint8)
    return out


def product_links(ga: np.ndarray, sa: np.ndarray, gb: np.ndarray, sb: np.ndarray, num: int, den: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) with den * overlap >= num * union, by an incidence product."""
    columns, at = np.unique(np.concatenate([ga, gb]), return_inverse=True)
    col_a, col_b = at[: len(ga)], at[len(ga) :]
    row_a, row_b = np.repeat(np.arange(len(sa)), sa), np.repeat(np.arange(len(sb)), sb)
    in_a, in_b = np.bincount(col_a, minlength=len(columns)), np.bincount(col_b, minlength=len(columns))
    useful = (in_a > 1) if same else (in_a > 0) & (in_b > 0)
    place = np.cumsum(useful) - 1
    ka, kb = useful[col_a], useful[col_b]
    row_a, col_a, row_b, col_b = row_a[ka], place[col_a[ka]], row_b[kb], place[col_b[kb]]
    left_a, left_b = np.bincount(row_a, minlength=len(sa)), np.bincount(row_b, minlength=len(sb))
    # den * o >= num * (x + y - o)  is  o >= num * (x + y) / (den + num), rounded up
    need = (-((-num * (sa[:, None] + sb[None, :])) // (den + num))).astype(np.int32)
    overlap = np.zeros((len(sa), len(sb)), np.float32)
    alive = np.minimum(left_a[:, None], left_b[None, :]) >= need
    if same:
        alive &= np.arange(len(sa))[:, None] < np.arange(len(sb))[None, :]
    for c in range(0, int(useful.sum()), COLUMN_BLOCK):
        live_a, live_b = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(live_a):
            break
        blocks = []
        for row, col, live, left in ((row_a, col_a, live_a, left_a), (row_b, col_b, live_b, left_b)):
            here = (col >= c) & (col < c + COLUMN_BLOCK)
            left -= np.bincount(row[here], minlength=len(left))
            slot = np.full(len(left), -1)
            slot[live] = np.arange(len(live))
            x = np.zeros((len(live), COLUMN_BLOCK), np.float32)
            r = slot[row[here]]
            x[r[r >= 0], col[here][r >= 0] - c] = 1
            blocks.append(x)
        overlap[np.ix_(live_a, live_b)] += blocks[0] @ blocks[1].T
        alive &= overlap + np.minimum(left_a[:, None], left_b[None, :]) >= need
    i, j = np.nonzero(alive & (overlap >= need))
    return i, j


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of edges that span the components of the graph."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    keep = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            keep.append(k)
    return np.array(keep, np.int64)


def wide(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // GRAM_BYTES, 8), np.uint8)
    out[:, :GRAM_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, GRAM_BYTES)
    return out.view(U64)[:, 0]


def tile_links(left: list, right: list, same: bool, num: int, den: int) -> tuple[list[int], list[int]]:
    """Spanning links of one tile of rows (node, n-gram hashes)."""
    part = []
    for rows in (left, right):
        sets = [wide(r[1]) for r in rows]
        part.append((np.array([r[0] for r in rows], np.int64), np.concatenate(sets), np.array([len(x) for x in sets], np.int64)))
    (na, ga, sa), (nb, gb, sb) = part
    x, y = product_links(ga, sa, gb, sb, num, den, same)
    x, y = na[x], nb[y]
    k = forest(x, y)
    return x[k].tolist(), y[k].tolist()


def ngram_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 4, num: int = 85, den: int = 100, block_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, for links of Jaccard num / den or more."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    with shuffles_freed(spark):
        table, owner = _owners(spark, src, n, num, den, block_rows)
    some, empty = table.where("n_shingles > 0"), table.where("n_shingles = 0")
    out = some.select("doc_id", "n_shingles", "node").join(owner, "node").select("doc_id", "n_shingles", "component_id")
    return out.unionAll(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _owners(spark, src: DataFrame, n: int, num: int, den: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node, checked) of every document, and (node, component_id) of every set."""
    buckets, low = 8 * shuffle_parts(spark), size_classes(num, den)

    def nodes_of(batches):
        held = np.zeros(SLOTS, np.uint16)
        for b in batches:
            ids = b.column("doc_id")
            for first, end, data, offsets in text_chunks(b.column("text")):
                grams, sizes = ngram_sets(data, offsets, n)
                at, times = np.unique(slots(grams), return_counts=True)
                held[at] = np.minimum(held[at] + times, 65535)
                columns = [ids.slice(first, end - first), pa.array(sizes, pa.int64()), pa.array(set_keys(grams, sizes, low, none)), pa.array(set_sums(grams, sizes, CHECK).view(np.int64))]
                nothing = [pa.nulls(end - first, pa.int32()), pa.nulls(end - first, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *nothing], names=names)
        blocks = held.reshape(-1, SLOT_BLOCK)
        some = np.flatnonzero(blocks.any(1))
        nothing = [pa.nulls(len(some), pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*nothing, pa.array(some, pa.int32()), pa.array([zlib.compress(blocks[k].tobytes(), 1) for k in some], pa.binary())], names=names)

    names, none = ["doc_id", "n_shingles", "node", "checked", "slot_block", "held"], np.zeros(0, np.int64)
    counts = cut(src.mapInArrow(nodes_of, "doc_id long, n_shingles long, node long, checked long, slot_block int, held binary"))
    order = spark.sparkContext.broadcast(counted(counts))
    table = cut(counts.where("held IS NULL").select("doc_id", "n_shingles", "node", "checked"))
    drop_cut(counts)  # some MB of counters from each task
    # unequal sets of one hash: none below 10^8 documents, some hundreds at 10^10
    clash = table.where("n_shingles > 0").groupBy("node").agg(F.min("checked").alias("a"), F.max("checked").alias("b")).where("a <> b").select("node")
    clashes = np.array(sorted(r["node"] for r in clash.collect()), np.int64)
    if len(clashes):
        level = F.shiftleft(F.shiftrightunsigned("node", 58), 58)
        table = table.join(clash.withColumn("clashes", F.lit(True)), "node", "left").withColumn("node", F.when(F.col("clashes"), level.bitwiseOR(F.shiftrightunsigned("checked", 6))).otherwise(F.col("node")))

    def keys_of(batches):
        for b in batches:
            keys, nodes, known = [], [], set()
            for _, _, data, offsets in text_chunks(b.column("text")):
                grams, sizes = ngram_sets(data, offsets, n)
                node = set_keys(grams, sizes, low, clashes)
                fresh = np.zeros(len(node), bool)  # copies within a batch send their keys once
                for k, x in enumerate(node.tolist()):
                    if sizes[k] and x not in known:
                        known.add(x)
                        fresh[k] = True
                grams, node, sizes = grams[np.repeat(fresh, sizes)], node[fresh], sizes[fresh]
                k, r = prefix_keys(grams, sizes, order.value, num, den)
                keys.append(k)
                nodes.append(node[r])
            if keys:
                yield bucket_blobs(np.concatenate(keys), np.concatenate(nodes), buckets)

    edges = bucket_edges(src.mapInArrow(keys_of, BUCKETS_SCHEMA), class_edges)
    edges = cut(edges.distinct())
    release(spark)
    near = _row_groups(edges, 2 * block_rows)
    some = table.where("n_shingles > 0")
    # the smallest id of each set, then of each component, found over sets and not over documents
    least = cut(some.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.coalesce("doc_id", F.lit(0))).alias("speaker")))
    linked = _verified(spark, src, near, _speakers(least, near), n, num, den, block_rows, clashes)
    joined = cut(linked.join(least.select("node", "least"), "node"))
    release(spark)
    roots = cut(joined.groupBy("root").agg(F.min("least").alias("component_id")))
    roots = cut(joined.join(roots, "root").select("node", "component_id"))
    owner = cut(least.join(roots, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id")))
    release(spark)
    return table, owner


def _row_groups(edges: DataFrame, most: int) -> DataFrame:
    """(node, root): groups such that nodes which share a key share a group.

    Components of the star edges, where these hold up to ``most`` nodes. Passages that many texts
    share chain larger ones together; there, each key's leader has a group of the nodes that share
    a key which it leads, so that a node is in as many groups as its keys have leaders.
    """
    near = cut(components(edges))
    size = near.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    whole = near.join(size, "root")
    large = whole.where(F.col("members") > most).select(F.col("node").alias("a"))
    star = edges.join(large, "a").select(F.col("a").alias("node"), F.col("b").alias("root"))
    heads = star.select("root").distinct().select(F.col("root").alias("node"), "root")
    return cut(whole.where(F.col("members") <= most).select("node", "root").unionAll(star).unionAll(heads))


def _speakers(least: DataFrame, near: DataFrame) -> DataFrame:
    """(h): for each node of the row groups, its hash with the smallest id of its copies mixed in."""
    return least.join(near.select("node").distinct(), "node", "left_semi").select(F.col("node").bitwiseXOR(F.col("speaker")).alias("h"))


def _verified(spark, src: DataFrame, near: DataFrame, speakers: DataFrame, n: int, num: int, den: int, block_rows: int, clashes: np.ndarray) -> DataFrame:
    """Components of the true links among the nodes of the row groups. Of equal sets only the
    document of the smallest id sends its n-grams."""
    bits, low = spark.sparkContext.broadcast(key_filter(speakers, "h")), size_classes(num, den)

    def sets_of(batches):
        for b in batches:
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_chunks(b.column("text")):
                grams, sizes = ngram_sets(data, offsets, n)
                node = set_keys(grams, sizes, low, clashes)
                ends, few = np.cumsum(sizes), grams.view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES]
                some = np.flatnonzero(in_filter(bits.value, node ^ ids[first:end]) & (sizes > 0))
                some = some[np.unique(node[some], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array([few[ends[k] - sizes[k] : ends[k]].tobytes() for k in some], pa.binary())], names=["node", "grams"])

    sets = src.mapInArrow(sets_of, "node long, grams binary")
    tiles = tile_rows(near, sets, ["grams"], block_rows)
    solve = lambda left, right, same: tile_links(left, right, same, num, den)
    return components(tiles.mapInArrow(lambda it: each_tile(it, ["grams"], solve), "a long, b long"))
