"""Benchmark decontamination by latent semantic retrieval.

1. Documents become word numbers in the vocabulary of the benchmark, other words being 0. That is
   the only pass over texts: words outside an item change neither its cosine's numerator nor its
   longest common subsequence.
2. Passages of ``PASSAGE`` words are the rows of a TF-IDF matrix A, whose document frequencies are
   counted over all passages; words of more than MOST of them have no weight. A randomised SVD, one sketch of A'A and one power step, each summed
   over the cluster, gives an orthonormal basis of the strongest term directions.
3. Windows of every text, of the length that suits each class of items and moved by a quarter of
   it, are projected and compared with the projected items by cosine. Items of which half of the
   words or more lack weight, as one that stands in a large part of the passages, don't rely on
   it: they are candidates wherever ``loose`` of their words stand around a window, in any order.
4. Candidates are verified: the longest common subsequence with the words around the window must
   hold ``strict`` of the item's words, or ``loose`` of them when the item's answer, its last
   ``ANSWER`` words, stands there too, in order and next to each other.

The benchmark is read in blocks of a bounded number of words. Items of fewer than ``SHORT`` words
name nothing that could leak and take no part, and so do null and empty items and texts. Rows of
equal doc_id count as one document. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, ship, shuffle_parts, span_hashes, spans, text_chunks

PASSAGE = 64
RANK = 96
MOST = 0.05  # of passages: more frequent words have no weight in the cosine
PLAIN = 0.5  # of an item's words: with as many that lack weight, its words are counted as they stand
COLUMNS = 1024  # words that a presence matrix of windows holds, beside those of one item
SHORT = 5
ANSWER = 3
STEP = 8
ITEM_WORDS = 400_000  # words of the benchmark that one search holds

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word of lower-cased text."""
    start, end, row = spans(WORD[data], offsets)
    return span_hashes(data, start, end), row


class Items:
    """A block of the benchmark: its vocabulary, and each item as numbers from 1."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw = [t.encode() for t in pc.utf8_lower(pa.array(texts, pa.string())).to_pylist()]
        offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
        h, row = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
        per = np.bincount(row, minlength=len(ids))
        keep = per >= SHORT
        self.vocabulary = np.unique(h[keep[row]])
        self.kind = np.uint16 if len(self.vocabulary) < 65_535 else np.uint32
        words = self.numbers(h).astype(np.int64)
        ends = np.cumsum(per)
        self.ids = [i for i, k in zip(ids, keep, strict=True) if k]
        self.words = [words[e - n : e] for e, n, k in zip(ends.tolist(), per.tolist(), keep, strict=True) if k]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(h), self.kind)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0).astype(self.kind)


PACKED = "ids binary, sizes binary, words binary"


def packed(src: DataFrame, items: Items) -> DataFrame:
    """All documents as word numbers, many documents to a row."""

    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for first, end, data, offsets in text_chunks(pc.utf8_lower(b.column("text")), 1 << 20):
                h, row = word_hashes(data, offsets)
                sizes = np.bincount(row, minlength=end - first)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids[first:end], sizes, items.numbers(h))], names=["ids", "sizes", "words"])

    return cut(src.mapInArrow(run, PACKED))


def _rows(batches, kind):
    for b in batches:
        for ids, sizes, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(words, kind)


def _passages(sizes: np.ndarray, words: np.ndarray):
    """Known words and the passage of each, passages numbered through; the number of passages."""
    count = -(-sizes // PASSAGE)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = (np.arange(len(words)) - start) // PASSAGE + np.repeat(np.cumsum(count) - count, sizes)
    known = np.flatnonzero(words)
    return words[known].astype(np.int64) - 1, passage[known], int(count.sum())


def _sums(table: np.ndarray, at: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the rows ``table[at]`` of each group; ``group`` is sorted.

    The groups are ordered by size, so that their n-th rows are added to one stretch at once.
    """
    out = np.zeros((groups, table.shape[1]), table.dtype)
    if not len(group):
        return out
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, len(group)])
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    total = table[at[first]]
    ends = np.searchsorted(-size, -np.arange(1, size[0]), "left")  # groups of more than n rows
    for n, end in enumerate(ends.tolist(), 1):
        total[:end] += table[at[first[:end] + n]]
    out[group[first]] = total
    return out


def frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray]:
    """Number of passages, and in how many of them each word stands."""
    size = len(items.vocabulary)

    def run(batches):
        total = np.zeros(size + 1, np.int64)
        for _, sizes, words in _rows(batches, items.kind):
            w, p, n = _passages(sizes, words)
            pairs = np.unique(p * size + w)
            total[:size] += np.bincount(pairs % size, minlength=size)
            total[size] += n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1), pa.int32()), pa.array(total)], names=["k", "n"])

    out = np.zeros(size + 1, np.int64)
    for r in docs.mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return int(out[size]), out[:size]


def gram_product(docs: DataFrame, items: Items, idf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A'(A m) for the TF-IDF matrix A of all passages: partial products add up over the cluster."""
    size, rank = m.shape
    scaled = (m * idf[:, None]).astype(np.float32)
    held = docs.sparkSession.sparkContext.broadcast(scaled)  # vocabulary of one block by rank

    def run(batches):
        weight, total = held.value, np.zeros((size, rank))
        live = weight.any(1)
        for _, sizes, words in _rows(batches, items.kind):
            w, p, n = _passages(sizes, words)
            w, p = w[live[w]], p[live[w]]
            y = _sums(weight, w, p, n)
            order = np.argsort(w, kind="stable")
            total += _sums(y, p[order], w[order], size)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([r.tobytes() for r in total[some].astype(np.float32)], pa.binary())], names=["k", "v"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v = np.frombuffer(v, np.float32).astype(np.float64)
                total[k] = total[k] + v if k in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["k", "v"])

    out = np.zeros((size, rank))
    parts = docs.mapInArrow(run, "k int, v binary").repartition(shuffle_parts(docs.sparkSession), "k").mapInArrow(add, "k int, v binary")
    for r in parts.collect():
        out[r["k"]] = np.frombuffer(bytes(r["v"]), np.float64)
    return out * idf[:, None]


def basis(docs: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Columns that span the strongest directions of the terms, each divided by its singular value,
    so that topics which most passages share don't make all passages alike."""
    size = len(idf)
    sketch = np.random.default_rng(9).standard_normal((size, min(size, rank + 8)))
    q, _ = np.linalg.qr(gram_product(docs, items, idf, sketch))
    b = gram_product(docs, items, idf, q)
    values, vectors = np.linalg.eigh((q.T @ b + b.T @ q) / 2)
    top = np.argsort(-values)[: min(rank, size)]
    return q @ vectors[:, top] / np.sqrt(np.maximum(values[top], values[top[0]] * 1e-12 + 1e-300))


def common_subsequence(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit for each word of the item."""
    where: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    v = full
    for w in words[words > 0].tolist():
        if m := where.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def has_answer(item: np.ndarray, words: np.ndarray) -> bool:
    answer = item[-ANSWER:]
    n = len(answer)
    hit = np.ones(max(0, len(words) - n + 1), bool)
    for k in range(n):
        hit &= words[k : len(words) - n + 1 + k] == answer[k]
    return bool(hit.any())


def _holding(words: np.ndarray, begin: np.ndarray, end: np.ndarray, span: int, pairs: list, items: list[np.ndarray], loose: float, known: int):
    """Those pairs of a window and an item where the words from ``begin`` to ``end`` hold ``loose`` of
    the item's words, in any order: fewer can't be a subsequence."""
    if not pairs:
        return
    window, item = (np.concatenate(x).astype(np.int64) for x in zip(*pairs, strict=True))
    order = np.lexsort((window, item))
    window, item = window[order], item[order]
    edges = np.flatnonzero(np.r_[True, item[1:] != item[:-1], True][: len(item) + 1]) if len(item) else [0]
    column, reach = np.full(known + 1, -1, np.int64), np.arange(span)
    for a, z in zip(edges[:-1], [*edges[1:]], strict=True):
        i = int(item[a])
        own, times = np.unique(items[i], return_counts=True)
        column[own] = np.arange(len(own))
        for s in range(a, z, 4096):
            w = window[s : min(z, s + 4096)]
            at = begin[w][:, None] + reach
            inside = at < end[w][:, None]
            here = column[words[np.where(inside, at, begin[w][:, None])]]
            here[~inside] = -1
            row, place = np.nonzero(here >= 0)
            there = np.zeros((len(w), len(own)), np.int64)
            there[row, here[row, place]] = 1
            for k in w[there @ times >= loose * len(items[i])].tolist():
                yield k, i
        column[own] = -1


def presence(words: np.ndarray, block: np.ndarray, inside: np.ndarray, count: np.ndarray, items: list[np.ndarray], loose: float):
    """Windows and items, by number, of all pairs where the blocks from 2 before the window's to 5
    after it hold ``loose`` of the item's words."""
    own = np.repeat(count, count)
    group, held = [], np.zeros(0, np.int64)
    for k, item in enumerate([*items, None]):
        both = held if item is None else np.union1d(held, item)
        if group and (item is None or len(both) > COLUMNS):
            column = np.zeros(int(words.max(initial=0)) + 1, np.int64)
            known = held[held < len(column)]
            column[known] = np.arange(1, len(known) + 1)
            at = np.flatnonzero(column[words])
            col, blk = column[words[at]] - 1, block[at]
            share = np.zeros((len(held), len(group)), np.float32)
            for j, g in enumerate(group):
                np.add.at(share[:, j], np.searchsorted(held, items[g]), 1)
            need = np.array([loose * len(items[g]) for g in group]) - 1e-6
            for s in range(0, len(own), 8192):
                e = min(len(own), s + 8192)
                lo, hi = np.searchsorted(blk, [s - 2, e + 5])
                there = np.zeros((e - s, len(held)), np.float32)
                for shift in range(-5, 3):  # the windows that see a block
                    to, place = blk[lo:hi] + shift, inside[blk[lo:hi]] + shift
                    ok = (to >= s) & (to < e) & (place >= 0) & (place < own[blk[lo:hi]])
                    there[to[ok] - s, col[lo:hi][ok]] = 1
                w, j = np.nonzero(there @ share >= need)
                yield w + s, np.array(group)[j]
            group, both = [], item
        if item is not None:
            group.append(k)
            held = np.unique(both)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", cosine: float = 0.5, strict: float = 0.75, loose: float = 0.6) -> DataFrame:
    """(doc_id, item_id, lcs, item_words, score): every document that holds an item, score being the
    share of the item's words in the longest common subsequence."""
    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, lcs long, item_words long, score double"
    src = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).where("doc_id is not null")
    asked = benchmark.select(benchmark[item_id].cast("long").alias("item_id"), benchmark[item_text].cast("string").alias("text")).where("item_id is not null and length(text) > 0").distinct()
    words = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-words // (5 * ITEM_WORDS)))
    out = None
    for k in range(blocks):
        rows = sorted(tuple(r) for r in asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect())
        items = Items([r[0] for r in rows], [r[1] for r in rows])
        if items.ids:
            part = _search(packed(src, items), items, cosine, strict, loose, schema)
            out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.max(F.struct("lcs", "item_words", "score")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.lcs", "m.item_words", "m.score")


def _search(docs: DataFrame, items: Items, cosine: float, strict: float, loose: float, schema: str) -> DataFrame:
    n, df = frequencies(docs, items)
    idf = np.where(df <= max(1, MOST * n), np.log((n + 1) / (df + 0.5)).clip(0.01), 0.0)
    project = basis(docs, items, idf) * (idf**1.5)[:, None]
    unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-12)
    asked = unit(np.stack([project[w - 1].sum(0) for w in items.words])).astype(np.float32)
    lengths = np.array([len(w) for w in items.words])
    plain = np.array([(idf[w - 1] == 0).mean() for w in items.words]) >= PLAIN
    # windows of 4 blocks of STEP * 2 ** c words suit items of up to about as many words
    level = np.ceil(np.log2(np.maximum(1, lengths / (4 * STEP)))).astype(int)
    held = docs.sparkSession.sparkContext.broadcast((np.clip(project, -1e30, 1e30).astype(np.float32), asked, items))

    def run(batches):
        weight, queries, own = held.value
        live = np.r_[False, weight.any(1)]
        for ids, sizes, words in _rows(batches, own.kind):
            found: dict[tuple[int, int], tuple[int, int]] = {}
            count = -(-sizes // STEP)
            start = np.repeat(np.cumsum(sizes) - sizes, sizes)
            block = (np.arange(len(words)) - start) // STEP + np.repeat(np.cumsum(count) - count, sizes)
            known = np.flatnonzero(live[words])
            sums = _sums(weight, words[known].astype(np.int64) - 1, block[known], int(count.sum()))
            first = np.cumsum(sizes) - sizes
            for c in range(level.max() + 1):
                if c:  # blocks of twice the length, within documents
                    owner = np.repeat(np.arange(len(sizes)), count)
                    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                    count = -(-count // 2)
                    sums = _sums(sums, np.arange(len(sums)), inside // 2 + (np.cumsum(count) - count)[owner], int(count.sum()))
                mine = np.flatnonzero(level == c)
                if not len(mine) or not len(sums):
                    continue
                pairs = []
                # three empty blocks after each document keep its windows to itself
                owner = np.repeat(np.arange(len(sizes)), count)
                blocks = np.zeros((len(sums) + 3 * len(sizes) + 3, sums.shape[1]), sums.dtype)
                at = np.arange(len(sums)) + 3 * owner
                blocks[at] = sums
                window = (blocks[:-3] + blocks[1:-2] + blocks[2:-1] + blocks[3:])[at]
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                ask = queries[mine].T
                for s in range(0, len(window), 8192):
                    part = window[s : s + 8192]
                    least = cosine * np.maximum(np.sqrt(np.einsum("ij,ij->i", part, part)), 1e-12)
                    w, i = np.nonzero(part @ ask >= least[:, None])
                    pairs.append((w + s, mine[i]))
                if len(common := mine[plain[mine]]):
                    of = (np.arange(len(words)) - start) // (STEP << c) + np.repeat(np.cumsum(count) - count, sizes)
                    pairs += [(w, common[i]) for w, i in presence(words, of, inside, count, [own.words[i] for i in common], loose)]
                size = STEP << c
                begin = first[owner] + np.maximum(0, inside - 2) * size
                end = first[owner] + np.minimum(sizes[owner], (inside + 6) * size)
                for w, i in _holding(words, begin, end, 8 * size, pairs, own.words, loose, len(own.vocabulary)):
                    d = int(owner[w])
                    item = own.words[i]
                    old = found.get((d, i), (0, 0))
                    if old[0] >= len(item):
                        continue
                    part = words[begin[w] : end[w]]
                    lcs = common_subsequence(item, part)
                    if lcs > old[0] and (lcs >= strict * len(item) or lcs >= loose * len(item) and has_answer(item, part)):
                        found[d, i] = (lcs, len(item))
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(ids[d]) for d, _ in keys], pa.int64()),
                    pa.array([own.ids[i] for _, i in keys], pa.int64()),
                    pa.array([found[k][0] for k in keys], pa.int64()),
                    pa.array([found[k][1] for k in keys], pa.int64()),
                    pa.array([found[k][0] / found[k][1] for k in keys], pa.float64()),
                ],
                names=["doc_id", "item_id", "lcs", "item_words", "score"],
            )

    return docs.mapInArrow(run, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no item of the benchmark; documents without an id stay."""
    own = free_name(docs, "__id")
    found = leaks(docs, benchmark, doc_id, **options).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(found, docs[doc_id] == F.col(own), "left_anti")
