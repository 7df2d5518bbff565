"""Substring dedup by sentence runs.

Runs of consecutive sentences are hashed: from each sentence on and up to each sentence the fewest
with ``min_words`` words and ``min_sentences`` sentences, or a single sentence of ``2 * min_words``.
Together they cover the whole of every longer run that repeats: its beginning and end by the run from
its first and up to its last sentence, and what lies between by the runs up to each sentence there.
Runs meet in buckets by hash; of each repeated run the first occurrence by (doc_id, place) stays,
and the sentences that any other occurrence covers are removed.

A sentence ends at a word that ends in a full stop, exclamation or question mark, at a newline and
at the end of the text. Sentences of more than 64 words are cut after words chosen by their hash,
so that the cuts move with the words. Case of A-Z and amounts of white space don't matter.

Occurrences of one run within a batch meet before the shuffle: only the first one goes on, so that
a run in a third of all rows sends an entry for each batch, not for each row. Runs are equal where two
hashes are, over 100 bits together whatever the number of buckets, so that no run that differs is taken
for a repeat. Null, empty and short texts have no runs, and rows without a doc_id take no part. Rows of equal doc_id count as one document. Spans are code points of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import LOWER, SPACE, U64, bucket_blobs, free_name, mix, read_blobs, ship, shuffle_parts, span_hashes, spans, text_chunks

LONG = 64


#: What an entry of a bucket has beside the low bytes of its hash.
ENTRY = np.dtype([("check", "<u8"), ("doc", "<i8"), ("place", "<i8"), ("size", "<u4")])


def runs_of(data: np.ndarray, offsets: np.ndarray, min_words: int, min_sentences: int):
    """Row, two hashes, first and end code point of every run."""
    low = LOWER[data]
    start, end, row = spans(~SPACE[low], offsets)
    n = len(start)
    z = np.zeros(0, np.int64)
    if not n:
        return z, z.view(U64), z.view(U64), z, z
    h = span_hashes(low, start, end)
    last = low[end - 1]
    stops = (last == 46) | (last == 33) | (last == 63)
    wide = np.flatnonzero((end - start >= 3) & ((last == 0x82) | (last == 0x81) | (last == 0x9F)))
    for k in range(len(wide)):  # the full-width marks
        stops[wide[k]] |= data[end[wide[k]] - 3 : end[wide[k]]].tobytes() in (b"\xe3\x80\x82", b"\xef\xbc\x81", b"\xef\xbc\x9f")
    newline = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=newline[1:])
    follow = np.r_[start[1:], len(data)]
    stops |= (newline[follow] > newline[end]) | np.r_[row[1:] != row[:-1], True]
    lengths = np.diff(np.r_[0, np.flatnonzero(stops) + 1])
    stops |= np.repeat(lengths > LONG, lengths) & (h & U64(15) == 0)

    close = np.flatnonzero(stops)  # last word of each sentence
    open_ = np.r_[0, close[:-1] + 1]
    srow = row[open_]
    after = np.searchsorted(srow, srow, "right")  # first sentence of the next row
    count = close - open_ + 1
    total = np.r_[0, np.cumsum(count)]
    me = np.arange(len(open_))
    stop = np.searchsorted(total, total[:-1] + min_words, "left")  # total[stop] - total[me] >= min_words
    stop = np.where(count >= 2 * min_words, me + 1, np.maximum(stop, me + min_sentences))
    good = stop <= after
    # runs up to each sentence, without those that also are the run from their first sentence
    back = np.searchsorted(total, total[1:] - min_words, "right") - 1  # total[me + 1] - total[back] >= min_words
    back = np.where(count >= 2 * min_words, me, np.minimum(back, me + 1 - min_sentences))
    more = back >= np.searchsorted(srow, srow, "left")
    more &= stop[np.maximum(back, 0)] != me + 1
    me, stop = np.r_[me[good], back[more]], np.r_[stop[good], me[more] + 1]
    a, b = open_[me], close[stop - 1] + 1  # words
    common._powers(n + 1)
    runs = []
    for words in (h, mix(h ^ U64(0x5851F42D4C957F2D))):
        sums = np.zeros(n + 1, U64)
        np.cumsum(words * common._POW[:n], out=sums[1:])
        runs.append(mix((sums[b] - sums[a]) * common._INV[a] + (b - a).astype(U64)))
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    base = points[offsets[srow[me]]]
    return srow[me], *runs, points[start[a]] - base, points[end[b - 1]] - base


def _later(keys: np.ndarray, check: np.ndarray, doc: np.ndarray, place: np.ndarray):
    """Order of distinct entries by (run, doc, place), and which of them are not the first of theirs."""
    order = np.lexsort((place, doc, check, keys))
    keys, check, doc, place = keys[order], check[order], doc[order], place[order]
    same_key = np.zeros(len(keys), bool)
    same_key[1:] = (keys[1:] == keys[:-1]) & (check[1:] == check[:-1])
    again = same_key.copy()
    again[1:] &= (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
    return order[~again], same_key[~again]


HITS = "bucket int, keys binary, ids binary, doc_id long, first long, stop long"


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 25, min_sentences: int = 2) -> DataFrame:
    """(doc_id, starts, ends): the merged spans of each document that repeat an earlier passage.

    Documents without such a span have no row.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_parts(spark)
    buckets = 8 * parts
    src = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).where("doc_id is not null")

    def local(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            got = []
            for first, end, data, offsets in text_chunks(b.column("text")):
                row, run, check, start, stop = runs_of(data, offsets, min_words, min_sentences)
                got.append((run, check, ids[first:end][row], start, stop))
            if not got:
                continue
            run, check, doc, start, stop = (np.concatenate(x) for x in zip(*got, strict=True))
            order, later = _later(run, check, doc, start)
            rows = np.zeros(int((~later).sum()), ENTRY)
            for name, x in (("check", check), ("doc", doc), ("place", start), ("size", stop - start)):
                rows[name] = x[order[~later]]
            blobs = bucket_blobs(run[order[~later]], rows, buckets)
            hit, n = order[later], blobs.num_rows
            doc, start, stop = _merge(doc[hit], start[hit], stop[hit])
            m = len(doc)
            nulls = lambda k, t: pa.nulls(k, t)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([blobs.column(0), pa.array((doc % buckets).astype(np.int32))]),
                    pa.concat_arrays([blobs.column(1), nulls(m, pa.binary())]),
                    pa.concat_arrays([blobs.column(2), nulls(m, pa.binary())]),
                    *(pa.concat_arrays([nulls(n, pa.int64()), pa.array(x, pa.int64())]) for x in (doc, start, stop)),
                ],
                names=["bucket", "keys", "ids", "doc_id", "first", "stop"],
            )

    def meet(batches):
        held = []
        for b in batches:
            known = b.filter(b.column("keys").is_null())
            if known.num_rows:
                yield known.select(["doc_id", "first", "stop"])
            held.append(b.filter(b.column("keys").is_valid()).select(["bucket", "keys", "ids"]))
        keys, rows = read_blobs(held, kind=ENTRY)
        check, doc, start = (np.ascontiguousarray(rows[c]) for c in ("check", "doc", "place"))
        stop = start + rows["size"]
        order, later = _later(keys, check, doc, start)
        hit = order[later]
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _merge(doc[hit], start[hit], stop[hit])], names=["doc_id", "first", "stop"])

    hits = src.mapInArrow(local, HITS).repartition(parts, "bucket").mapInArrow(meet, "doc_id long, first long, stop long")
    each = hits.groupBy("doc_id").agg(F.collect_list("first").alias("starts"), F.collect_list("stop").alias("ends"))

    def merged(batches):
        for b in batches:
            starts, ends = [], []
            for s, e in zip(b.column("starts").to_pylist(), b.column("ends").to_pylist(), strict=True):
                _, s, e = _merge(np.zeros(len(s), np.int64), np.array(s, np.int64), np.array(e, np.int64))
                starts.append(s)
                ends.append(e)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], names=["doc_id", "starts", "ends"])

    return each.mapInArrow(merged, "doc_id long, starts array<long>, ends array<long>")


def _merge(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Union of overlapping spans of each document."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # a running maximum that starts again with each document
    rank = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + rank * far) - rank * far
    new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.r_[at[1:], len(doc)] - 1]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without the sentences that repeat; all other columns stay."""
    own, starts, ends = (free_name(docs, c) for c in ("__id", "__starts", "__ends"))
    found = repeated_spans(docs, doc_id, text, **options).withColumnsRenamed({"doc_id": own, "starts": starts, "ends": ends})
    body = F.col(text)
    # what stands between one span's end and the next one's start
    opens = F.concat(F.array(F.lit(0).cast("long")), ends)
    closes = F.concat(starts, F.array(F.length(body).cast("long")))
    parts = F.zip_with(opens, closes, lambda a, b: F.substring(body, (a + 1).cast("int"), (b - a).cast("int")))
    out = docs.join(found, docs[doc_id] == F.col(own), "left")
    return out.withColumn(text, F.when(F.col(own).isNull(), body).otherwise(F.array_join(parts, ""))).drop(own, starts, ends)
