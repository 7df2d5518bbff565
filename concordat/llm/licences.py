"""Licence scans by a positional index of rare tokens.

The index holds the words of short licence notices with their positions. Its words get their IDF
from the documents themselves, counted over all of them; it is ``LOW`` at least, so that no notice
is too frequent to be found. A notice stands only where one of its mandatory key phrases stands whole.
Around each such place the words of the notice of the highest IDF, ``TOP`` at most, are looked up;
every posting of such a word votes for the place where the notice would begin. Votes that agree to
within ``SHIFT`` words are one alignment; the one with the most IDF that reaches the key phrase is
taken, and needs at least ``LEAST`` different rare words.

Words are runs of digits, ASCII letters (A-Z as a-z) and everything beyond ASCII. Base labels come
from fixed phrases, wherever their words stand consecutively. ``score`` is the largest share of a
verified notice's IDF that its alignment covers, at least 0.5 where there is a base place, else 0.

Null and empty texts have no words, places or labels. Repeated rows give equal results; other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, column_types, ship, span_hashes, spans, text_chunks

TOP = 12
SHIFT = 3
LEAST = 2
LOW = 0.1  # IDF of words that half of the texts hold or more

#: Phrases and labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, mandatory key phrases (one of them is enough), notice.
NOTICES = (
    ("mit", ("permission is hereby granted free of charge", "mit license"), "mit license permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", ("apache license version 2 0",), "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", ("redistribution and use in source and binary forms",), "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice"),
    ("gpl", ("gnu general public license",), "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", ("gnu lesser general public license",), "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2.0", ("mozilla public license",), "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cc-by", ("creative commons attribution",), "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", ("creative commons attribution sharealike",), "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", ("waived all copyright and related", "cc0 1 0 universal"), "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work cc0 1 0 universal public domain dedication"),
    ("isc", ("permission to use copy modify and or distribute this software",), "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("unlicense", ("free and unencumbered software released into the public domain",), "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
)

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]] = True


def _hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


class Index:
    """Postings of the notices' words, and the numbers by which texts know those words."""

    def __init__(self, notices=NOTICES, phrases=PHRASES):
        self.words = sorted({w for _, keys, text in notices for t in (*keys, text) for w in t.split()} | {w for p in phrases for w in p.split()})
        number = {w: i for i, w in enumerate(self.words)}
        hashes = _hash(self.words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.postings: list[dict[int, list[int]]] = []
        self.labels, self.keys, self.texts = [], [], []
        for label, keys, text in notices:
            self.labels.append(label)
            self.keys.append([[number[w] for w in k.split()] for k in keys])
            self.texts.append([number[w] for w in text.split()])
            self.postings.append({})
            for at, w in enumerate(self.texts[-1]):
                self.postings[-1].setdefault(w, []).append(at)
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that are in no notice or phrase."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


def tokens(data: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Number and row of every word."""
    low = LOWER[data]
    start, end, row = spans(WORD[low], offsets)
    return index.numbers(span_hashes(low, start, end)), row


def places(words: np.ndarray, row: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Positions in ``words`` where the phrase stands within a row."""
    n = len(phrase)
    if len(words) < n:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(words[: len(words) - n + 1] == phrase[0])
    for k in range(1, n):
        at = at[words[at + k] == phrase[k]]
    return at[row[at] == row[at + n - 1]]


def notice_share(words: np.ndarray, index: Index, idf: np.ndarray, n: int, key: int, size: int) -> float:
    """Share of the notice's IDF that its best alignment around a key phrase covers, 0 if there is
    none; ``words`` are the numbers of all words of one text, the phrase has ``size`` words from ``key``."""
    text, postings = index.texts[n], index.postings[n]
    # an alignment reaches the phrase if it begins at least, and at most, there
    least, most = key + size - len(text) - SHIFT, key + SHIFT
    start = max(0, least - SHIFT)
    near = words[start : most + SHIFT + len(text)].tolist()
    rare = set(sorted(postings.keys() & set(near), key=lambda w: (-idf[w], w))[:TOP])
    found = sorted((start + p - q, w, q) for p, w in enumerate(near) if w in rare for q in postings[w] if least - SHIFT <= start + p - q <= most + SHIFT)
    top, low, live, weight = (0.0, 0, 0), 0, {}, 0.0
    for high in range(len(found)):  # the window of origins that covers the most IDF
        w, q = found[high][1:]
        live[w, q] = live.get((w, q), 0) + 1
        weight += idf[w] * (live[w, q] == 1)
        while found[high][0] - found[low][0] > SHIFT:
            w, q = found[low][1:]
            live[w, q] -= 1
            weight -= idf[w] * (live[w, q] == 0)
            low += 1
        if weight > top[0] and found[low][0] <= most and found[high][0] >= least and len({x for (x, _), c in live.items() if c}) >= LEAST:
            top = (weight, found[low][0], found[high][0])
    if not top[0]:
        return 0.0
    there = [w for q, w in enumerate(text) if w in words[max(0, top[1] + q) : max(0, top[2] + q + 1)]]
    return min(1.0, sum(idf[w] for w in there) / sum(idf[w] for w in text))


def notice_labels(words: np.ndarray, row: np.ndarray, first: np.ndarray, per: np.ndarray, index: Index, idf: np.ndarray) -> dict[int, tuple[set[str], float]]:
    """Verified labels, and the best share of IDF, of each row that has any."""
    out: dict[int, tuple[set[str], float]] = {}
    for n, keys in enumerate(index.keys):
        best: dict[int, float] = {}
        for phrase in keys:
            for p in places(words, row, phrase).tolist():
                k = int(row[p])
                if best.get(k, 0.0) < 1:
                    best[k] = max(best.get(k, 0.0), notice_share(words[first[k] : first[k] + per[k]], index, idf, n, p - int(first[k]), len(phrase)))
        for k, share in best.items():
            if share:
                labels, most = out.get(k, (set(), 0.0))
                out[k] = (labels | {index.labels[n]}, max(most, share))
    return out


def scan_licences(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Word count, base places and labels of each whole text."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(*keep, docs[text].cast("string").alias("__text"))
    schema = column_types(src, -1)

    def count(batches):
        index = Index()
        size = len(index.words)
        for b in batches:
            total = np.zeros(size, np.int64)
            for _, _, data, offsets in text_chunks(b.column("__text")):
                words, row = tokens(data, offsets, index)
                some = words >= 0
                total += np.bincount(np.unique(row[some] * size + words[some]) % size, minlength=size)
            yield pa.RecordBatch.from_arrays([pa.array([*range(size), -1], pa.int32()), pa.array([*total, b.num_rows], pa.int64())], names=["word", "n"])

    found = {r["word"]: r["n"] for r in src.select("__text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = found.get(-1, 0)
    size = len(Index().words)
    idf = [max(LOW, math.log((rows + 1) / (2 * found.get(w, 0) + 1))) for w in range(size)]

    def run(batches):
        index, weight = Index(), np.array(idf)
        for b in batches:
            cols = [[] for _ in range(7)]
            for _, _, data, offsets in text_chunks(b.column(b.num_columns - 1)):
                words, row = tokens(data, offsets, index)
                n = len(offsets) - 1
                per = np.bincount(row, minlength=n)
                first = np.cumsum(per) - per
                at, label = [], []
                for phrase, name in index.phrases:
                    p = places(words, row, phrase)
                    at.append(p)
                    label += [name] * len(p)
                at = np.concatenate(at)
                order = np.lexsort((at,))
                at, label = at[order], [label[k] for k in order]
                owner = row[at]
                notices = notice_labels(words, row, first, per, index, weight)
                for k in range(n):
                    a, z = np.searchsorted(owner, [k, k + 1])
                    base = set(label[a:z])
                    more, score = notices.get(k, (set(), 0.0))
                    values = (int(per[k]), int(z - a), int(at[a] - first[k]) if z > a else None, int(at[z - 1] - first[k]) if z > a else None, ",".join(sorted(base)), ",".join(sorted(base | more)), max(score, 0.5 if z > a else 0.0))
                    for c, v in zip(cols, values, strict=True):
                        c.append(v)
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64())
            names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*b.schema.names[:-1], *names])

    return src.mapInArrow(run, f"{schema}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
