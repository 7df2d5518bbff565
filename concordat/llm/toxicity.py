"""Toxicity by noisy-channel deobfuscation and a scorer of the restored text.

1. A character trigram model is counted over all documents.
2. Stretches that may be disguised - letters before or after leetspeak signs, letters repeated three
   times or more, single letters or signs set apart - become lattices of what each sign may stand for. A Viterbi
   search takes the path that the channel costs and the language model like best; it may be the
   stretch as it stands.
3. Words of the restored text and their beginnings are the features. Weights are smoothed log odds
   from one half of a bounded sample of labelled rows; on the other half a logistic regression
   learns what the weights that a document holds say about its label.

Only the text is an input. Labels are read of rows that ``is_train`` admits, at most ``sample`` of
them, those of the smallest hash of doc_id. Null, empty and blank texts have no feature and get the
score that the regression gives to none. A column of ``keep`` may have any name, but one named
"score" or "doc_id" stands beside those of the result. Without any label, or with one class only, every score is
the share of toxic labels, 0 without labels. Repeated rows give equal results.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, column_types, cut, mix, ship, span_hashes, spans, text_chunks

SAMPLE = 24_000
CLASSES = 28

_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True

#: What a sign may stand for.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SIGN_COST, KEEP_COST, DROP_COST, REPEAT_COST = 1.0, 2.5, 2.0, 0.7

_SIGN = "".join(c if c.isalnum() or c == "€" else "\\" + c for c in SIGNS)
_UNIT, _NEXT, _APART = rf"(?:[^\W\d_]|[{_SIGN}])", r"[ .\-_*]", r"(?![^\W_])"
#: Single letters and signs set apart, three or more, one of them a letter. A run of signs is tried
#: from its first sign only: what follows it decides, so that later signs can't do better.
_SET_APART = (
    rf"[^\W\d_](?:{_NEXT}{_UNIT}{_APART}){{2,}}"
    rf"|[{_SIGN}](?:{_NEXT}[{_SIGN}]{_APART})*{_NEXT}[^\W\d_]{_APART}(?:{_NEXT}{_UNIT}{_APART})+"
    rf"|[{_SIGN}](?:{_NEXT}[{_SIGN}]{_APART})+{_NEXT}[^\W\d_]{_APART}"
)
SET_APART = re.compile(rf"(?<![^\W_])(?!(?<=[{_SIGN}]{_NEXT})(?<!\w[{_SIGN}]{_NEXT})[{_SIGN}])(?:{_SET_APART})")
SET_APART_HERE = re.compile(rf"(?<![^\W_])(?:{_SET_APART})")
#: Where signs stand between, after or before letters, and where a letter stands three times.
SIGNED = re.compile(rf"(?=[^\W\d_][{_SIGN}]{{1,3}}(?:[^\W\d_]|(?!\w))|(?<![^\s])[{_SIGN}][^\W\d_])")
TRIPLE = re.compile(r"(?=([^\W\d_])\1\1)")
BLANK, NO_LETTER = re.compile(r"\s"), re.compile(r"[\W\d_]")
SPACED = re.compile(rf"[^\W\d_](?:{_NEXT}[^\W\d_])+|{_UNIT}(?:{_NEXT}{_UNIT}){{2,}}")
#: What is neither letter, digit nor sign at the edges of a stretch stands for nothing.
INNER = re.compile(rf"[\w{_SIGN}]")


class Runs:
    """The runs of a text between separators that hold a mark: where each ends, and its last mark."""

    def __init__(self, text: str, mark: re.Pattern, separator: re.Pattern):
        self.runs: list[tuple[int, int, int]] = []
        marks = [m.start() for m in mark.finditer(text)]
        cuts = [m.start() for m in separator.finditer(text)] if marks else []
        for at in marks:
            if self.runs and at < self.runs[-1][1]:
                self.runs[-1] = (*self.runs[-1][:2], at)
            else:
                k = bisect.bisect_left(cuts, at)
                self.runs.append((cuts[k - 1] + 1 if k else 0, cuts[k] if k < len(cuts) else len(text), at))
        self.at = 0

    def next(self, pos: int) -> tuple[int, int]:
        """Start and end of the first stretch from ``pos`` on: from there, or the run's start, to its end."""
        while self.at < len(self.runs) and self.runs[self.at][2] < pos:
            self.at += 1
        if self.at == len(self.runs):
            return FAR, FAR
        start, end, _ = self.runs[self.at]
        return max(pos, start), end


FAR = 1 << 62


def disguised(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that may be disguised, leftmost first: letters and signs set apart, then what holds
    signs beside letters, then words with a letter three times. Linear in the text."""
    signed, triple, pos = Runs(text, SIGNED, BLANK), Runs(text, TRIPLE, NO_LETTER), 0
    far = SET_APART.search(text, pos)
    while True:
        if far is not None and far.start() < pos:
            far = SET_APART.search(text, pos)
        apart = next((m for k in (0, 1) if (m := SET_APART_HERE.match(text, pos + k))), far)
        found = [(apart.start(), 0, apart.end())] if apart else []
        for n, runs in ((1, signed), (2, triple)):
            a, b = runs.next(pos)
            found.append((a, n, b))
        start, _, end = min(found)
        if start == FAR:
            return
        yield start, end
        pos = end


class CharModel:
    """Trigram costs over letters, from counts."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(CLASSES * CLASSES, CLASSES) + 0.1
        self.cost = -np.log(c / c.sum(1, keepdims=True))

    def restore(self, text: str) -> str:
        """The best path through the lattice of a stretch."""
        units, at = [], 0
        spaced = SPACED.fullmatch(text) is not None
        while at < len(text):
            c, n = text[at], 1
            if c.isalpha():
                while at + n < len(text) and text[at + n].lower() == c.lower():
                    n += 1
                if n >= 3:
                    units.append([(c, REPEAT_COST), (c * 2, REPEAT_COST), (text[at : at + n], KEEP_COST)])
                else:
                    units += [[(x, 0.0)] for x in text[at : at + n]]
            elif c in SIGNS:
                units.append([(c, KEEP_COST), *((x, SIGN_COST) for x in SIGNS[c])])
            elif spaced:
                units.append([("", DROP_COST), (c, KEEP_COST)])
            else:
                units.append([(c, 0.0)])
            at += n
        # by the classes of the last two characters: cost, and the pieces as a chain
        best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for options in units:
            new: dict[int, tuple[float, tuple | None]] = {}
            for state, (cost, out) in best.items():
                for piece, more in options:
                    s, total = state, cost + more
                    for x in piece:
                        k = ord(x.lower()) - 96 if "a" <= x.lower() <= "z" else 27 if x > "\x7f" else 0
                        total += self.cost[s, k]
                        s = s % CLASSES * CLASSES + k
                    if s not in new or total < new[s][0]:
                        new[s] = (total, (piece, out))
            best = new
        chain, parts = min(((cost + self.cost[s, 0], s, out) for s, (cost, out) in best.items()), key=lambda x: x[:2])[2], []
        while chain is not None:
            parts.append(chain[0])
            chain = chain[1]
        return "".join(reversed(parts))


class Restorer:
    """Restores texts; remembers short stretches that it has seen."""

    def __init__(self, counts: np.ndarray):
        self.model, self.seen = CharModel(counts), {}

    def stretch(self, raw: str) -> str:
        """A stretch without repeated marks at its ends, and with what stands between them restored."""
        if raw in self.seen:
            return self.seen[raw]
        core = raw
        if _mark(core[0]) and core[1:2] == core[0]:
            core = core.lstrip(core[0])
        if core and _mark(core[-1]) and core[-2:-1] == core[-1]:
            core = core.rstrip(core[-1])
        first, last = INNER.search(core), len(core)
        if first is None:
            return core
        while not INNER.match(core, last - 1):
            last -= 1
        out = core[: first.start()] + self.model.restore(core[first.start() : last]) + core[last:]
        if len(raw) <= 64:
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[raw] = out
        return out

    def __call__(self, text: str) -> str:
        out, at = [], 0
        for a, b in disguised(text):
            out += [text[at:a], self.stretch(text[a:b])]
            at = b
        return "".join([*out, text[at:]])


def _mark(c: str) -> bool:
    return not (c.isalnum() or c == "_" or c.isspace())


def features(texts: pa.Array):
    """For runs of rows: first row, end row, row of each word, feature hashes (words by kinds)."""
    for first, end, low, offsets in text_chunks(pc.utf8_lower(texts)):
        start, stop, row = spans(_LETTER[low], offsets)
        kinds = [span_hashes(low, start, stop)]
        for n in (4, 5, 6, 7):
            h = span_hashes(low, start, np.minimum(stop, start + n))
            kinds.append(np.where(stop - start > n, mix(h + U64(n)), U64(0)))
        yield first, end, row, np.stack(kinds, 1)


class Weights:
    """Word weights: the largest of a word's features, 0 where none is known."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order]
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.hashes & U64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and feature number of every known feature."""
        word, kind = np.nonzero(self.table[(h & U64((1 << 20) - 1)).astype(np.int64)])
        if not len(self.hashes):
            return word[:0], word[:0]
        value = h[word, kind]
        at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
        known = self.hashes[at] == value
        return word[known], at[known]

    def document(self, h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Per row: largest and second largest word weight, sums as they are and by length."""
        word, at = self.find(h)
        best = np.zeros(len(h))
        np.maximum.at(best, word, self.weights[at])
        hit = np.flatnonzero(best > 0)
        order = hit[np.lexsort((-best[hit], row[hit]))]
        r = row[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        out = np.zeros((rows, 4))
        for k in (0, 1):
            out[r[place == k], k] = best[order[place == k]]
        total = np.bincount(r, best[order], rows)
        out[:, 2] = np.log1p(total)
        out[:, 3] = total / np.maximum(1, np.bincount(row, minlength=rows))
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def char_counts(texts: DataFrame) -> np.ndarray:
    """Trigram counts of all documents."""

    def run(batches):
        for b in batches:
            total = np.zeros(CLASSES**3, np.int64)
            for _, _, data, offsets in text_chunks(b.column(0)):
                c = _CLASS[LOWER[data]]
                c = np.insert(c, offsets[1:], 0)  # rows end in a boundary
                total += np.bincount(c[:-2] * CLASSES**2 + c[1:-1] * CLASSES + c[2:], minlength=len(total)) if len(c) > 2 else 0
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["code", "n"])

    out = np.zeros(CLASSES**3)
    for r in texts.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out


#: A quick test that stops no text that ``disguised`` would change, but for letters repeated three
#: times. The two engines differ in what they call a letter or a space beyond ASCII, so that here any
#: such character counts as whichever would let the text through.
_ANY, _OPEN, _CLOSE = "[A-Za-z\\x{80}-\\x{10FFFF}]", "(?:^|[^A-Za-z0-9])", "(?:$|[^A-Za-z0-9])"
_ONE = f"[A-Za-z\\x{{80}}-\\x{{10FFFF}}{_SIGN}]"
MAYBE = rf"{_ANY}[{_SIGN}]{{1,3}}(?:{_ANY}|$|[^A-Za-z0-9_])|(?:^|[\x00-\x20\x{{80}}-\x{{10FFFF}}])[{_SIGN}]{_ANY}|{_OPEN}{_ONE}{_NEXT}{_ONE}{_NEXT}{_ONE}{_CLOSE}"


def suspicious(texts: pa.Array) -> np.ndarray:
    """Mask of the rows that may hold a disguised stretch."""
    out = np.array(pc.match_substring_regex(texts, MAYBE))
    for first, _, data, offsets in text_chunks(texts):
        for n in (1, 2, 3, 4):  # bytes of a letter
            if len(data) < 3 * n:
                continue
            same = data[:-n] == data[n:]
            run = same[: len(same) - n] & same[n:]
            for k in range(1, n):
                run[: len(run) - k] &= same[k : len(same) - n][: len(run) - k] & same[k + n :][: len(run) - k]
            lead = data[: len(run)]
            at = np.flatnonzero(run & (_LETTER[LOWER[lead]] if n == 1 else lead >= 0xC0))
            out[first + np.searchsorted(offsets, at, "right") - 1] = True
    return out


def _restored(batch, restorer: Restorer) -> pa.Array:
    texts = batch.column(batch.num_columns - 1).fill_null("")
    mask = suspicious(texts)
    if not mask.any():
        return texts
    new = pa.array([restorer(t) for t in texts.filter(pa.array(mask)).to_pylist()], pa.string())
    return pc.replace_with_mask(texts, pa.array(mask), new)


def fit(texts: DataFrame, labels: DataFrame, is_train: Column, sample: int = SAMPLE) -> dict:
    """The whole model: trigram counts, feature weights and regression."""
    counts = char_counts(texts.select("__text"))
    chosen = labels.where(is_train & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids and labels
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("half")
    rows = cut(rows.select(F.col("toxic").cast("int").alias("toxic"), half, "__text"))  # read three times

    def positive(batches):
        restorer = Restorer(counts)
        for b in batches:
            b = b.filter(pa.array((b.column("toxic").to_numpy() == 1) & (b.column("half").to_numpy() == 0)))
            got = [np.unique(np.stack([np.repeat(row, 5).astype(U64), h.ravel()], 1), axis=0)[:, 1] for _, _, row, h in features(_restored(b, restorer))]
            h, n = np.unique(np.concatenate([np.zeros(0, U64), *got]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    found = rows.mapInArrow(positive, "h long, n long").where("h <> 0").groupBy("h").agg(F.sum("n").alias("n")).where("n >= 3").collect()  # bounded as the sample is
    hashes, pos = np.array([r["h"] for r in found], np.int64).view(U64), np.array([r["n"] for r in found], float)

    def others(batches):
        known, restorer = Weights(hashes, np.arange(len(hashes), dtype=float)), Restorer(counts)
        for b in batches:
            b = b.filter(pa.array(b.column("half").to_numpy() == 0))
            toxic = b.column("toxic").to_numpy() == 1
            b, n = b.filter(pa.array(~toxic)), np.zeros(len(hashes) + 2, np.int64)
            n[-2:] = toxic.sum(), (~toxic).sum()
            for _, _, row, h in features(_restored(b, restorer)):
                word, at = known.find(h)
                pairs = np.unique(row[word] * len(hashes) + known.weights[at].astype(np.int64)) if len(word) else np.zeros(0, np.int64)
                n[:-2] += np.bincount(pairs % max(1, len(hashes)), minlength=len(hashes))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some])], names=["k", "n"])

    neg = np.zeros(len(hashes) + 2)
    for r in rows.mapInArrow(others, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        neg[r["k"]] = r["n"]
    neg, (p, n) = neg[:-2], neg[-2:]
    weight = np.log((pos + 0.5) / (p + 1)) - np.log((neg + 0.5) / (n + 1))
    error = np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    strong = np.flatnonzero((weight > 1) & (weight > 2.5 * error))
    hashes, weight = hashes[strong], weight[strong] - error[strong]

    def measure(batches):
        known, restorer = Weights(hashes, weight), Restorer(counts)
        for b in batches:
            b = b.filter(pa.array(b.column("half").to_numpy() == 1))
            out = [known.document(h, row, end - first) for first, end, row, h in features(_restored(b, restorer))]
            x = np.concatenate([np.zeros((0, 4)), *out])
            yield pa.RecordBatch.from_arrays([b.column("toxic").cast(pa.int32()), *(pa.array(x[:, k]) for k in range(4))], names=["y", "a", "b", "c", "d"])

    data = np.array([tuple(r) for r in rows.mapInArrow(measure, "y int, a double, b double, c double, d double").collect()], float).reshape(-1, 5)
    data = data[np.lexsort(data.T)]
    y = data[:, 0]
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        beta = np.array([0, 0, 0, 0, -30.0 if share == 0 else 30.0])
    else:
        beta = logistic(data[:, 1:], y)
    return {"counts": counts, "hashes": hashes, "weights": weight, "beta": beta}


def score_toxicity(docs: DataFrame, labels: DataFrame, is_train: Column, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), sample: int = SAMPLE) -> DataFrame:
    """(doc_id, keep, score) of every document; ``is_train`` is a condition on labels' doc_id."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(docs[doc_id].cast("long").alias("doc_id"), *[docs[c] for c in keep], docs[text].cast("string").alias("__text"))
    plain = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("__text"))
    model = fit(plain, labels, is_train, sample)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        known, restorer = Weights(m["hashes"], m["weights"]), Restorer(m["counts"])
        for b in batches:
            score = np.zeros(b.num_rows)
            for first, end, row, h in features(_restored(b, restorer)):
                x = known.document(h, row, end - first) @ m["beta"][:4] + m["beta"][4]
                score[first:end] = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score)], names=[*b.schema.names[:-1], "score"])

    return src.mapInArrow(run, column_types(src, -1) + ", score double")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0 by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
