"""Private data by a character bidirectional LSTM with CRF transitions, trained in numpy.

Base spans come from fixed patterns over whole texts. The network is there for what these can't see:
addresses, numbers and cards that are spelt out, spaced or bracketed. Its labels are the base spans
of a bounded sample of texts, as they stand and rewritten in such forms where they stand, drawn by
each text's hash; windows of numbers that are no private data are its other examples. It is trained
on the driver, always from the same numbers.

Overlapping windows around every digit, every @ and every written-out "at" of whole texts are decoded
by Viterbi and reconciled globally: of the windows that hold a character, the one in whose middle it
stands most decides its tag. A span of the network counts if it has the parts of its kind (`plausible`)
and touches no base span; it gets a kind of its own. All kinds that it learns hold a digit, an @ or a
written-out "at", so no window is spent on other stretches.

Null and empty texts have no spans. Repeated rows give equal results; other columns are not read.
Without any base span in the sample the network adds nothing.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_types, cut, mix, ship, strings, text_chunks
from .spans import digest, joined

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"model_{k}" for k in BASE))
SAMPLE = 6_000  # texts that may give examples
WINDOWS = 4_000  # with a span and without one each, that train the network
STEPS, BATCH, WINDOW, HIDDEN = 700, 64, 96, 24
TAGS = 1 + 2 * len(BASE)  # O, then first and further characters of each kind

EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_USER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A written-out @: in brackets, or as a word that a written-out dot follows.
AT = r"[\[({<][\x20]?[aA][tT][\x20]?[\])}>]|[\x20](?:at|AT)[\x20][^\n]{1,48}?[\x20.\[({<](?:dot|DOT)[\x20.\])}>]"
MARK = re.compile(f"[0-9@]|{AT}")

#: Characters with a class of their own; 0 pads, other classes follow.
OWN = "@.-+() _%,:;/#\n[]{}<>atdoATDO"
CLASSES = len(OWN) + 8


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs are read once."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in EMAIL_USER:
            start -= 1
        if start < at and (m := EMAIL_HOST.match(text, at)):
            after = m.end()
            out.append(("email", start, after))
        at = text.find("@", max(after, at + 1))
    return out


def _part(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) < 4 and int(x or 0) < 256


def _digits(t: str) -> str:
    return "".join(c for c in t if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of each kind; one that fails its test is dropped and not tried again."""
    out = _emails(text)
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_part, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


#: How the parts of a rewritten span may be joined.
ATS = (" (at) ", "[at]", " [at] ", "(at)", "{at}", " <at> ", " at ", " AT ", " @ ")
DOTS = (" (dot) ", "[dot]", " [dot] ", "(dot)", " dot ", "{dot}", " DOT ", " . ", "[.]", "(.)")
BREAKS = ("  ", ".", "/", "_", " . ", " - ", " / ")


def rewritten(kind: str, text: str, rng: np.random.Generator) -> str:
    """A base span in a form that no base pattern finds."""
    one = lambda xs: xs[int(rng.integers(len(xs)))]
    if kind == "email":
        user, _, host = text.partition("@")
        dot = one(DOTS)
        at = one(ATS if "dot" in dot.lower() else (*ATS[:6], " @ "))  # " at " alone is a plain word
        if "@" not in at and rng.random() < 0.4:
            user = user.replace(".", dot)
        return user + at + host.replace(".", dot)
    if kind == "ip":
        return one(DOTS).join(text.split("."))
    digits = _digits(text)
    if kind == "card":
        return one(BREAKS).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    by = one(("/", " / ", ".", "  ", "_"))
    groups = [digits[:-7], digits[-7:-4], digits[-4:]]
    return one(("00", "+", "(00) ", "(+)")) + by.join(groups) if rng.random() < 0.6 else f"({digits[:-7]}) {digits[-7:-4]}{one((' ', '-', '.'))}{digits[-4:]}"


def plausible(kind: str, text: str) -> bool:
    """Whether a span has the parts of its kind: the digits, or a user, an @ and a dot."""
    if kind == "email":
        low = text.lower()
        return ("@" in text or "at" in low) and ("." in text or "dot" in low) and len(text) >= 6
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_part, parts))
    digits = _digits(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and text.lstrip("(").startswith(("+", "00", "0")) or 9 <= len(digits) <= 12 and text.startswith("(")


_TABLE = np.full(129, 1, np.int8)
_TABLE[48:58], _TABLE[97:123], _TABLE[65:91], _TABLE[128] = 2, 3, 4, 5
_TABLE[list(b"$&*!?'\"=")] = 6
for _k, _x in enumerate(OWN):
    _TABLE[ord(_x)] = 7 + _k


def classes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(c, 128)]


def window_starts(text: str) -> list[int]:
    """Starts of windows that hold every mark twice, once near the middle."""
    out, reach = [], -1
    for m in MARK.finditer(text):
        for at in (m.start(), m.end() - 1):
            while at >= reach:
                start = max(0, at - WINDOW // 2) if reach < 0 or at - reach > WINDOW else reach - WINDOW // 4
                out.append(start)
                reach = start + 3 * WINDOW // 4
    return out


def cut_window(c: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int8)
    part = c[start : start + WINDOW]
    out[: len(part)] = part
    return out


def tags_of(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(length, np.int8)
    for kind, a, b in spans:
        k = 1 + 2 * BASE.index(kind)
        out[a], out[a + 1 : b] = k, k + 1
    return out


def examples(text: str, rng: np.random.Generator) -> list[tuple[bytes, bytes]]:
    """Windows and their tags: of the text around its spans and numbers, and around each span twice
    more, rewritten. Of a long text those around 64 spans and 64 numbers are drawn."""
    spans = sorted(base_spans(text), key=lambda x: (x[1], -x[2]))
    free, reach = [], 0
    for x in spans:  # the first of those that overlap
        if x[1] >= reach:
            free.append(x)
            reach = x[2]
    c, y, out = classes(text), tags_of(len(text), free), []
    add = lambda c, y, s: out.append((cut_window(c, s).tobytes(), cut_window(y, s).tobytes()))
    starts = window_starts(text)
    for s in (starts[k] for k in sorted(rng.permutation(len(starts))[:64])):
        add(c, y, s)
    for kind, a, b in (free[k] for k in sorted(rng.permutation(len(free))[:64])):
        for _ in range(2):
            new = rewritten(kind, text[a:b], rng)
            if base_spans(new):
                continue
            head, tail = text[max(0, a - WINDOW) : a], text[b : b + WINDOW]
            near = classes(head + new + tail)
            tags = np.concatenate([y[a - len(head) : a], tags_of(len(new), [(kind, 0, len(new))]), y[b : b + len(tail)]])
            add(near, tags, max(0, len(head) + len(new) // 2 - WINDOW // 2 + int(rng.integers(-24, 25))))
    return out


def parameters(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    g = lambda *s: rng.standard_normal(s) * 0.2
    p = {}
    for d in "fb":
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN : 2 * HIDDEN] = 1
        p |= {f"x{d}": g(CLASSES, 4 * HIDDEN), f"h{d}": g(HIDDEN, 4 * HIDDEN), f"c{d}": bias}
    return p | {"out": g(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS), "move": g(TAGS, TAGS), "open": np.zeros(TAGS)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def lstm(p: dict, d: str, x: np.ndarray, keep: bool = False):
    """Hidden states of one direction, time first; with ``keep`` what the backward pass needs."""
    hidden, cell = np.zeros((x.shape[1], HIDDEN), p["out"].dtype), np.zeros((x.shape[1], HIDDEN), p["out"].dtype)
    out, tape = np.empty((len(x), x.shape[1], HIDDEN), p["out"].dtype), []
    for t in range(len(x)):
        z = p[f"x{d}"][x[t]] + hidden @ p[f"h{d}"] + p[f"c{d}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
        g = np.tanh(z[:, 3 * HIDDEN :])
        was, before = cell, hidden
        cell = f * was + i * g
        th = np.tanh(cell)
        hidden = o * th
        out[t] = hidden
        if keep:
            tape.append((i, f, o, g, was, th, before))
    return out, tape


def emissions(p: dict, x: np.ndarray, keep: bool = False):
    xt = x.T
    f, tf = lstm(p, "f", xt, keep)
    b, tb = lstm(p, "b", xt[::-1], keep)
    both = np.concatenate([f, b[::-1]], 2)
    return both @ p["out"] + p["bias"], both, tf, tb


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def loss_and_gradient(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of the tags of windows, and its gradient."""
    n, length = x.shape
    e, both, tf, tb = emissions(p, x, True)
    yt, rows = y.T, np.arange(n)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = p["open"] + e[0]
    for t in range(1, length):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + p["move"], 1) + e[t]
    for t in range(length - 2, -1, -1):
        beta[t] = _lse(p["move"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _lse(alpha[-1], 1)
    gold = p["open"][yt[0]] + sum(e[t][rows, yt[t]] for t in range(length)) + sum(p["move"][yt[t - 1], yt[t]] for t in range(1, length))
    de = np.exp(alpha + beta - z[None, :, None])
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    for t in range(1, length):
        grad["move"] += np.exp(alpha[t - 1][:, :, None] + p["move"] + (e[t] + beta[t] - z[:, None])[:, None, :]).sum(0)
        np.subtract.at(grad["move"], (yt[t - 1], yt[t]), 1)
    for t in range(length):
        de[t][rows, yt[t]] -= 1
    grad["open"] = de[0].sum(0)
    de /= n
    grad["move"] /= n
    grad["open"] /= n
    grad["out"] = np.einsum("tbh,tbk->hk", both, de)
    grad["bias"] = de.sum((0, 1))
    dh = de @ p["out"].T
    for d, tape, dout, xt in (("f", tf, dh[:, :, :HIDDEN], x.T), ("b", tb, dh[::-1, :, HIDDEN:], x.T[::-1])):
        hidden, cell = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        for t in range(length - 1, -1, -1):
            i, f, o, g, was, th, before = tape[t]
            hidden = hidden + dout[t]
            cell = cell + hidden * o * (1 - th * th)
            dz = np.concatenate([cell * g * i * (1 - i), cell * was * f * (1 - f), hidden * th * o * (1 - o), cell * i * (1 - g * g)], 1)
            np.add.at(grad[f"x{d}"], xt[t], dz)
            grad[f"h{d}"] += before.T @ dz
            grad[f"c{d}"] += dz.sum(0)
            hidden, cell = dz @ p[f"h{d}"].T, cell * f
    return float((z - gold).mean()), grad


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 5) -> dict:
    """Adam over random batches; half of each batch are windows with a span."""
    p, rng = parameters(seed), np.random.default_rng(seed)
    some, none = np.flatnonzero(y.any(1)), np.flatnonzero(~y.any(1))
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for s in range(1, steps + 1):
        pick = rng.choice(some, BATCH // 2) if not len(none) else np.r_[rng.choice(some, BATCH // 2), rng.choice(none, BATCH // 2)]
        _, grad = loss_and_gradient(p, x[pick], y[pick])
        scale = min(1.0, 5 / (1e-9 + np.sqrt(sum((g * g).sum() for g in grad.values()))))
        rate = 0.02 * (1 - s / (steps + 1)) ** 0.5
        for k, g in grad.items():
            g = g * scale
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**s)) / (np.sqrt(v[k] / (1 - 0.99**s)) + 1e-8)
    return {k: a.astype(np.float32) for k, a in p.items()}


def viterbi(p: dict, x: np.ndarray) -> np.ndarray:
    """Best tags of windows."""
    e = emissions(p, x)[0]
    score, back = p["open"] + e[0], []
    for t in range(1, len(e)):
        step = score[:, :, None] + p["move"]
        back.append(step.argmax(1))
        score = step.max(1) + e[t]
    out = np.empty(x.shape, np.int64)
    out[:, -1] = score.argmax(1)
    for t in range(len(e) - 2, -1, -1):
        out[:, t] = back[t][np.arange(len(x)), out[:, t + 1]]
    return out


def reconciled(length: int, starts: list[int], tags: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of one text from its decoded windows."""
    place = (np.array(starts)[:, None] + np.arange(WINDOW)).ravel()
    k = np.arange(WINDOW)
    sure = np.where(np.array(starts)[:, None] > 0, np.minimum(k, WINDOW - 1 - k), WINDOW - 1 - k).ravel()
    order = np.lexsort((np.arange(len(place)), -sure, place))
    place, tag = place[order], tags.ravel()[order]
    first = np.r_[True, place[1:] != place[:-1]] & (place < length)
    place, tag = place[first], tag[first]
    some = tag > 0
    place, tag = place[some], tag[some]
    if not len(place):
        return []
    kind = (tag - 1) // 2
    opens = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (tag[1:] % 2 == 1) | (place[1:] != place[:-1] + 1)])
    ends = np.r_[opens[1:], len(place)] - 1
    return [(BASE[kind[a]], int(place[a]), int(place[z]) + 1) for a, z in zip(opens.tolist(), ends.tolist(), strict=True)]


def fit(texts: DataFrame, sample: int = SAMPLE, windows: int = WINDOWS) -> dict | None:
    """The network, from examples of at most ``sample`` texts, those with a mark of the smallest hash,
    and of these at most ``windows`` with a span and as many without: so much reaches the driver."""
    h = F.xxhash64("__text").alias("h")
    some = texts.where(F.col("__text").rlike("[0-9@]"))
    chosen = some.select(h).distinct().orderBy("h").limit(sample)  # hashes alone are shuffled
    rows = some.select(h, F.col("__text").alias("t")).join(F.broadcast(chosen), "h").dropDuplicates(["h"])

    def draw(batches):
        for b in batches:
            out = []
            for h, t in zip(b.column("h").to_pylist(), b.column("t").to_pylist(), strict=True):
                for n, (x, y) in enumerate(examples(t, np.random.default_rng(h & 0xFFFFFFFF))):
                    out.append((bool(y.strip(b"\0")), int(mix(np.array([h], np.int64).view(np.uint64) + np.uint64(n)).view(np.int64)[0]), x, y))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["held", "k", "x", "y"])

    drawn = cut(rows.mapInArrow(draw, "held boolean, k long, x binary, y binary"))
    few = [r for held in ("held", "not held") for r in drawn.where(held).orderBy("k", "x", "y").limit(windows).collect()]
    got = sorted((r["k"], bytes(r["x"]), bytes(r["y"])) for r in few)
    if not any(y.strip(b"\0") for _, _, y in got):
        return None
    x, y = (np.frombuffer(b"".join(r[k] for r in got), np.int8).reshape(-1, WINDOW).astype(np.int64) for k in (1, 2))
    return train(x, y)


def find_private(texts: list[str], model: dict | None) -> list[tuple[list, list]]:
    """Base spans and the network's further spans of each text."""
    base = [base_spans(t) if t else [] for t in texts]
    more: list[list] = [[] for _ in texts]
    if model is not None:
        starts = [window_starts(t) for t in texts]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        ask, own = [], []

        def decode():
            for n, row in zip(own, viterbi(model, np.stack(ask)), strict=True):
                found[n].append(row.astype(np.int8))
            ask.clear()
            own.clear()

        for n, (t, ss) in enumerate(zip(texts, starts, strict=True)):
            c = classes(t) if ss else None
            for s in ss:
                ask.append(cut_window(c, s))
                own.append(n)
                if len(ask) == 512:
                    decode()
        if ask:
            decode()
        for n, (t, ss) in enumerate(zip(texts, starts, strict=True)):
            if ss:
                reach = _union(base[n])
                for k, a, b in reconciled(len(t), ss, np.stack(found[n]).astype(np.int64)):
                    if plausible(k, t[a:b]) and not _touches(reach, a, b):
                        more[n].append((f"model_{k}", a, b))
    return list(zip(base, more, strict=True))


def _union(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted((a, z) for _, a, z in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _touches(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether any of the sorted, separate spans shares a character with a to b."""
    k = bisect.bisect_left(spans, (b, -1))
    return k > 0 and spans[k - 1][1] > a


def scan_private(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of each whole text."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(*keep, docs[text].cast("string").alias("__text"))
    held = spark.sparkContext.broadcast(fit(src, sample))
    schema = column_types(src, -1)
    empty = digest("")
    marks = np.zeros(256, bool)
    marks[[*range(48, 58), 64]] = True

    def run(batches):
        model = held.value
        for b in batches:
            out = [(0, 0, 0, 0, empty, "")] * b.num_rows
            column = b.column(b.num_columns - 1)
            spelt = np.asarray(pc.fill_null(pc.match_substring_regex(column, AT), False))
            for first, end, data, offsets in text_chunks(column):
                at = np.union1d(first + np.searchsorted(offsets, np.flatnonzero(marks[data]), "right") - 1, first + np.flatnonzero(spelt[first:end]))
                for s in range(0, len(at), 256):
                    part = at[s : s + 256]
                    for k, (base, more) in zip(part.tolist(), find_private(strings(column.take(pa.array(part))), model), strict=True):
                        own = joined(base, KINDS)
                        out[k] = (*(sum(n == x[0] for x in base) for n in BASE), digest(own), joined(base + more, KINDS) if more else own)
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string())
            names = (*(f"n_{k}" for k in BASE), "base_sha256", "spans")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*b.schema.names[:-1], *names])

    return src.mapInArrow(run, f"{schema}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
