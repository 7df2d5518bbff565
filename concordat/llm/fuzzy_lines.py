"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one per group.

A line is what stands between newlines; normalised, it is its words (ASCII letters in lower case,
digits and all bytes beyond ASCII) joined by single spaces. Two lines link when their normalised
texts are equal, or when they meet as candidates and their edit similarity, 1 - Levenshtein /
longer length, reaches ``num / den``. Of every connected group of lines the first occurrence by
(doc_id, line number) stays.

Candidates meet under keys. The 64-bit SimHash over a line's words is cut into 4 blocks, and each of
the 6 pairs of blocks is a key, so that lines which differ in 2 bits meet for certain. One changed
word of ten moves some 9 bits, so that blocks of the hash alone lose most similar lines. Hence the
line itself is cut into blocks too: runs of words of 10 bytes or more, of which the ``RUNS`` of
smallest weighted hash are keys; lines meet where one such block of both is unchanged. Longer runs
weigh more, as they are rarer. Under each key whole SimHashes are compared; lines within ``BITS``
bits form row groups, which are compared in tiles by edit similarity. Groups that consist of the same
lines under several keys are one. Words of more than 24 bytes, as a text without spaces has, count as
their characters.

The edit similarity makes every link true; whether two similar lines meet is a matter of chance,
whose recall the tests measure against brute force. Lines are equal by a 64-bit hash, which at 10^11
different lines unites about 300 that differ.

Blank lines and lines without a word always stay. Null and empty texts have no lines, and lines of
rows without a doc_id take no part and stay. Rows of equal doc_id count as one document. Other
columns keep whatever they hold.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import LOWER, U64, SpanHash, components, cut, free_name, in_filter, key_filter, mix, read_blobs, release, ship, shuffle_parts, spans, text_chunks
from .tiles import each_tile, tile_rows

#: Characters of a line, and the bits of 64 that the SimHash of a similar line may differ in: few words
#: make the hash coarse.
BITS = ((0, 22), (100, 20), (300, 18))
MASKS = [0xFFFF << 16 * a | 0xFFFF << 16 * b for a, b in combinations(range(4), 2)]
RUNS = 5
EDGE_RUNS = 3
MOST = 16  # lines of a key beyond which it is frequent
RUN_BYTES = 10
SHAPES = ((0, 1), (4, 2), (9, 3), (18, 5), (40, 7))  # units of a line, and of its runs
LONG_WORD = 24
BLOCK_ROWS = 1024
TEXT_BYTES = 1 << 18  # of text whose hashes are computed together
WIDE = 4096  # lines of a key that one task compares; larger groups are cut into tiles as they are

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: For every value of a byte of the hash, four 16-bit counters of its lower bits and four of its higher ones.
NIBBLES = [np.array([sum(((v >> (4 * n + k)) & 1) << (16 * k) for k in range(4)) for v in range(256)], U64) for n in range(2)]


def bits_of(x: np.ndarray) -> np.ndarray:
    """The 64 bits of each number, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(bool)


def simhash(words: np.ndarray, sizes: np.ndarray, starts: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Bit k is 1 where the words that have it outweigh the others; a word that repeats counts once.

    The weight is the root of the length, so that the cosine follows the share of letters that two
    lines have in common. At a tie the smallest word hash of the line decides, in lines of fewer than
    4 words the hash of the line, so that short lines don't gather at few values."""
    out = np.zeros(len(starts), U64)
    if not len(starts):
        return out
    owner = np.repeat(np.arange(len(starts)), counts)
    if len(starts) < 1 << 20:
        order = np.argsort(owner.astype(U64) << U64(44) | words >> U64(20), kind="stable")
    else:
        order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    new = np.r_[True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])]
    words, weights = words[new], np.rint(2 * np.sqrt(sizes[order][new])).astype(U64)
    counts = np.bincount(owner[new], minlength=len(starts))
    starts = np.cumsum(counts) - counts
    tie = np.where(counts < 4, mix(keys.view(U64)), np.minimum.reduceat(words, starts))
    whole = np.add.reduceat(weights, starts).astype(np.int64)
    sums, bytes_ = np.empty((16, len(starts)), U64), words.view(np.uint8).reshape(-1, 8)
    for n in range(8):
        byte = bytes_[:, n].astype(np.intp)
        for k in range(2):
            np.add.reduceat(NIBBLES[k][byte] * weights, starts, out=sums[2 * n + k])
    # of each line 64 counters, as the bits of the hash come
    ones = 2 * np.ascontiguousarray(sums.T).view(np.uint16).astype(np.int32)
    least = whole.astype(np.int32)[:, None]
    out[:] = np.packbits((ones > least) | ((ones == least) & bits_of(tie)), axis=1, bitorder="little").view(U64)[:, 0]
    for r in np.flatnonzero(whole > 65535):  # more than the counters hold
        here = slice(starts[r], starts[r] + counts[r])
        ones = [2 * int(weights[here][(words[here] >> U64(k)) & U64(1) == 1].sum()) for k in range(64)]
        out[r] = sum((int(tie[r]) >> k & 1 if x == whole[r] else int(x > whole[r])) << k for k, x in enumerate(ones))
    return out


def pick(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words of some lines, end to end, and where each line starts in them."""
    to = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - to, counts), to


def units(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Starts, ends and word of the units of words: words, but characters of words that are long."""
    long = np.flatnonzero(end - start > LONG_WORD)
    word = np.arange(len(start))
    if not len(long):
        return start, end, word
    at, _ = pick(start[long], (end - start)[long])
    of = np.repeat(long, (end - start)[long])
    inner = ((data[at] & 0xC0) != 0x80) & (at != start[of])
    at, word = np.r_[start, at[inner]], np.r_[word, of[inner]]
    order = np.argsort(at, kind="stable")
    at, word = at[order], word[order]
    return at, np.minimum(np.r_[at[1:], len(data)], end[word]), word


def run_keys(h: np.ndarray, size: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ``RUNS`` runs of smallest weighted hash of each line, 0 where there are fewer: a matrix.

    A run starts at each unit and takes as many as ``SHAPES`` has for the line's number of units, and
    more up to ``RUN_BYTES``. Where a line of an eighth fewer units would have shorter runs,
    ``EDGE_RUNS`` of those follow.
    """
    n = len(h)
    common._powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(h * common._POW[:n], out=total[1:])
    length = np.r_[0, np.cumsum(size)]
    out = np.zeros((len(first), RUNS + EDGE_RUNS), U64)
    least, units_ = np.array([x for x, _ in SHAPES]), np.array([x for _, x in SHAPES])
    shape = np.searchsorted(least, counts, "right") - 1
    lower = np.searchsorted(least, counts - counts // 8 - 1, "right") - 1
    for column, size_, which, lines in ((0, RUNS, shape, np.arange(len(first))), (RUNS, EDGE_RUNS, lower, np.flatnonzero(lower < shape))):
        owner = np.repeat(lines, counts[lines])
        a = np.arange(len(owner)) + np.repeat(first[lines] - (np.cumsum(counts[lines]) - counts[lines]), counts[lines])
        take = units_[which[owner]]
        z = np.where(take > 1, np.maximum(np.searchsorted(length, length[a] + RUN_BYTES, "left"), a + take), a + 1)
        stop = (first + counts)[owner]
        z = np.where(a == first[owner], np.minimum(z, stop), z)  # the whole line is a run at least
        good = z <= stop
        a, z, owner = a[good], z[good], owner[good]
        run = mix((total[z] - total[a]) * common._INV[a] + (z - a).astype(U64))
        weight = np.clip(length[z] - length[a] - 6, 1, 18).astype(float)
        score = -np.log(((run >> U64(11)).astype(float) + 1) / 2.0**53) / weight
        # the smallest ones are nearly always among these, so that the others needn't be sorted
        low = score * np.bincount(owner, weight, len(first))[owner] < 4 * RUNS
        held, whole = np.bincount(owner[low], minlength=len(first)), np.bincount(owner, minlength=len(first))
        low |= ((held < 2 * RUNS) & (held < whole))[owner]
        owner, run, score = owner[low], run[low], score[low]
        order = np.argsort(owner + score / (1 + score), kind="stable")
        owner, run = owner[order], run[order]
        again = np.zeros(len(run), bool)  # a run that repeats in its line
        again[1:] = (owner[1:] == owner[:-1]) & (run[1:] == run[:-1])
        owner, run = owner[~again], run[~again]
        place = np.arange(len(owner)) - np.repeat(begin := np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)]), np.diff(np.r_[begin, len(owner)]))
        few = place < size_
        out[owner[few], column + place[few]] = run[few]
    return out


def lines_of(data: np.ndarray, offsets: np.ndarray, keys_only: bool = False):
    """Row, line number, key, first byte, end byte and characters (normalised) of each line that has a
    word; the hashes and bytes of all units, and the first unit and number of units of each line. With
    ``keys_only``, up to the end byte."""
    start, end, row = spans(WORD[data], offsets)
    newline = np.flatnonzero(data == 10)
    at = np.concatenate([offsets[:-1], newline + 1])
    owner = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, newline, "right") - 1])
    order = np.lexsort((owner, at))
    at, owner = at[order], owner[order]
    number = np.arange(len(at)) - np.searchsorted(owner, owner)
    if not len(start):
        z = np.zeros(0, np.int64)
        return (z, z, z, z, z) if keys_only else (z, z, z, z, z, z, z.view(U64), z, z, z)
    first = np.searchsorted(start, at)
    counts = np.diff(np.r_[first, len(start)])
    line = np.flatnonzero(counts)
    first, counts = first[line], counts[line]
    hashes = SpanHash(data, fold=True)
    h = hashes(start, end)
    common._powers(len(h) + 1)
    total = np.zeros(len(h) + 1, U64)
    np.cumsum(h * common._POW[: len(h)], out=total[1:])
    key = mix((total[first + counts] - total[first]) * common._INV[first] + counts.astype(U64))
    out = row[first], number[line], key.view(np.int64), start[first], end[first + counts - 1]
    if keys_only:
        return out
    points = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    out = *out, np.add.reduceat(points[end] - points[start] + 1, first) - 1
    a, z, word = units(data, start, end)
    if len(a) > len(start):
        h = hashes(a, z)
        first = np.searchsorted(word, first)
        counts = np.diff(np.r_[first, len(a)])
    return *out, h, z - a, first, counts


def normalised(raw: bytes) -> str:
    """Normalised text of a line, from its bytes."""
    low = LOWER[np.frombuffer(raw, np.uint8)]
    return " ".join(w for w in np.where(WORD[low], low, np.uint8(32)).tobytes().decode("utf-8", "replace").split(" ") if w)


def anchored(a: str, b: str, x: np.ndarray, y: np.ndarray, limit: int) -> bool:
    """Whether an alignment by equal stretches of 12 characters needs at most ``limit`` edits: an
    upper bound of the distance, so that only a refusal leaves the question open."""
    i = j = cost = 0
    while True:
        for gap in (4, 10, 20, 40, 80, 160):
            if i + gap + 12 > len(a):
                return cost + max(len(a) - i, len(b) - j) <= limit
            if (at := b.find(a[i + gap : i + gap + 12], j, j + gap + limit - cost + 12)) >= 0:
                break
        else:
            return False
        p, q = i + gap, at
        while p > i and q > j and a[p - 1] == b[q - 1]:
            p, q = p - 1, q - 1
        cost += max(p - i, q - j)
        if cost > limit:
            return False
        i, j = i + gap + 12, at + 12
        n = min(len(a) - i, len(b) - j)
        differ = x[i : i + n] != y[j : j + n]
        same = int(differ.argmax()) if n and differ.any() else n
        i, j = i + same, j + same


def places(a: str, chars: set[str]) -> dict[str, int]:
    """Where each of some characters stands in a text, as bits."""
    x, out, some = np.frombuffer(a.encode("utf-32-le"), np.uint32), {}, list(chars)
    step = max(1, (1 << 20) // len(a))
    for s in range(0, len(some), step):
        part = np.array([ord(c) for c in some[s : s + step]], np.uint32)
        bits = np.packbits(x == part[:, None], axis=1, bitorder="little")
        out.update(zip(some[s : s + step], [int.from_bytes(r, "little") for r in bits], strict=True))
    return out


COLUMNS = 32  # of a distance matrix between two looks at the diagonal of the result


def within(a: str, b: str, limit: int) -> bool:
    """Whether Levenshtein(a, b) <= limit, ``b`` being no longer than ``a``, by Myers: a column of the
    matrix as bits of integers, cut to the rows that a path of that cost can reach.

    Rows beyond the cut count as one more than their neighbours, which no such path uses. A cell of the
    diagonal that ends in the result is at most the result, so that a larger one decides."""
    common = set(a) & set(b)
    if len(a) - sum(min(a.count(c), b.count(c)) for c in common) > limit:  # each other character of a costs one
        return False
    where = places(a, common)
    apart = len(a) - len(b)
    side = (limit - apart) // 2
    low = high = base = up = down = 0  # rows low to high, of which the one above has the value base
    for s in range(0, len(b), COLUMNS):
        part = b[s : s + COLUMNS]
        drop, end = max(s - side - low, 0), min(s + len(part) + apart + side, len(a))
        mask = (1 << drop) - 1
        base += (up & mask).bit_count() - (down & mask).bit_count()
        low += drop
        up, down = up >> drop | ((1 << end - high) - 1) << high - low, down >> drop
        high = end
        full = (1 << high - low) - 1
        eqs = {c: where.get(c, 0) >> low & full for c in set(part)}
        for c in part:
            eq = eqs[c]
            # what carries and shifts leave above the highest row never comes down
            d0 = (((eq & up) + up) ^ up) | eq | down
            x = (down | ~(up | d0)) << 1 | 1
            up, down = (up & d0) << 1 | ~(x | d0), x & d0
        up, down = up & full, down & full
        base += len(part)
        mask = (1 << s + len(part) + apart - low) - 1
        if base + (up & mask).bit_count() - (down & mask).bit_count() > limit:
            return False
    return True


def similar(a: str, b: str, num: int, den: int) -> bool:
    """Whether den * Levenshtein(a, b) <= (den - num) * longer length."""
    limit = (den - num) * max(len(a), len(b)) // den
    if abs(len(a) - len(b)) > limit:
        return False
    n = min(len(a), len(b))
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    m = n - head
    differ = np.flatnonzero(x[len(x) - m :][::-1] != y[len(y) - m :][::-1]) if m else []
    tail = int(differ[0]) if len(differ) else m
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b:
        return max(len(a), len(b)) <= limit
    if anchored(a, b, x[head:], y[head:], limit):
        return True
    return within(a, b, limit) if len(a) >= len(b) else within(b, a, limit)


_LENGTHS, _BITS = (np.array(x) for x in zip(*BITS, strict=True))


def allowed_bits(length: np.ndarray) -> np.ndarray:
    return _BITS[np.searchsorted(_LENGTHS, length, "right") - 1]


def close(sim: np.ndarray, length: np.ndarray, sim2: np.ndarray, length2: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether lines may be similar by their hashes and lengths (which are exact up to ``MOST_LENGTH``)."""
    low, high = np.minimum(length, length2), np.maximum(length, length2)
    return (np.bitwise_count(sim ^ sim2) <= allowed_bits(low)) & ((den * low >= num * high) | (high == MOST_LENGTH))


def lower_bits(lower: np.ndarray) -> np.ndarray:
    """Rows of bits, of which two have one in common where their lines have a key in common: ``lower`` is a
    matrix of keys, 0 for none."""
    keys, at, n = np.unique(lower, return_inverse=True, return_counts=True)
    held = (n > 1) & (keys != 0)  # a key that one line has is common to none
    place = np.where(held, np.cumsum(held) - 1, -1)[at.reshape(lower.shape)]
    bits = np.zeros((len(lower), -(-int(held.sum()) // 64)), U64)
    for c in range(lower.shape[1]):
        some = np.flatnonzero(place[:, c] >= 0)
        bits[some, place[some, c] // 64] |= U64(1) << (place[some, c] % 64).astype(U64)
    return bits


def close_groups(sim: np.ndarray, length: np.ndarray, num: int, den: int, bits: np.ndarray | None = None) -> np.ndarray:
    """A label for each line: the same where a chain of close ones joins two. Lines with ``bits`` in common
    meet elsewhere."""
    label, left, group = np.full(len(sim), -1), np.arange(len(sim)), 0
    while len(left):
        edge, left = left[:1], left[1:]
        label[edge] = group
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            for s in range(0, len(edge), 64):
                e = edge[s : s + 64, None]
                hit = close(sim[e], length[e], sim[None, left], length[None, left], num, den)
                for b in () if bits is None else bits.T:
                    hit &= (b[e] & b[None, left]) == 0
                near |= hit.any(0)
            edge, left = left[near], left[~near]
            label[edge] = group
        group += 1
    return label


#: What an entry of a bucket has beside its key: the line, its SimHash, length and number of runs.
ENTRY = np.dtype([("node", "<i8"), ("sim", "<u8"), ("length", "<u2"), ("runs", "u1")])
MOST_LENGTH = 65_535


def bucket_groups(keys: np.ndarray, rows: np.ndarray, num: int, den: int, wide: int = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """(line, group) of the lines of one bucket that are close to another under a key. A group is
    named by the hash of its lines, so that several keys name it alike."""
    order = np.lexsort((rows["node"], keys))
    keys, rows = keys[order], rows[order]
    if not len(keys):
        return rows["node"], rows["node"]
    node = rows["node"]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])]
    keys, node, sim, length = keys[new], node[new], rows["sim"][new], rows["length"][new].astype(np.int64)
    group = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[group, len(keys)])
    small = sizes <= 32
    size = np.repeat(np.where(small, sizes, 1), sizes)
    place = np.arange(len(keys)) - np.repeat(group, sizes)
    a, b = [], []
    label = np.where(np.repeat(small, sizes), np.arange(len(keys)), np.repeat(group, sizes))
    for step in range(1, int(size.max())):
        at = np.flatnonzero(place + step < size)
        hit = at[close(sim[at], length[at], sim[at + step], length[at + step], num, den)]
        a.append(hit)
        b.append(hit + step)
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if not (label[a] != label[b]).any():
                break
    middle = (sizes > 32) & (sizes <= wide)
    for s, n in zip(group[middle].tolist(), sizes[middle].tolist(), strict=True):
        label[s : s + n] = s + close_groups(sim[s : s + n], length[s : s + n], num, den)
    order = np.argsort(label, kind="stable")
    label, node = label[order], node[order]
    first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
    count = np.diff(np.r_[first, len(label)])
    name = mix(np.add.reduceat(mix(node.view(U64)), first) + count.astype(U64)).view(np.int64)
    keep = np.repeat(count > 1, count)
    return node[keep], np.repeat(name, count)[keep]


def frequent(keys: np.ndarray, most: int) -> np.ndarray:
    """Mask of the entries, sorted by key, whose key more than ``most`` entries have."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    sizes = np.diff(np.r_[first, len(keys)])
    return np.repeat(sizes > most, sizes)


def tile_links(left: list, right: list, same: bool, num: int, den: int) -> tuple[list[int], list[int]]:
    """Spanning links of a tile of rows (line, SimHash, length, lower keys, text); pairs already connected
    are skipped, and those with a lower key in common, under which they meet."""
    rows = left if same else left + right
    if same and len(rows) <= 8:
        return small_links(rows, num, den)
    sim = np.array([r[1] for r in rows], np.int64).view(U64)
    length = np.array([r[2] for r in rows], np.int64)
    bits = None
    if rows[0][3] is not None:
        bits = lower_bits(np.stack([np.frombuffer(r[3], np.int64) for r in rows]))
    left_, right_, apart = [], [], []
    for k in range(len(left)):
        start = k + 1 if same else len(left)
        near = close(sim[start:], length[start:], sim[k], length[k], num, den)
        if bits is not None:
            near &= ~(bits[start:] & bits[k]).any(1)
        m = np.flatnonzero(near) + start
        left_.append(np.full(len(m), k, np.int32))
        right_.append(m.astype(np.int32))
        apart.append(np.bitwise_count(sim[m] ^ sim[k]))
    order = np.argsort(np.concatenate(apart), kind="stable")
    left_, right_ = np.concatenate(left_)[order], np.concatenate(right_)[order]
    label, words = np.arange(len(rows)), [None] * len(rows)
    a, b = [], []
    # the closest first, so that most pairs that aren't similar are connected before their turn
    for s in range(0, len(order), 4096):
        ks, ms = left_[s : s + 4096], right_[s : s + 4096]
        some = label[ks] != label[ms]
        for k, m in zip(ks[some].tolist(), ms[some].tolist(), strict=True):
            if label[m] == label[k]:
                continue
            for x in (k, m):
                words[x] = words[x] or word_set(rows[x][4])
            if shares(words[k], words[m]) and similar(rows[k][4], rows[m][4], num, den):
                label[label == label[m]] = label[k]
                a.append(rows[k][0])
                b.append(rows[m][0])
    return a, b


def small_links(rows: list, num: int, den: int) -> tuple[list[int], list[int]]:
    """The links of a few lines, which numbers of Python compare sooner than arrays."""
    pairs = []
    for k, (_, sim, length, _, _) in enumerate(rows):
        for m in range(k + 1, len(rows)):
            low, high = sorted((length, rows[m][2]))
            apart = ((sim ^ rows[m][1]) & 0xFFFFFFFFFFFFFFFF).bit_count()
            if apart <= next(x for n, x in reversed(BITS) if n <= low) and (den * low >= num * high or high == MOST_LENGTH):
                pairs.append((apart, k, m))
    label, words = list(range(len(rows))), [word_set(r[4]) for r in rows] if pairs else []
    a, b = [], []
    for _, k, m in sorted(pairs):
        if label[m] != label[k] and shares(words[k], words[m]) and similar(rows[k][4], rows[m][4], num, den):
            label = [label[k] if x == label[m] else x for x in label]
            a.append(rows[k][0])
            b.append(rows[m][0])
    return a, b


def word_set(line: str) -> tuple[set[str], int]:
    """Different words of a line and their letters in all."""
    words = set(line.split(" "))
    return words, sum(map(len, words))


def shares(a: tuple[set[str], int], b: tuple[set[str], int]) -> bool:
    """Whether three fifths of the letters of many words are in common ones. The hashes have asked for as much,
    by chance; this only spares a distance where chance erred."""
    if len(a[0]) < 12 or len(b[0]) < 12:
        return True
    return 5 * sum(map(len, a[0] & b[0])) >= 3 * max(a[1], b[1])


NEAR = "node long, root long, sim long, length int, lower binary, bucket int, often binary"
NAMES = ["node", "root", "sim", "length", "lower", "bucket", "often"]
GROUP = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
OFTEN = np.dtype([("key", "<i8"), *ENTRY.descr])
#: An entry of a frequent key, with the line's frequent keys that are lower.
HELD = np.dtype([*OFTEN.descr, ("lower", "<i8", (RUNS + EDGE_RUNS - 1,))])


def near_batch(node: np.ndarray, root: np.ndarray, rows: np.ndarray, lower: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of groups; ``rows`` holds each line's entry at least once, ``lower`` the lower keys of each row."""
    by = np.argsort(rows["node"], kind="stable")
    own = rows[by[np.searchsorted(rows["node"][by], node)]] if len(node) else rows[:0]
    n = len(node)
    cols = [pa.array(node), pa.array(root), pa.array(own["sim"].copy().view(np.int64)), pa.array(own["length"].astype(np.int32))]
    cols += [pa.nulls(n, pa.binary()) if lower is None else pa.array([x.tobytes() for x in lower], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=NAMES)


def often_batch(rows: np.ndarray, by: str, buckets: int) -> pa.RecordBatch:
    """Entries with their keys, one row for each bucket of lines or of keys."""
    bucket = (mix(rows[by].copy().view(U64)) % U64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    ends = [*first[1:].tolist(), len(rows)] if len(first) else []
    cols = [*[pa.nulls(len(first), t) for t in GROUP], pa.array(bucket[first]), pa.array([rows[a:z].tobytes() for a, z in zip(first.tolist(), ends, strict=True)], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=NAMES)


def read_often(batches, kind: np.dtype = OFTEN) -> np.ndarray:
    got = [np.frombuffer(x, kind) for b in batches for x in b.column("often").to_pylist()]
    return np.concatenate([np.zeros(0, kind), *got])


def with_lower(rows: np.ndarray) -> np.ndarray:
    """Entries, sorted by line and key, with the lower keys of their line."""
    out = np.zeros(len(rows), HELD)
    for c in OFTEN.names:
        out[c] = rows[c]
    first = np.flatnonzero(np.r_[True, rows["node"][1:] != rows["node"][:-1]][: len(rows)])
    start = np.repeat(first, np.diff(np.r_[first, len(rows)]))
    place = np.arange(len(rows)) - start
    for c in range(out["lower"].shape[1]):
        some = np.flatnonzero(place > c)
        out["lower"][some, c] = rows["key"][start[some] + c]
    return out


def frequent_groups(rows: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries, sorted by key, of lines that are close to another under a key and under no lower one, and their groups."""
    first = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]][: len(rows)])
    at, root = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, n in zip(first.tolist(), np.diff(np.r_[first, len(rows)]).tolist(), strict=True):
        here = rows[s : s + n]
        label = close_groups(here["sim"], here["length"].astype(np.int64), num, den, lower_bits(here["lower"]))
        some = np.flatnonzero(np.bincount(label)[label] > 1)
        at.append(s + some)
        root.append(mix(here["key"][some].view(U64) + mix(label[some].astype(U64))).view(np.int64))
    return rows[np.concatenate(at)], np.concatenate(root)


def with_keys(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), OFTEN)
    out["key"] = keys.view(np.int64)
    for c in ENTRY.names:
        out[c] = rows[c]
    return out


def row_groups(lines: DataFrame, num: int, den: int, most: int = MOST, wide: int = WIDE) -> DataFrame:
    """(node, root, sim, length, lower): groups such that lines which are close under a key share a group.

    ``lines`` has key, sim, length and the runs of lines, of which each batch sends one of every key. A run that more than ``most`` lines
    have, as of a passage that many texts share, is frequent: such lines often have several of these in
    common, so that they meet under the lowest one alone. For this, each line's frequent runs are brought
    together first; ``lower`` holds those below the one of a group, and is null in the other groups.
    """
    spark, runs = lines.sparkSession, [c for c in lines.columns if re.fullmatch("r[0-9]+", c)]
    buckets, parts = 2 * shuffle_parts(spark), shuffle_parts(spark)

    def blobs(batches):
        for b in batches:
            b = b.take(pa.array(np.unique(b.column("key").to_numpy(), return_index=True)[1]))
            rows = np.zeros(b.num_rows, ENTRY)
            rows["node"], rows["sim"] = b.column("key").to_numpy(), b.column("sim").to_numpy().view(U64)
            rows["length"] = np.minimum(b.column("length").to_numpy(), MOST_LENGTH)
            keys, entries = [], []
            for k, m in enumerate(MASKS):
                keys.append(mix((rows["sim"] & U64(m)) + U64(k)))
                entries.append(rows)
            own = np.stack([b.column(r).to_numpy().view(U64) for r in runs], 1)
            with_runs = rows.copy()
            with_runs["runs"] = (own != 0).sum(1)
            for c in range(len(runs)):
                some = own[:, c] != 0
                keys.append(own[some, c])
                entries.append(with_runs[some])
            keys, entries = np.concatenate(keys), np.concatenate(entries)
            # a run that is frequent within the batch already goes to its bucket just often enough to be so there
            order = np.argsort(keys, kind="stable")
            keys, entries = keys[order], entries[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
            place = np.arange(len(keys)) - np.repeat(first, np.diff(np.r_[first, len(keys)]))
            surplus = (place > most) & (entries["runs"] > 0)
            out = common.bucket_blobs(keys[~surplus], entries[~surplus], buckets)
            # under the name that the key has where it comes out of its bucket
            known = often_batch(with_keys(common.short_keys(keys[surplus], buckets), entries[surplus]), "node", buckets)
            n, m = out.num_rows, known.num_rows
            cols = [pa.concat_arrays([out.column(0), known.column("bucket")]), *(pa.concat_arrays([out.column(k), pa.nulls(m, pa.binary())]) for k in (1, 2)), pa.concat_arrays([pa.nulls(n, pa.binary()), known.column("often")])]
            yield pa.RecordBatch.from_arrays(cols, names=["bucket", "keys", "ids", "often"])

    def meet(batches):
        held = []
        for b in batches:
            known = b.filter(b.column("keys").is_null())
            if known.num_rows:
                n = known.num_rows
                yield pa.RecordBatch.from_arrays([*[pa.nulls(n, t) for t in GROUP], known.column("bucket"), known.column("often")], names=NAMES)
            held.append(b.filter(b.column("keys").is_valid()).select(["bucket", "keys", "ids"]))
        keys, rows = read_blobs(held, kind=ENTRY)
        order = np.lexsort((rows["node"], keys))  # a line that several batches sent counts once
        keys, rows = keys[order], rows[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (rows["node"][1:] != rows["node"][:-1])][: len(keys)]
        keys, rows = keys[new], rows[new]
        many = frequent(keys, most) & (rows["runs"] > 0)
        node, root = bucket_groups(keys[~many], rows[~many], num, den, wide)
        yield near_batch(node, root, rows)
        yield often_batch(with_keys(keys[many], rows[many]), "node", buckets)

    met = cut(lines.mapInArrow(blobs, "bucket int, keys binary, ids binary, often binary").repartition(parts, "bucket").mapInArrow(meet, NEAR))

    def whole(rows):
        return near_batch(rows["node"].copy(), rows["key"].copy(), rows, rows["lower"])

    def plain(batches):
        """Of each line all frequent keys. Keys that are wide even among the lines of one task name a group
        as they are, and go on just often enough to be wide there too."""
        rows = read_often(batches)
        order = np.lexsort((rows["key"], rows["node"]))
        rows = rows[order]
        new = np.r_[True, (rows["node"][1:] != rows["node"][:-1]) | (rows["key"][1:] != rows["key"][:-1])][: len(rows)]
        rows = with_lower(rows[new])
        rows = rows[np.argsort(rows["key"], kind="stable")]
        large = frequent(rows["key"], wide)
        yield whole(rows[large])
        first = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]][: len(rows)])
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
        yield often_batch(rows[place <= wide], "key", buckets)

    def again(batches):
        rows = read_often(batches, HELD)
        rows = rows[np.argsort(rows["key"], kind="stable")]
        large = frequent(rows["key"], wide)
        yield whole(rows[large])
        rows, root = frequent_groups(rows[~large], num, den)
        yield near_batch(rows["node"].copy(), root, rows, rows["lower"])

    second = cut(met.where("often is not null").repartition(parts, "bucket").mapInArrow(plain, NEAR))
    third = second.where("often is not null").repartition(parts, "bucket").mapInArrow(again, NEAR)
    groups = met.where("often is null").unionAll(second.where("often is null")).unionAll(third)
    return cut(groups.select("node", "root", "sim", "length", "lower").distinct())


def line_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = 80, den: int = 100, block_rows: int = BLOCK_ROWS, most: int = MOST, wide: int = WIDE) -> DataFrame:
    """Per document: doc_id, n_lines (lines with a word) and removed, the sorted numbers of the
    lines (from 0) that repeat an earlier line of the corpus."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    runs = [f"r{k}" for k in range(RUNS + EDGE_RUNS)]

    def occurrences(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_chunks(b.column("text"), TEXT_BYTES):
                row, number, key, _, _, length, h, size, at, counts = lines_of(data, offsets)
                cols = [pa.array(ids[first:end][row].astype(np.int64)), pa.array(number, pa.int32()), pa.array(key)]
                cols += [pa.array(simhash(h, size, at, counts, key).view(np.int64)), pa.array(length, pa.int32())]
                cols += [pa.array(np.ascontiguousarray(x)) for x in run_keys(h, size, at, counts).view(np.int64).T]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "line", "key", "sim", "length", *runs])

    schema = "doc_id long, line int, key long, sim long, length int, " + ", ".join(f"{r} long" for r in runs)
    found = cut(src.where("doc_id is not null").mapInArrow(occurrences, schema))
    near = row_groups(found.select("key", "sim", "length", *runs), num, den, most, wide)
    found = found.select("doc_id", "line", "key")
    # lines that are near another one or repeat themselves; the others are done with
    mark = near.select(F.col("node").alias("key")).distinct().withColumn("near", F.lit(True))
    lines = cut(found.groupBy("key").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n")).join(mark, "key", "left").where("near or n > 1"))
    # of a line that repeats, the document of its first occurrence alone sends the text
    first = lines.where("near").select(F.col("key").bitwiseXOR(F.col("doc")).alias("h"), F.xxhash64("doc").alias("d"))
    bits = spark.sparkContext.broadcast((key_filter(first, "h"), key_filter(first, "d")))
    release(spark)

    def texts(batches):
        for b in batches:
            b = b.filter(pa.array(in_filter(bits.value[1], b.column("d").to_numpy())))
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for f, e, data, offsets in text_chunks(b.column("text"), TEXT_BYTES):
                row, _, key, start, end = lines_of(data, offsets, keys_only=True)
                some = np.flatnonzero(in_filter(bits.value[0], key ^ ids[f:e][row]))
                some = some[np.unique(key[some], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array([normalised(data[start[k] : end[k]].tobytes()) for k in some], pa.string())], names=["node", "text"])

    payload = src.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("d")).mapInArrow(texts, "node long, text string")
    solve = lambda left, right, same: tile_links(left, right, same, num, den)
    tiles = tile_rows(near, payload, ["sim", "length", "lower", "text"], block_rows)
    linked = components(tiles.mapInArrow(lambda it: each_tile(it, ["sim", "length", "lower", "text"], solve), "a long, b long"))

    def filtered(rows: DataFrame, mask: np.ndarray) -> DataFrame:
        held = spark.sparkContext.broadcast(mask)

        def run(batches):
            for b in batches:
                yield b.filter(pa.array(in_filter(held.value, b.column("key").to_numpy())))

        return rows.mapInArrow(run, rows.schema)

    # groups of several occurrences: the document of the first one, and its first line there
    some = lines.join(linked.withColumnRenamed("node", "key"), "key", "left").where("root is not null or n > 1").withColumn("grp", F.coalesce("root", "key"))
    whole = some.groupBy("grp").agg(F.min("doc").alias("first_doc"), F.sum("n").alias("n")).where("n > 1")
    keys = cut(some.select("key", "grp").join(whole, "grp").select("key", "grp", "first_doc"))
    every = cut(filtered(found, key_filter(keys, "key")).join(keys, "key").select("doc_id", "line", "grp", "first_doc"))
    # of each group all lines go but one; a document may hold very many lines of one group
    head = every.where("doc_id = first_doc").groupBy("grp").agg(F.min("doc_id").alias("doc_id"), F.min("line").alias("line"))
    gone = every.select("doc_id", "line").join(head.select("doc_id", "line"), ["doc_id", "line"], "left_anti")
    gone = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    count = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    ids = src.select("doc_id").where("doc_id is not null").distinct()
    none = F.array().cast("array<int>")
    return ids.join(count, "doc_id", "left").join(gone, "doc_id", "left").select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("removed", none).alias("removed"))


def drop_lines(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that ``line_groups`` removes; all other columns stay."""
    own, removed = free_name(docs, "__id"), free_name(docs, "__removed")
    gone = groups.where(F.size("removed") > 0).select(F.col("doc_id").alias(own), F.col("removed").alias(removed))
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains(removed, i), x)), lambda x: x.isNotNull()), "\n")
    out = docs.join(gone, docs[doc_id] == F.col(own), "left")
    return out.withColumn(text, F.when(F.col(removed).isNull(), F.col(text)).otherwise(kept)).drop(own, removed)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents with one occurrence of every connected group of lines."""
    return drop_lines(docs, line_groups(docs, doc_id, text, **options), doc_id, text)
