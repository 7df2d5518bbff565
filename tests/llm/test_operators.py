"""The training-data operators against brute force, round trips and held-out labels."""

import base64
import collections
import gzip
import os
import random
import re
import time
import urllib.parse

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import common, decontaminate, fuzzy_lines, licences, nearest, ngram_join, private_data, queries, secrets, sentence_runs, toxicity
from concordat.llm.common import components
from concordat.llm.pieces import PieceModel, encode_decode

SF = "/root/testdata/sf0.001"
ODD = [(None, None), (1, ""), (2, "  \n "), (3, "one two"), (3, "one two"), (4, "x " * 3000), (5, None), (6, "é" * 500 + ".\n" + "ñ 中文 龘 \x00 ok.")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long and repeated rows, with columns whose names clash."""
    return spark.createDataFrame([(i, t, "a", 1, 2.0, "s") for i, t in ODD], "doc_id long, text string, node string, grp int, score double, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def union_find(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [(a, b) for a, b in edges if a != b]
    assert got == union_find(edges, {x for e in edges for x in e})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_of_one_hash():
    """Where unequal sets share a node, the second hash parts them, within their size class."""
    rng, low_ = np.random.default_rng(1), ngram_join.size_classes(85, 100)
    grams, sizes = rng.integers(0, 1 << 63, 40).astype(np.uint64), np.array([10, 0, 10, 20])
    none = np.zeros(0, np.int64)
    node = ngram_join.set_keys(grams, sizes, low_, none)
    again = ngram_join.set_keys(grams, sizes, low_, node[[0]])
    assert again[0] != node[0] and (again[1:] == node[1:]).all()
    assert again[0].view(np.uint64) >> np.uint64(58) == node[0].view(np.uint64) >> np.uint64(58)
    assert len(set(node.tolist())) == 4 == len({*ngram_join.set_sums(grams, sizes, ngram_join.CHECK).tolist()})


@pytest.mark.parametrize(("n", "num", "blocks"), [(4, 85, 2048), (5, 80, 2)])
def test_ngram_join(docs, n, num, blocks):
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = union_find(pairs, sets)
    got = {tuple(r) for r in ngram_join.ngram_components(docs, n=n, num=num, block_rows=blocks).collect()}
    assert got == {(i, len(s), root[i]) for i, s in sets.items()}


def test_ngram_join_near_sizes(spark):
    """Sets around the threshold at every small size, and a passage that all texts share."""
    rng, rows = random.Random(1), []
    shared = [f"s{k}" for k in range(30)]
    for size in [*range(1, 40), 90, 97, 120]:
        base = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(size)] = f"x{rng.randrange(10**9)}"
            rows.append(" ".join(w))
            rows.append(" ".join(w + shared))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} for i, w in ((i, t.split()) for i, t in enumerate(rows))}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = union_find(pairs, sets)
    for blocks in (2048, 3):
        assert {tuple(r) for r in ngram_join.ngram_components(df, block_rows=blocks).collect()} == {(i, len(s), root[i]) for i, s in sets.items()}


def test_ngram_join_leaves_no_shuffles(spark, docs, monkeypatch):
    """What finished steps have shuffled is gone without the help of any garbage collection, as are the
    counters that tasks have written; the result can be read again and the session is as before."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks, steps, dropped = disk.getAllBlocks, [], []
    shuffles = lambda: {x for x in (str(b) for b in blocks().mkString(" ").split()) if x.startswith("shuffle_")}
    monkeypatch.setattr(ngram_join, "release", lambda spark: None)
    monkeypatch.setattr(common, "release", lambda spark: None)
    was, kept, drop = shuffles(), ngram_join.cut, ngram_join.drop_cut

    def cut(df):
        out = kept(df)
        for _ in range(100):
            if not (left := shuffles() - was):
                break
            time.sleep(0.1)
        steps.append(left)
        return out

    def drop_cut(df):
        dropped.append(df)
        drop(df)

    monkeypatch.setattr(ngram_join, "cut", cut)
    monkeypatch.setattr(ngram_join, "drop_cut", drop_cut)
    setting = spark.conf.get(common.SHUFFLES_GO, None)
    out = ngram_join.ngram_components(docs)
    assert len(steps) > 5 and not any(steps)
    assert spark.conf.get(common.SHUFFLES_GO, None) == setting
    (counts,) = dropped
    assert not os.path.exists(counts._jdf.queryExecution().logical().rdd().getCheckpointFile().get().removeprefix("file:"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, out.collect())) and out.count() == docs.count()


def edit_distance(a, b):
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
    a, b = a[head:], b[head:]
    tail = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))  # noqa: B905
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    x, steps = np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    row = steps.copy()
    for i, c in enumerate(a):
        new = np.r_[i + 1, np.minimum(row[1:] + 1, row[:-1] + (x != ord(c)))]
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def similar_lines(rows):
    """Lines by (doc_id, number) as sets of words' texts, and all pairs of different texts whose edit
    similarity reaches 0.8, found without any code of the operator."""
    word = re.compile("[a-z0-9\u0080-\U0010ffff]+")
    occ = [(i, k, " ".join(word.findall(low(line)))) for i, t in sorted((i, t) for i, t in rows if i is not None) for k, line in enumerate((t or "").split("\n"))]
    occ = [x for x in occ if x[2]]
    uniq = sorted({z for _, _, z in occ}, key=lambda z: (len(z), z))
    letters = {c: n for n, c in enumerate(sorted(set("".join(uniq))))}
    bags, sizes, pairs = np.zeros((len(uniq), len(letters)), np.int32), np.array([len(u) for u in uniq]), []
    for n, u in enumerate(uniq):
        np.add.at(bags[n], [letters[c] for c in u], 1)
    two = np.zeros((len(uniq), 509), np.int16)
    for n, u in enumerate(uniq):
        c = np.array([ord(x) for x in u])
        np.add.at(two[n], (c[:-1] * 31 + c[1:]) % 509, 1)
    for a in range(len(uniq)):  # an edit changes one letter and two pairs of letters at most
        for start in range(a + 1, np.searchsorted(sizes, sizes[a] * 1.25 + 1e-9, "right"), 5000):
            here = slice(start, min(start + 5000, len(uniq)))
            more = bags[here] - bags[a]
            some = np.flatnonzero(5 * np.maximum(more.clip(0).sum(1), (-more).clip(0).sum(1)) <= sizes[here]) + start
            more = two[some] - two[a]
            for b in some[5 * np.maximum(more.clip(0).sum(1), (-more).clip(0).sum(1)) <= 2 * sizes[some]]:
                if sizes[b] * 4 <= sizes[a] * 5 and edit_distance(uniq[a], uniq[b]) <= sizes[b] // 5:
                    pairs.append((uniq[a], uniq[b]))
    return occ, pairs


def test_fuzzy_lines(docs):
    """Against brute force: only lines similar to an earlier one go, and nearly all of those do. Texts of
    over 10,000 characters are left to other tests, for the plain edit distance takes minutes on them."""
    docs = docs.where(F.length("text") < 10_000)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    occ, pairs = similar_lines(texts)
    root, seen = union_find(pairs, {z for _, _, z in occ}), set()
    again = {(i, k) for i, k, z in occ if root[z] in seen or seen.add(root[z])}
    rows = fuzzy_lines.line_groups(docs, block_rows=4).collect()
    count = collections.Counter(i for i, _, _ in occ)
    assert {r.doc_id: r.n_lines for r in rows} == {i: count[i] for i, _ in texts}
    gone = {(r.doc_id, k) for r in rows for k in r.removed}
    exact, known = set(), set()
    for i, k, z in occ:
        if z in known:
            exact.add((i, k))
        known.add(z)
    assert exact <= gone <= again
    assert len(gone - exact) >= 0.97 * len(again - exact) > 0, (len(gone - exact), len(again - exact))


def test_fuzzy_lines_with_changed_letters(spark):
    """One letter, a word, or a tenth of the letters changed, in lines of all lengths and scripts."""
    rng, rows = random.Random(9), []
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randrange(2, 9)))
    for n in (4, 6, 9, 14, 25, 60):
        for alphabet in ("abcdefghijklmnop", "àéîõüßabc"):
            for _ in range(12):
                w = [word(alphabet) for _ in range(n)]
                rows.append(" ".join(w))
                line = list(" ".join(w))
                line[rng.randrange(len(line) // 2)] = "z"
                rows.append("".join(line))
                if n > 6:
                    w[n // 2] = "changed"
                    rows.append(" ".join(w))
                if n > 9:
                    line = list(" ".join(w))
                    at = rng.randrange(len(line) * 4 // 5)
                    line[at : at + len(line) // 10] = "y" * (len(line) // 10)
                    rows.append("".join(line))
    for _ in range(30):  # no spaces at all
        t = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(40))
        rows += [t, t[:10] + "z" + t[11:], t[:20] + "yy" + t[20:]]
    occ, pairs = similar_lines(list(enumerate(rows)))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    gone = {r.doc_id for r in fuzzy_lines.line_groups(df).collect() if r.removed}
    root, seen = union_find(pairs, {z for _, _, z in occ}), set()
    again = {i for i, _, z in occ if root[z] in seen or seen.add(root[z])}
    assert gone <= again and len(gone) >= 0.97 * len(again), (len(gone), len(again))


def test_fuzzy_lines_large_groups(spark):
    """A run of words that hundreds of lines share, most of them otherwise unlike each other."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    rows = [f"{word()} {word()} internationalisation committee {word()} {word()}" for _ in range(300)]
    rows += [f"{r} end" for r in rows[:40]] + [rows[0]] * 50
    got = fuzzy_lines.line_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), block_rows=16, most=4, wide=64).collect()
    gone = {r.doc_id for r in got if r.removed}
    assert gone <= set(range(300, 390)) and len(gone) >= 88


@pytest.mark.parametrize(("most", "wide"), [(2, 40), (2, 4096), (16, 8)])
def test_fuzzy_lines_of_frequent_runs(spark, most, wide):
    """Numbered headings: whatever they have in common, all of them have."""
    rows = [f"annual report of the committee on standards chapter {k}" for k in range(150)] + [f"unlike everything else {k * k * 7919} ending" for k in range(20)]
    got = fuzzy_lines.line_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), block_rows=16, most=most, wide=wide).collect()
    assert {r.doc_id for r in got if r.removed} >= set(range(1, 150))


def test_edit_distance_bounds():
    """The quick acceptance by equal stretches never takes what is too far apart."""
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.choice("abcdefgh ") for _ in range(rng.randrange(40, 160))]
        b = list(a)
        for _ in range(rng.randrange(0, 8)):
            at = rng.randrange(len(b))
            b[at : at + rng.randrange(0, 12)] = [rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 12))]
        a, b = "".join(a), "".join(b)
        assert fuzzy_lines.similar(a, b, 80, 100) == (100 * edit_distance(a, b) <= 20 * max(len(a), len(b)))


def test_edit_similarity():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choice("abcñ") for _ in range(rng.randrange(12))) for _ in range(2))
        assert fuzzy_lines.similar(a, b, 60, 100) == (100 * edit_distance(a, b) <= 40 * max(len(a), len(b)))


def test_pieces(spark, odd):
    import sentencepiece

    path = queries.tokenizer_file(spark)
    lib, mine = sentencepiece.SentencePieceProcessor(model_file=path), PieceModel(path)
    rng = random.Random(4)
    texts = ["", " ", "▁x", "a\tb\nc  d", "<s> <0x41>", "ﬁ 中文 龘é\x00", "=" * 300, *("".join(rng.choice("ab th  ing\né中▁-=") for _ in range(60)) for _ in range(300))]
    assert mine.encode(texts) == lib.encode(texts)
    assert [mine.decode(i) for i in lib.encode(texts)] == [lib.decode(i) for i in lib.encode(texts)]
    rows = encode_decode(odd, path).collect()
    assert [r.token_ids for r in rows] == lib.encode([t or "" for _, t in ODD])
    assert [r.decoded for r in rows] == [lib.decode(i) for i in lib.encode([t or "" for _, t in ODD])]


def test_toxicity(spark):
    lit = [(k, ("the idiot and moron are here " if k % 3 == 0 else "the calm word of the day is here ") + f"w{k}") for k in range(300)]
    lit += [(1000, "an 1d10t and a m0r0n !"), (1001, None), (1002, ""), (1003, "the i d i o t spoke")]
    df = spark.createDataFrame(lit, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(df, labels, ~toxicity.held_out(F.col("doc_id"))).collect()}
    assert all((got[k] >= 0.5) == (k % 3 == 0) for k in range(300))
    assert got[1003] >= 0.5 > got[1001] == got[1002]
    assert {r.score for r in toxicity.score_toxicity(df, labels.limit(0), F.lit(True)).collect()} <= {1 / (1 + np.exp(30))}


def test_toxicity_signs_at_ends_and_apart(spark):
    lit = [(k, ("the idiot and moron are here " if k % 3 == 0 else "the calm word of the day is here ") + f"w{k}") for k in range(300)]
    bad = ["idio7", "idio7,", "m 0 r 0 n", "1 d 1 0 t", "1.d.1.0.t", "m-0-r-0-n", "i d 1 0 7"]
    good = ["calm!", "word (day)", "1 2 3", "1.0.3.4", "of 5 + 3 + 1", "day 1 a"]
    lit += [(1000 + k, f"the {t} is here") for k, t in enumerate(bad)] + [(2000 + k, f"the {t} is here") for k, t in enumerate(good)]
    df = spark.createDataFrame(lit, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(df, labels, ~toxicity.held_out(F.col("doc_id"))).collect()}
    assert all((got[k] >= 0.5) == (k % 3 == 0) for k in range(300))
    assert [t for k, t in enumerate(bad) if got[1000 + k] < 0.5] == [] == [t for k, t in enumerate(good) if got[2000 + k] >= 0.5]


def test_private_data_gradient_and_scan(odd):
    rng = np.random.default_rng(0)
    p, x, y = private_data.parameters(), rng.integers(0, private_data.CLASSES, (2, 6)), rng.integers(0, private_data.TAGS, (2, 6))
    _, grad = private_data.loss_and_gradient(p, x, y)
    for k in ("hf", "hb", "cf", "out", "move", "open"):
        at = tuple(0 for _ in p[k].shape)
        ends = []
        for e in (1e-5, -1e-5):
            q = dict(p) | {k: p[k].copy()}
            q[k][at] += e
            ends.append(private_data.loss_and_gradient(q, x, y)[0])
        assert abs((ends[0] - ends[1]) / 2e-5 - grad[k][at]) < 1e-6
    assert {r.spans for r in private_data.scan_private(odd).collect()} == {""}
    assert private_data.base_spans("a@b.cc, 1.2.3.4 or 1.2.3.400; +1 (555) 010-9999") == [("email", 0, 6), ("ip", 8, 15), ("phone", 30, 47)]


def planted_private(seed, count):
    """Texts with values that no base pattern finds, and where these stand; and numbers that are no
    private data. Written by rules of the test's own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randrange(3, 8)))
    rows = []
    for k in range(count):
        digits = "".join(rng.choice("123456789") for _ in range(11))
        body = f"4{rng.randrange(10**14):014d}"
        card = next(body + str(x) for x in range(10) if private_data.luhn(body + str(x)))
        value, kind = [
            (f"{word()}.{word()} (at) {word()} (dot) org", "email"),
            (f"{word()}[at]{word()}[dot]com", "email"),
            (f"{word()} at {word()} dot net", "email"),
            (" . ".join(str(rng.randrange(1, 255)) for _ in range(4)), "ip"),
            ("[.]".join(str(rng.randrange(1, 255)) for _ in range(4)), "ip"),
            (".".join(card[i : i + 4] for i in (0, 4, 8, 12)), "card"),
            (f"({digits[:3]}) {digits[3:6]}-{digits[6:10]}", "phone"),
            (f"+{digits[:2]}/{digits[2:5]}/{digits[5:]}", "phone"),
            (f"{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02d}-11", None),
            (f"{rng.randrange(10**6):,} items at {rng.randrange(9)}.{rng.randrange(99):02d} each", None),
            (f"version {rng.randrange(9)}.{rng.randrange(9)}.{rng.randrange(9)}", None),
            (f"look at the {word()} and dot the line {rng.randrange(99)}", None),
        ][k % 12]
        head = " ".join(word() for _ in range(rng.randrange(5, 30))) + " "
        rows.append((head + value + " " + " ".join(word() for _ in range(rng.randrange(5, 30))), kind, len(head), len(head) + len(value)))
    return rows


def test_private_data_beyond_the_patterns(spark):
    """Trained on plain values only, the network finds rewritten ones in texts it hasn't seen."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randrange(3, 8)))
    plain = []
    for k in range(1200):
        body = f"4{rng.randrange(10**14):014d}"
        card = next(body + str(x) for x in range(10) if private_data.luhn(body + str(x)))
        value = [f"{word()}.{word()}@{word()}.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card, f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)} {rng.randrange(10**6):06d}", str(rng.randrange(10**5)), f"{rng.randrange(31)}.{rng.randrange(12)}.20{rng.randrange(10, 30)}"][k % 6]
        plain.append((k, " ".join(word() for _ in range(20)) + " " + value + " " + " ".join(word() for _ in range(20))))
    asked = planted_private(12, 480)
    rows = plain + [(10_000 + k, t) for k, (t, *_) in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = private_data.fit(df.where("doc_id < 10000").select(F.col("text").alias("__text")))
    found = private_data.find_private([t for t, *_ in asked], model)
    hits = collections.Counter()
    for (_, kind, a, b), (base, more) in zip(asked, found, strict=True):
        assert not base or kind is None
        for k, s, e in more:
            right = kind is not None and k == f"model_{kind}" and abs(s - a) <= 2 and abs(e - b) <= 2
            hits["right" if right else "wrong"] += 1
        hits["there"] += kind is not None
    recall, precision = hits["right"] / hits["there"], hits["right"] / max(1, hits["right"] + hits["wrong"])
    print("private data beyond the patterns: recall", recall, "precision", precision)
    assert recall >= 0.85 and precision >= 0.9, hits


def test_long_unbroken_texts():
    """A megabyte without a space takes seconds, not hours, and 5,000 digits don't stop the scan."""
    import time

    began = time.perf_counter()
    for t in ("a" * 10**6 + "%", "a" * 10**6 + "@", "1" * 10**6, "0" * 5000 + ".1.1.1", "1." * 500_000, "&a" * 500_000, "+1" * 300_000):
        secrets.find_secrets(t)
        private_data.base_spans(t)
    assert private_data.base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]
    restorer = toxicity.Restorer(np.ones(28**3))
    for t in ("ab" * 300_000 + "$", "0 " * 300_000, "a1" * 50_000, "=" * 10**6 + "a1"):
        restorer(t)
    assert time.perf_counter() - began < 60


def test_anchored_scans_equal_patterns():
    """What the scans find outwards from their anchors is what the plain patterns find."""
    rng = random.Random(1)
    percent, email, ip = re.compile(r"[^\s%]*(?:%[0-9A-Fa-f]{2}[^\s%]*)+"), re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
    for _ in range(4000):
        t = "".join(rng.choice("%4aFg  \n") for _ in range(rng.randrange(30)))
        assert [m.span() for m in percent.finditer(t)] == list(secrets.escaped_runs(t, secrets.ONE_PERCENT, secrets.PERCENTS, "%"))
        t = "".join(rng.choice("a@.-9 @é%") for _ in range(rng.randrange(25)))
        assert [m.span() for m in email.finditer(t)] == [x[1:] for x in private_data.base_spans(t) if x[0] == "email"]
        t = "".join(rng.choice("19.0. ") for _ in range(rng.randrange(30)))
        assert [m.span() for m in ip.finditer(t)] == [m.span() for m in private_data.IP.finditer(t)]


def test_toxicity_gate_lets_disguises_through():
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["buy\u00a0@ss", "x\u2003$hit", "a²!d", "idio7", "1 d 1 0 t", "\U0001d41a\U0001d41a\U0001d41a"]
    texts += ["".join(rng.choice("aab1 0.@-_x²é\u2003\u00a0!$ 9") for _ in range(rng.randrange(24))) for _ in range(5000)]
    for t, passed in zip(texts, toxicity.suspicious(pa.array(texts)), strict=True):
        assert passed or not list(toxicity.disguised(t)), t


def test_secrets(odd):
    plain = "token=abcdefgh1234"
    b64 = lambda t: base64.b64encode(t if isinstance(t, bytes) else t.encode()).decode()
    for t in (b64(plain), b64(gzip.compress(plain.encode())), urllib.parse.quote(plain, safe=""), b64(b64(b64(plain))), "".join(f"\\u{ord(c):04x}" for c in plain)):
        base, extra = secrets.find_secrets(f"ab {t} cd")
        assert not base and [(k, a) for k, a, _ in extra][0][0] == "layer_assign" and extra[0][1] >= 3 and extra[0][2] <= 3 + len(t)
    assert secrets.find_secrets("%2525%25 %41%41") == ([], [])
    assert secrets.scan("paSSword: 'hunter2hunter' AKIAABCDEFGHIJKL " + "0a" * 16) == [("assign", 0, 24), ("access", 26, 42), ("hex", 43, 75)]
    assert secrets.scan_secrets(odd).count() == len(ODD)


def test_secrets_wrapped_base64():
    rng = random.Random(8)
    noise = "".join(rng.choice("ghjkmnpq ") for _ in range(400))
    wrap = lambda raw, n, end: end.join(c[k : k + n] for c in [base64.b64encode(raw).decode()] for k in range(0, len(c), n))
    for size in range(0, 60, 7):
        for n, end in ((64, "\n"), (76, "\r\n"), (61, "\n  "), (16, "\n")):
            for raw in (f"{noise[:size]} token=abcdefgh1234 {noise}".encode(), gzip.compress(f"{noise}{size} token=abcdefgh1234".encode())):
                for before, after in (("-----BEGIN X KEY-----\n", "\n-----END X KEY-----"), ("see\n", "\nThen more"), ("data: ", "")):
                    body = wrap(raw, n, end)
                    got = secrets.find_secrets(before + body + after)[1]
                    plain = raw[:2] != b"\x1f\x8b"
                    a, z = len(before), len(before) + len(body)
                    assert any(k == "layer_assign" and a <= s < e <= z and (plain or s == a) for k, s, e in got)
                    if plain:  # the whole secret, over the break
                        t = before + body + after
                        assert any(b"token=abcdefgh1234" in base64.b64decode(re.sub(r"\s", "", t[a:e]) + "==", validate=False) and k == "layer_assign" for k, s, e in got)


@pytest.mark.parametrize("kind", ["gzip", "bz2", "lzma", "twice"])
def test_secrets_large_layers(kind, monkeypatch):
    import bz2
    import lzma

    for name, value in (("MAX_LAYER", 200_000), ("BLOCK", 50_000), ("OVERLAP", 10_000)):
        monkeypatch.setattr(secrets, name, value)
    pack = {"gzip": gzip.compress, "bz2": bz2.compress, "lzma": lzma.compress, "twice": lambda x: gzip.compress(gzip.compress(x, 0))}[kind]
    for at in (0, 49_995, 299_990, 600_000):
        text = "é b " * (at // 4) + " token=abcdefgh1234 " + "c d " * ((700_000 - at) // 4)
        got = base64.b64encode(pack(text.encode())).decode()
        assert secrets.find_secrets(f"ab {got} cd") == ([], [("layer_assign", 3, 3 + len(got.rstrip("=")) + got.count("="))])


def test_sentence_runs(spark):
    a = "First one here is a sentence of some words. Then comes a second one with many more words in it. A third closes it all."
    rows = [(1, "Intro. " + a), (2, "Other text. " + a + " Tail."), (3, "Clean words only."), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: list(zip(r.starts, r.ends, strict=True)) for r in sentence_runs.repeated_spans(df, min_words=10).collect()}
    assert got == {2: [(12, 12 + len(a))]}
    assert {r.doc_id: r.text for r in sentence_runs.remove_repeats(df, min_words=10).collect()}[2] == "Other text.  Tail."


def test_sentence_runs_cover_whole_passages(spark):
    """Whatever the lengths of its sentences, a copied passage goes as a whole."""
    rng, count = random.Random(7), iter(range(10**6))
    sentence = lambda n: " ".join(f"w{next(count)}" for _ in range(n)) + "."
    rows, want = [], {}
    for k, sizes in enumerate([(40, 10, 5), (5, 10, 40), (60, 5), (5, 60), (55,), (12, 5, 12), *([rng.choice((2, 5, 11, 24, 30, 50, 64)) for _ in range(8)] for _ in range(30))]):
        passage = " ".join(map(sentence, sizes))
        rows.append((2 * k, f"{sentence(9)} {passage} {sentence(9)}"))
        head, tail = sentence(7), sentence(8)
        rows.append((2 * k + 1, f"{head} {passage} {tail}"))
        want[2 * k + 1] = f"{head} {tail}".split()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in sentence_runs.remove_repeats(df).collect()}
    assert all(got[k] == t for k, t in rows if k not in want) and {k: got[k].split() for k in want} == want


def test_nearest(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(400, 8)).astype(np.float32)
    rows = [(k, m[k].tolist()) for k in range(400)] + [(401, None), (402, [0.0] * 8), (403, [float("nan")] + [1.0] * 7), (404, [None] + [1.0] * 7), (405, m[0].tolist()), (500, m[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in sorted(nearest.nearest(df, F.col("vec_id") % 100 == 0).collect()):
        got[r.query_id].append((r.vec_id, r.score))
    live = [(i, np.array(v, float)) for i, v in rows if i < 401 or i in (405, 500)]
    for q, v in live:
        if q % 100 == 0:
            want = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in live if i != q)[:10]
            assert [i for i, _ in got[q]] == [i for _, i in want] and np.allclose([s for _, s in got[q]], [s for s, _ in want])


def test_decontaminate(spark, odd):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randrange(12, 40)))) for k in range(20)]
    rows = []
    for k in range(200):
        w = [word() for _ in range(150)]
        if k % 10 == 0:
            t = items[k // 10][1].upper().split()
            t[5] = "other"
            w[60:60] = t
        rows.append((k, " ".join(w)))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, k // 10) for k in range(0, 200, 10)}
    assert decontaminate.leaks(odd, spark.createDataFrame([(1, None), (2, "a b")], "item_id long, text string")).count() == 0


def test_nearest_repeated_rows(spark):
    """One near vec_id many times over, and every row repeated side by side."""
    rng = np.random.default_rng(2)
    m = rng.normal(size=(60, 8))
    near = [(1000, (m[0] + 0.01 * rng.normal(size=8)).tolist()) for _ in range(30)]
    rows = near + [(k, (m[k] + 0.001 * c).tolist()) for k in range(60) for c in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = collections.defaultdict(list)
    for r in sorted(nearest.nearest(df, F.col("vec_id") % 20 == 0).collect()):
        got[r.query_id].append((r.vec_id, r.score))
    for q in (0, 20, 40, 1000):
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = min([best.get(i, np.inf), *(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())) for j, w in rows if j == q)])
        want = sorted((s, i) for i, s in best.items())[:10]
        assert [i for i, _ in got[q]] == [i for _, i in want] and np.allclose([s for _, s in got[q]], [s for s, _ in want])


@pytest.mark.parametrize(("rows", "every"), [(300, 3), (300, 1), (300, 8), (300, 20), (12, 6)])
def test_decontaminate_frequent_items(spark, rows, every):
    """One item in a large part of all rows, or in two rows of a small table, beside rare words of
    other items."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(20)]
    others = " ".join(t for _, t in items[1:]).split()
    texts = []
    for k in range(rows):
        w = [word() if rng.random() < 0.8 else rng.choice(others) for _ in range(rng.randrange(20, 200))]
        if k % every == 0:
            at = rng.randrange(len(w))
            w[at:at] = items[0][1].split()
        texts.append((k, " ".join(w)))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, 0): 1.0 for k in range(0, rows, every)}


def test_licences(spark):
    mit = licences.NOTICES[0][2]
    rows = [(k, f"plain words number {k}") for k in range(40)] + [(100, "x y. " + mit), (101, "CC-BY and All rights reserved."), (102, None)]
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].labels == "mit" and got[100].score > 0.5 and got[0].labels == "" and got[102].n_words == 0
    assert (got[101].base_labels, got[101].n_base, got[101].first_word, got[101].last_word) == ("cc-by,reserved", 2, 0, 3)


def test_licences_all_notices(spark):
    """All notices in one file, a notice among rare words of others, in every row, and alone."""
    every, gpl = ",".join(sorted({x[0] for x in licences.NOTICES} | {"reserved"})), licences.NOTICES[3][2]
    whole = " end. ".join(x[2] for x in licences.NOTICES) + " All rights reserved."
    rare = " ".join(sorted({w for x in licences.NOTICES if x[0] not in ("gpl", "cc0") for w in x[2].split()}, reverse=True))
    rows = [(1, whole), (2, f"{rare} {'z ' * 50} {licences.NOTICES[8][2]}")] + [(k, f"plain words number {k}") for k in range(10, 60)]
    labels = lambda rows: {r.doc_id: (r.labels, round(r.score, 6)) for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    got = labels(rows)
    assert got[1] == (every, 1.0) and got[2] == ("cc0", 1.0) and got[10] == ("", 0.0)
    assert set(labels([(k, f"x {k}. {gpl}") for k in range(20)]).values()) == {("gpl", 1.0)}
    assert labels([(1, gpl)]) == {1: ("gpl", 1.0)}


def test_odd_rows_do_not_crash(spark, odd):
    assert ngram_join.ngram_components(odd).count() == len(ODD)
    assert fuzzy_lines.dedup_lines(odd).count() == len(ODD)
    sentence_runs.remove_repeats(odd).collect()
    assert licences.scan_licences(odd).count() == len(ODD)
    empty = odd.limit(0)
    for f in (ngram_join.ngram_components, fuzzy_lines.line_groups, sentence_runs.repeated_spans, secrets.scan_secrets, private_data.scan_private, licences.scan_licences):
        assert f(empty).count() == 0


def test_near_duplicates_without_id(spark):
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{n}" for n in range(40))
    rows = [(1, text(1), "a"), (2, text(1) + " more", "b"), (3, text(3), "c"), (None, text(3) + " more", "d"), (None, text(5), "e"), (None, text(6), "f"), (None, text(6) + " more", "g"), (None, None, "h"), (None, "", "i"), (7, None, "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns and sorted(r.source for r in got.collect()) == ["a", "c", "e", "f", "h", "i", "j"]


def test_pipeline_contract():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "benchmark_decontamination", "pieces"]


def test_frequent_runs_meet_under_the_lowest(spark):
    """All pairs of close lines that share a run are in a group that compares them, however frequent the run."""
    rng = np.random.default_rng(5)
    n, runs = 240, fuzzy_lines.RUNS + fuzzy_lines.EDGE_RUNS
    sim = rng.integers(-(2**63), 2**63, n)
    sim[1::2] = sim[::2] ^ (1 << 3 | 1 << 20 | 1 << 37 | 1 << 54)  # a bit of each block, so that no two blocks are equal
    own = rng.integers(1, 2**62, (n, runs))  # runs of one line each
    own[:, 0] = 7  # one that all have
    own[rng.random(n) < 0.4, 1] = 5  # others that some have, below and above
    own[rng.random(n) < 0.3, 2] = 9
    lines = spark.createDataFrame([(k, int(sim[k]), 120, *map(int, own[k])) for k in range(n)], "key long, sim long, length int, " + ", ".join(f"r{k} long" for k in range(runs)))
    for wide in (4096, 100, 20):
        groups, compared = collections.defaultdict(dict), collections.Counter()
        for r in fuzzy_lines.row_groups(lines.repartition(5), 80, 100, most=16, wide=wide).collect():
            groups[r.root][r.node] = set(np.frombuffer(r.lower, np.int64).tolist()) - {0} if r.lower else set()
        for g in groups.values():
            compared.update((k, k + 1) for k in g if k % 2 == 0 and k + 1 in g and not g[k] & g[k + 1])
        assert all(compared[k, k + 1] == 1 for k in range(0, n, 2)), (wide, len(compared))


def test_pipeline_lines_of_a_shared_passage(spark):
    """Lines that share three fifths with all others and the rest, but for a letter of each word, with one."""
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    passage, rows = " ".join(word() for _ in range(12)), []
    for _ in range(60):
        rest = [word() for _ in range(8)]
        rows += [f"{passage} {' '.join(rest)}", f"{passage} {' '.join(w[:4] + 'z' + w[5:] for w in rest)}"]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    gone = {r.doc_id for r in corpus_pipeline.line_dedup(spark, docs, "").collect() if not r.text}
    assert gone <= set(range(1, 120, 2)) and len(gone) >= 40, len(gone)  # whether a pair is close by SimHash is a matter of chance


def test_frequent_runs_of_one_batch_and_of_buckets(spark):
    """Lines that a batch sends as surplus of a frequent run meet those that go through the bucket of its key."""
    rng = np.random.default_rng(6)
    n, runs = 200, fuzzy_lines.RUNS + fuzzy_lines.EDGE_RUNS
    sim = rng.integers(-(2**63), 2**63, n)
    sim[100:] = sim[:100] ^ (1 << 3 | 1 << 20 | 1 << 37 | 1 << 54)
    own = rng.integers(1, 2**62, (n, runs))
    own[:, 0] = -(2**61) + 12345  # a key that needs all of its 64 bits
    lines = spark.createDataFrame([(k, int(sim[k]), 120, *map(int, own[k])) for k in range(n)], "key long, sim long, length int, " + ", ".join(f"r{k} long" for k in range(runs)))
    groups = collections.defaultdict(set)
    for r in fuzzy_lines.row_groups(lines.coalesce(1), 80, 100, most=16).collect():
        groups[r.root].add(r.node)
    lost = [k for k in range(100) if not any({k, k + 100} <= g for g in groups.values())]
    assert not lost, lost


def test_edit_distance_of_long_lines():
    """The cut columns give the same answer as the whole matrix, at the limit and on both sides of it."""
    rng = random.Random(8)
    for _ in range(150):
        a = [rng.choice("abcdé ") for _ in range(rng.randrange(1, 200))]
        b = list(a)
        for _ in range(rng.randrange(0, 1 + len(a) // 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(0, 3)] = [rng.choice("abcdé ") for _ in range(rng.randrange(0, 3))]
        a, b = sorted(("".join(a), "".join(b)), key=len, reverse=True)
        d = edit_distance(a, b)
        for limit in (d - 1, d, d + 5):
            assert not b or limit < len(a) - len(b) or fuzzy_lines.within(a, b, limit) == (d <= limit)


def test_simhash_bits_and_refusal_by_letters(monkeypatch):
    """The hash agrees with sums bit by bit, ties and heavy lines included; lines of other letters need no columns."""
    rng = np.random.default_rng(12)
    counts = np.array([1, 2, 3, 4, 7, 40, 9000])
    starts, n = np.cumsum(counts) - counts, int(counts.sum())
    words, sizes, keys = rng.integers(0, 2**64, n, np.uint64), rng.integers(1, 25, n), rng.integers(-(2**63), 2**63, len(counts))
    got = fuzzy_lines.simhash(words, sizes, starts, counts, keys)
    for r, (s, c) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
        tie = int(common.mix(keys[r : r + 1].view(np.uint64))[0]) if c < 4 else int(words[s : s + c].min())
        weights = np.rint(2 * np.sqrt(sizes[s : s + c])).astype(int)
        for k in range(64):
            ones = 2 * int(weights[(words[s : s + c] >> np.uint64(k)) & np.uint64(1) == 1].sum())
            assert int(got[r]) >> k & 1 == (tie >> k & 1 if ones == weights.sum() else ones > weights.sum())
    monkeypatch.setattr(fuzzy_lines, "places", lambda *_: pytest.fail("the letters alone tell that these are too far apart"))
    assert not fuzzy_lines.within("abcdefghijklmnop", "abcdqrstuvwxyz", 11)
