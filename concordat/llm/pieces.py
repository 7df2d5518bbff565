"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of many words lie in one flat numpy array. Each round takes the smallest pair rank of
every word (a segmented minimum), merges its leftmost occurrence in all words at once, together
with the further occurrences where no later merge can come between, recomputes the ranks beside
the merges and compacts the arrays. Words without a pair left leave the arrays.

Null and empty texts have no ids and decode to the empty text. Repeated rows give equal results;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column_types, ship, strings

SPACE_MARK = "▁"
NONE = np.int32(1 << 30)
CACHE_WORDS = 150_000  # of a task; Python workers outlive their tasks, so nothing more is kept


class PieceModel:
    """A BPE model with byte fallback, without normalisation rules, with a dummy prefix."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        sp = SentencePieceProcessor(model_file=path)
        proto.ParseFromString(sp.serialized_model_proto())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
            raise ValueError("only BPE models with byte fallback, the identity normaliser and a dummy prefix are supported")
        kinds = [p.type for p in proto.pieces]
        if set(kinds) - {1, 2, 3, 6}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.size = len(self.pieces)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in normal):
            raise ValueError("pieces that go on after a space are not supported")
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.bytes = frozenset(self.byte_ids.tolist())
        self.plain = [" ⁇ " if p.type == 2 else "" if p.type == 3 else p.piece.replace(SPACE_MARK, " ") for p in proto.pieces]
        self.number = [str(i) for i in range(self.size)]
        scores = np.array([p.score for p in proto.pieces])
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1].astype(np.int32), NONE)  # [-1]: no piece
        self.of_char = np.full(0x110000, -1, np.int32)
        keys, made, first, last = [], [], {}, {}
        for p, i in normal.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
            for k in range(1, len(p)):
                a, b = normal.get(p[:k]), normal.get(p[k:])
                for side, x in ((first, a), (last, b)):
                    if x is not None:
                        side[x] = min(side.get(x, NONE), self.rank[i])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    made.append(i)
        order = np.argsort(keys)
        self.keys, self.made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        #: Whether a piece, once made, takes part in no pair that ranks before or beside it.
        self.safe = np.zeros(self.size + 1, bool)
        for i in normal.values():
            self.safe[i] = min(first.get(i, NONE), last.get(i, NONE)) > self.rank[i]
        #: No piece holds these characters, so that words can end at them.
        self.hard = "\n" if not any("\n" in p for p in normal) else ""
        self.cut = re.compile(f"{self.hard}+|{SPACE_MARK}*[^{SPACE_MARK}{self.hard}]+|{SPACE_MARK}+" if self.hard else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.made[at], np.int32(-1))

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; a word is what ``cut`` gives, encoded apart from its neighbours."""
        if not words:
            return []
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        sym = self.of_char[chars]
        sym = np.where(sym < 0, -chars.astype(np.int32) - 1, sym)
        made = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            made[:-1] = np.where(word[1:] == word[:-1], self._pairs(sym[:-1], sym[1:]), -1)
        done_word, done_sym = [], []
        while len(sym):
            rank = self.rank[made]
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[start, len(sym)])
            least = np.minimum.reduceat(rank, start)
            if (over := least == NONE).any():
                out = np.repeat(over, sizes)
                done_word.append(word[out])
                done_sym.append(sym[out])
                stay = ~out
                sym, made, word, rank = sym[stay], made[stay], word[stay], rank[stay]
                if not len(sym):
                    break
                sizes, least = sizes[~over], least[~over]
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            opens = np.r_[True, word[hit[1:]] != word[hit[:-1]]]  # leftmost of its word
            chain = np.r_[False, hit[1:] == hit[:-1] + 1] & ~opens  # shares a symbol with the one before
            nth = np.arange(len(hit)) - np.maximum.accumulate(np.where(chain, 0, np.arange(len(hit))))
            hit = hit[opens | (self.safe[made[hit]] & (nth % 2 == 0))]
            sym[hit] = made[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = np.cumsum(keep)[hit] - 1
            sym, made, word = sym[keep], made[keep], word[keep]
            made[at] = -1
            for i in (at[at > 0] - 1, at[at < len(sym) - 1]):
                made[i] = np.where(word[i] == word[i + 1], self._pairs(sym[i], sym[i + 1]), -1)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        sym, ends = sym[order], np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        ids, out, at = sym.tolist(), [], 0
        lost = sym < 0
        some = np.zeros(len(words), bool)
        some[word[order][lost]] = True
        for w, end in enumerate(ends):
            x = ids[at:end]
            if some[w]:
                x = [i for s in x for i in ([s] if s >= 0 else self.byte_ids[list(chr(-s - 1).encode())].tolist())]
            out.append(x)
            at = end
        return out

    def split(self, text: str) -> list[str]:
        return self.cut.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []

    def encode(self, texts: Iterable[str]) -> list[list[int]]:
        """Ids of whole texts, as the sentencepiece library gives them without extra options."""
        cut = [self.split(t) for t in texts]
        known = list(dict.fromkeys(w for x in cut for w in x))
        ids = dict(zip(known, self.encode_words(known), strict=True))
        return [[i for w in x for i in ids[w]] for x in cut]

    def pieces_text(self, ids: list[int]) -> str:
        """Text of ids before the dummy prefix goes; bytes that are no UTF-8 read as U+FFFD each."""
        if not self.bytes.intersection(ids):
            return "".join([self.plain[i] for i in ids])
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.bytes:
                run.append(int(self.pieces[i][1:-1], 16))
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(self.plain[i] if i >= 0 else "")
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.pieces_text(ids)
        opens = next((self.pieces[i] for i in ids if i not in (1, 2)), "")
        return text[1:] if opens.startswith(SPACE_MARK) else text


def _utf8(raw: bytes) -> str:
    """UTF-8 text in which each byte outside a valid character reads as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


_models: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file, kept in this process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _entries(model: PieceModel, cache: dict, texts: list[str], raw: bool = False) -> list[list[str]]:
    """The words of texts, all of which ``cache`` then holds: ids as text, or raw as 32-bit numbers,
    how many they are, and their text."""
    cut = [model.split(t) for t in texts]
    new = list(dict.fromkeys(w for x in cut for w in x if w not in cache)) if cut else []
    if len(cache) + len(new) > CACHE_WORDS:
        cache.clear()
        new = list({w for x in cut for w in x})
    for w, ids in zip(new, model.encode_words(new), strict=True):
        cache[w] = (np.array(ids, np.int32).tobytes() if raw else ",".join([model.number[i] for i in ids]), len(ids), model.pieces_text(ids))
    return cut


def encode_decode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """Ids of each whole text and the text that they decode to, beside the columns of ``keep``.

    Adds ``n_tokens``, ``token_ids`` (array) and ``decoded``; with ``with_ids`` false, the SHA-256
    of the comma-joined ids and of the decoded UTF-8 text instead.
    """
    ship(docs.sparkSession)
    src = docs.select(*keep, docs[text].cast("string").alias("__text"))
    schema = column_types(src, -1)
    schema += ", n_tokens long, " + ("token_ids array<int>, decoded string" if with_ids else "ids_sha256 string, decoded_sha256 string")

    def run(batches):
        model, cache = load(path), {}
        for b in batches:
            texts = strings(b.column(b.num_columns - 1))
            at = 0
            while at < len(texts):  # about 2 million characters at once, whole texts
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= 2_000_000):
                    size += len(texts[end])
                    end += 1
                counts, first, second = [], [], []
                for x in _entries(model, cache, texts[at:end], with_ids):
                    found = [cache[w] for w in x]
                    ids, plain = (b"" if with_ids else ",").join([e[0] for e in found]), "".join([e[2] for e in found])[1:]
                    counts.append(sum([e[1] for e in found]))
                    first.append(ids if with_ids else hashlib.sha256(ids.encode()).hexdigest())
                    second.append(plain if with_ids else hashlib.sha256(plain.encode()).hexdigest())
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(first), np.int32))
                    column = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), flat)
                else:
                    column = pa.array(first, pa.string())
                cols = [b.column(i).slice(at, end - at) for i in range(b.num_columns - 1)]
                names = [*b.schema.names[:-1], "n_tokens", *(("token_ids", "decoded") if with_ids else ("ids_sha256", "decoded_sha256"))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), column, pa.array(second, pa.string())], names=names)
                at = end

    return src.mapInArrow(run, schema)
