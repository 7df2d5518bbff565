"""Secret scans with a recursive decoding worklist.

The whole text is layer 0. Every layer is scanned for secrets and for encoded regions: runs with
URL escapes, runs with Unicode escapes or character references, base64 (also URL-safe, and wrapped
to lines of one width, which are joined), and what base64 holds when it is compressed (gzip, zlib, bzip2, xz, zstandard). A decoded region is a new
layer on the worklist; a layer whose content was seen in this text is not entered again, so the
work ends at a fixpoint even where a layer decodes to itself. Each character of a layer knows the
characters of the text that it came from, so that a secret found in any layer has a span there.

Base kinds are assign, access and hex in the text itself; the same kinds found in decoded layers
are layer_assign, layer_access and layer_hex. A compressed layer is read whole up to ``MAX_LAYER``
bytes, so that a small text can't fill the memory; one that is larger is streamed, as layers of
``BLOCK`` bytes that overlap by ``OVERLAP``: an encoded region in it is whole in one of them up to
that length.

Null and empty texts have no secrets. Repeated rows give equal results; other columns are not read.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import html
import io
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column_types, ship, strings
from .spans import digest, joined

BASE = ("assign", "access", "hex")
KINDS = (*BASE, *(f"layer_{k}" for k in BASE))
MAX_LAYER = 64 << 20
BLOCK, OVERLAP = 4 << 20, 1 << 20

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Runs with escapes, from their first escape on; what stands before it in the run is found backwards.
ONE_PERCENT, PERCENTS = re.compile("%[0-9A-Fa-f]{2}"), re.compile(r"(?:%[0-9A-Fa-f]{2}[^\s%]*)+")
_REFERENCE = r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z]{2,31};)"
ONE_REFERENCE, REFERENCES = re.compile(_REFERENCE), re.compile(rf"(?:{_REFERENCE}[^\s\\&]*)+")
ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|&([A-Za-z]{2,31};)")
#: The shortest secret, an assignment of 14 characters, needs 19 characters of base64.
BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{19,}|[A-Za-z0-9_-]{19,})={0,2}")
#: Ends of lines and whole lines of base64, one below the other.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
#: In base64, no secret of the three kinds is lower-case letters alone.
HINTS = re.compile(r"[0-9A-Z+/_=-]")


def scan(text: str) -> list[tuple[str, int, int]]:
    """Secrets of one layer."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _bytes_layer(raw: bytes, first: np.ndarray, last: np.ndarray):
    """Text of UTF-8 bytes with the source places of each character, or None."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    b = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((b & 0xC0) != 0x80)
    return text, first[at], last[np.r_[at[1:], len(b)] - 1] if len(at) else last[:0]


def unpercent(text: str, first: np.ndarray, last: np.ndarray):
    """Layer of a run with %XX escapes; other characters stay."""
    raw, a, b, at = bytearray(), [], [], 0
    while at < len(text):
        n = 1
        if text[at] == "%" and re.match("[0-9A-Fa-f]{2}", text[at + 1 : at + 3]):
            n, got = 3, bytes([int(text[at + 1 : at + 3], 16)])
        else:
            got = (" " if text[at] == "+" else text[at]).encode("utf-8", "surrogatepass")
        raw += got
        a += [first[at]] * len(got)
        b += [last[at + n - 1]] * len(got)
        at += n
    return _bytes_layer(bytes(raw), np.array(a, np.int64), np.array(b, np.int64))


def unescape(text: str, first: np.ndarray, last: np.ndarray):
    """Layer of a run with Unicode escapes or character references; other characters stay."""
    out, a, b, at = [], [], [], 0
    for m in [*ONE_ESCAPE.finditer(text), None]:
        stop = m.start() if m else len(text)
        out.append(text[at:stop])
        a += first[at:stop].tolist()
        b += last[at:stop].tolist()
        if m:
            value = next((int(m[k], 10 if k == 5 else 16) for k in range(1, 7) if m[k]), None)
            got = html.unescape("&" + m[7]) if value is None else chr(value) if value <= 0x10FFFF and not 0xD800 <= value < 0xE000 else m[0]
            out.append(got)
            a += [first[m.start()]] * len(got)
            b += [last[m.end() - 1]] * len(got)
            at = m.end()
    return "".join(out), np.array(a, np.int64), np.array(b, np.int64)


class TooLarge(Exception):
    """Compressed bytes hold more than MAX_LAYER."""


def _inflate(raw: bytes) -> bytes | None:
    """What compressed bytes hold, None if they are none."""
    try:
        if raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0):
            z = zlib.decompressobj(47)
            out = z.decompress(raw, MAX_LAYER)
            if z.unconsumed_tail or (len(out) == MAX_LAYER and not z.eof):
                raise TooLarge
            return out
        if raw[:3] == b"BZh":
            z = bz2.BZ2Decompressor()
            out = z.decompress(raw, MAX_LAYER)
            if len(out) == MAX_LAYER and not z.eof:
                raise TooLarge
            return out if z.eof else None
        if raw[:6] == b"\xfd7zXZ\x00":
            z = lzma.LZMADecompressor()
            out = z.decompress(raw, MAX_LAYER)
            if len(out) == MAX_LAYER and not z.eof:
                raise TooLarge
            return out if z.eof else None
        if raw[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)) as r:
                out = r.read(MAX_LAYER)
                if r.read(1):
                    raise TooLarge
                return out
    except TooLarge:
        raise
    except Exception as e:  # noqa: BLE001  each library has errors of its own for damaged data
        if isinstance(e, MemoryError | ImportError):
            raise
    return None


def _pieces(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What a stream holds that may be compressed, several times over, in pieces of bounded size;
    it ends where the data is damaged."""
    head = b""
    while len(head) < 6 and (more := next(chunks, b"")):
        head += more

    def inflated(raw: bytes) -> Iterator[bytes]:
        if raw[:3] == b"BZh" or raw[:6] == b"\xfd7zXZ\x00":
            z = bz2.BZ2Decompressor() if raw[:1] == b"B" else lzma.LZMADecompressor()
            while raw and not z.eof:
                yield z.decompress(raw, BLOCK)
                while not z.eof and not z.needs_input:
                    yield z.decompress(b"", BLOCK)
                raw = next(chunks, b"")
        elif raw[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            z = zstandard.ZstdDecompressor().decompressobj()
            while raw and not z.eof:
                for k in range(0, len(raw), 1024):  # bounds what one step inflates to
                    if not z.eof:
                        yield z.decompress(raw[k : k + 1024])
                raw = next(chunks, b"")
        else:
            z = zlib.decompressobj(47)
            while raw and not z.eof:
                yield z.decompress(raw, BLOCK)
                raw = z.unconsumed_tail or (b"" if z.eof else next(chunks, b""))

    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0) or head[:3] == b"BZh" or head[:6] == b"\xfd7zXZ\x00" or head[:4] == b"\x28\xb5\x2f\xfd":
        source = inflated(head)
        safe = _until_damaged(source)
        yield from _pieces(safe)
    else:
        yield head
        yield from chunks


def _until_damaged(source: Iterator[bytes]) -> Iterator[bytes]:
    try:
        yield from (x for x in source if x)
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError) as e:
        del e
    except Exception as e:  # noqa: BLE001  zstandard has an error of its own
        if isinstance(e, MemoryError | ImportError):
            raise


def streamed(raw: bytes, first: int, last: int):
    """Layers of compressed bytes too large for one: overlapping blocks of text."""
    decoder, text = codecs.getincrementaldecoder("utf-8")(), ""
    layer = lambda t: (t, np.broadcast_to(np.int64(first), len(t)), np.broadcast_to(np.int64(last), len(t)))
    try:
        for piece in _pieces(iter([raw])):
            new = decoder.decode(piece)
            if sum(c < " " and c not in "\t\n\r" for c in new):
                return
            text += new
            if len(text) >= BLOCK + OVERLAP:
                yield layer(text)
                text = text[-OVERLAP:]
    except UnicodeDecodeError:
        return
    yield layer(text)


def unwrapped(text: str, first: np.ndarray, last: np.ndarray):
    """Layer of base64 that is wrapped to lines."""
    keep = np.array([k for k, c in enumerate(text) if not c.isspace()])
    return unbase64("".join(text.split()), first[keep], last[keep])


def unbase64(text: str, first: np.ndarray, last: np.ndarray):
    """Layer of a base64 run: text, or what compressed bytes inflate to, whose characters then all
    come from the whole run; an iterator of layers where that is too large for one."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        raw = binascii.a2b_base64(body + "=" * (-len(body) % 4))
    except binascii.Error:
        return None
    opened = set()
    while True:
        try:
            inner = _inflate(raw)
        except TooLarge:
            return streamed(raw, int(first[0]), int(last[len(text) - 1]))
        if inner is None:
            break
        opened.add(hashlib.sha256(raw).digest())
        if not inner or hashlib.sha256(inner).digest() in opened:
            return None
        raw = inner
    k = np.arange(len(raw))
    if opened:
        a, b = np.full(len(raw), first[0]), np.full(len(raw), last[len(text) - 1])
    else:
        a, b = first[k * 8 // 6], last[(k * 8 + 7) // 6]
    layer = _bytes_layer(raw, a, b)
    if layer is None or sum(c < " " and c not in "\t\n\r" for c in layer[0]):
        return None
    return layer


def encoded(text: str):
    """Encoded regions of a layer: start, end, decoder."""
    if "%" in text:
        for a, b in escaped_runs(text, ONE_PERCENT, PERCENTS, "%"):
            yield a, b, unpercent
    if "\\" in text or "&" in text:
        for a, b in escaped_runs(text, ONE_REFERENCE, REFERENCES, "\\&"):
            yield a, b, unescape
    for m in BASE64.finditer(text):
        if HINTS.search(m[0]):
            yield m.start(), m.end(), unbase64
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            for a, b in wrapped_runs(m[0], m.start() == 0 or text[m.start() - 1] == "\n"):
                if HINTS.search(m[0], a, b):
                    yield m.start() + a, m.start() + b, unwrapped


def escaped_runs(text: str, one: re.Pattern, run: re.Pattern, openers: str) -> Iterator[tuple[int, int]]:
    """Runs without white space that hold escapes, each from what stands before its first escape to
    where an opener follows that opens none; every character is read a fixed number of times."""
    after = 0
    while m := one.search(text, after):
        start = m.start()
        while start > after and text[start - 1] not in openers and not text[start - 1].isspace():
            start -= 1
        after = run.match(text, m.start()).end()
        yield start, after


def wrapped_runs(text: str, whole: bool) -> Iterator[tuple[int, int]]:
    """Runs of lines of one width in lines of base64, with a shorter line at the end and without,
    and with the end of a line before them and without unless the first line is ``whole``."""
    lines = [(m.start(), m.end(), m.end() - m.start() - m[0].count("=")) for m in re.finditer(r"\S+", text)]
    k = 0
    while k < len(lines):
        e = k + 1
        while e < len(lines) and lines[e][2] == lines[k][2]:
            e += 1
        starts = [k, *([0] if k == 1 and not whole and lines[0][2] < lines[1][2] else [])]
        ends = [e, *([e + 1] if e < len(lines) and lines[e][2] < lines[k][2] else [])]
        for a in starts:
            for z in ends:
                if z - a > 1 and lines[z - 1][1] - lines[a][0] >= 19:
                    yield lines[a][0], lines[z - 1][1]
        k = e


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans of the text, and the method's spans from its decoded layers."""
    base, extra = scan(text), []
    seen = set()
    work = []

    def push(layer_text, first, last):
        for a, b, decode in encoded(layer_text):
            sub = (np.arange(a, b), np.arange(a + 1, b + 1)) if first is None else (first[a:b], last[a:b])
            got = decode(layer_text[a:b], *sub)
            if isinstance(got, Iterator):
                mark = hashlib.blake2b(layer_text[a:b].encode("utf-8", "surrogatepass") + sub[0][:1].tobytes() + sub[1][-1:].tobytes(), digest_size=16).digest()
                if mark not in seen:
                    seen.add(mark)
                    work.append(got)
                continue
            if got is None or not got[0] or got[0] == layer_text[a:b]:
                continue
            mark = hashlib.blake2b(got[0].encode("utf-8", "surrogatepass") + sub[0][:1].tobytes() + sub[1][-1:].tobytes(), digest_size=16).digest()
            if mark not in seen:
                seen.add(mark)
                work.append(got)

    push(text, None, None)
    while work:
        layer = work.pop()
        if isinstance(layer, Iterator):
            if (block := next(layer, None)) is None:
                continue
            work.append(layer)
            layer = block
        layer_text, first, last = layer
        extra += [(f"layer_{k}", int(first[a]), int(last[b - 1])) for k, a, b in scan(layer_text)]
        push(layer_text, first, last)
    own = set(base)
    return base, sorted({x for x in extra if (x[0][6:], *x[1:]) not in own})


def scan_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of each whole text."""
    ship(docs.sparkSession)
    src = docs.select(*keep, docs[text].cast("string").alias("__text"))
    schema = column_types(src, -1)

    def run(batches):
        for b in batches:
            rows = []
            for t in strings(b.column(b.num_columns - 1)):
                base, extra = find_secrets(t)
                own = joined(base, KINDS)
                rows.append((*(sum(k == x[0] for x in base) for k in BASE), digest(own), joined(base + extra, KINDS) if extra else own))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (*[pa.int64()] * 3, pa.string(), pa.string())
            names = (*(f"n_{k}" for k in BASE), "base_sha256", "spans")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*b.schema.names[:-1], *names])

    return src.mapInArrow(run, f"{schema}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
