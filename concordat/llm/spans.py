"""Digest of spans, shared by the scans for private data and secrets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable


def joined(spans: Iterable[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = {k: n for n, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda x: (x[1], order[x[0]], x[2])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
