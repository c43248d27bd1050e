"""Document fingerprints by context-triggered piecewise hashing (operator 3).

A rolling hash over the last ``ROLL`` bytes of the text (UTF-8) ends a chunk
wherever it is ``block - 1`` modulo the block size; each chunk gives one
character of the signature.  Block sizes are ``LEAST`` times a power of two;
a text gets the size at which about ``CHARS`` chunks are expected, or a
smaller one if that gives fewer than half and the smaller one enough, or a
larger one if a signature would have more than ``2 * CHARS`` boundaries.  Signatures span the
whole text; a text that repeats a short period has boundaries at nearly all
periods or at none, so its signature may be a single character.  A fingerprint holds the signatures
at that size and at twice the size: ``size:signature:signature``.

Two fingerprints are compared at a block size that both have: likeness is 1 -
edit distance (insert and delete) over the signatures' joint length, the best
of the shared sizes; 0 without a shared size, or without ``COMMON`` equal
characters in a row (chance alone aligns some; a quarter of the shorter
signature, if that is less).  Runs of more than three equal
characters are cut to three for it.  Equal fingerprints have likeness 1.

Defined results: a null text is an empty one (its fingerprint is
``LEAST::``; it is alike to an empty text only); documents are in descending
order of number (nulls last), then of a hash of the text; after the last
comes the first; a lone document's next is itself; repeated rows are
neighbours; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import neighbours, parts

ROLL, LEAST, CHARS, COMMON = 7, 3, 64, 4
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def fingerprint(text: str | None) -> str:
    """``size:signature:signature`` of one text."""
    import zlib
    import numpy as np
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return f"{LEAST}::"
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h = np.zeros(n, np.uint32)
    power = 1
    for k in range(min(ROLL, n)):  # the hash of the bytes up to here, each by its distance
        h[k:] += (b[:n - k] + np.uint32(1)) * np.uint32(power)
        power = power * 0x01000193 % (1 << 32)
    h ^= h >> np.uint32(15)
    size = LEAST
    while size * CHARS < n:
        size *= 2

    def ends(block: int):
        return np.flatnonzero(h % np.uint32(min(block, 0xFFFFFFFF)) == block - 1)

    def signature(block: int) -> str:
        out, start = [], 0
        for e in ends(block).tolist():
            out.append(_ALPHABET[zlib.crc32(raw[start:e + 1]) >> 26])
            start = e + 1
        if start < n:
            out.append(_ALPHABET[zlib.crc32(raw[start:]) >> 26])
        return "".join(out)

    few = size
    while few > LEAST and len(ends(few)) < CHARS // 2:
        few //= 2
    if CHARS // 2 <= len(ends(few)) <= 2 * CHARS:
        size = few
    while max(len(ends(size)), len(ends(2 * size))) > 2 * CHARS:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def _squeeze(s: str) -> str:
    return "".join(c for i, c in enumerate(s) if i < 3 or not c == s[i - 1] == s[i - 2] == s[i - 3])


def _common(a: str, b: str) -> int:
    """Longest common subsequence, a column of bits at a time."""
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & place.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    a, b = _squeeze(a), _squeeze(b)
    k = min(COMMON, max(1, min(len(a), len(b)) // 4))
    if not a or not b or not ({a[i:i + k] for i in range(len(a) - k + 1)} & {b[i:i + k] for i in range(len(b) - k + 1)}):
        return 0.0
    distance = len(a) + len(b) - 2 * _common(a, b)
    return 1 - distance / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1 of two fingerprints."""
    if x == y:
        return 1.0
    (s, a1, a2), (t, b1, b2) = x.split(":"), y.split(":")
    s, t = int(s), int(t)
    if s == t:
        return max(_alike(a1, b1), _alike(a2, b2))
    if s == 2 * t:
        return _alike(a1, b2)
    if t == 2 * s:
        return _alike(a2, b1)
    return 0.0


def fingerprints_with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likenesses; in one pass by order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    deal = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]

    def rows(cells: list[tuple], first: int, last: int) -> Iterator[tuple]:
        import hashlib
        mine = fingerprint(cells[first][1])
        for i in range(first, last):
            text = cells[i][1] or ""
            after = cells[i + 1][1] or ""
            n = len(text)
            edited = text[:n - n // 2] + after[:n // 2]
            own, theirs = fingerprint(edited), fingerprint(after)
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            yield cells[i][0], n, sha, mine, own, likeness(mine, own), likeness(mine, theirs)
            mine = theirs

    return neighbours(docs.select("doc_id", "text"), deal, [*deal, F.col("text")], rows,
                      f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double",
                      partitions or parts(docs), wrap=True)


__all__ = ["fingerprint", "fingerprints_with_next", "likeness"]
