"""Vectorised words and shingles of a batch of texts (UTF-8 bytes, as Arrow holds them)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 17  # small enough for the arrays of a chunk to stay in cache
LONG_WORD = 256
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def byte_table(separators: bytes) -> np.ndarray:
    """Byte -> 0 for a separator, else the byte itself with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


#: words ``[^\x20\x09-\x0D]+``; byte 0 is a word byte there and takes the place of the space
SPACED = byte_table(b" \t\n\x0b\x0c\r")
SPACED[0] = 32
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = byte_table(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes; nulls are empty."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit word hashes in order, offsets of each text's words)."""
    hashes, _, _, _, at = word_spans(data, offsets, table)
    return hashes, at


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(word hashes, mapped bytes with eight zeros behind, start and length of each word, offsets of each text's words)."""
    size = len(data)
    mapped = np.zeros(size + 8, np.uint8)
    np.take(table, data, out=mapped[:size])
    inside = np.zeros(size + 1, np.int8)
    inside[:size] = mapped[:size] != 0
    edge = np.diff(inside, prepend=np.int8(0))
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    cuts = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts - 1] == 1)])  # words that run on into the next text
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    length = ends - starts
    hashes = mix64(length.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    loads = np.ndarray((size + 1,), "<u8", buffer=mapped, strides=(1,))
    at, left, rows = starts, length, None
    for _ in range(LONG_WORD // 8):
        part = loads[at] & _MASKS[np.minimum(left, 8)]
        if rows is None:
            hashes = mix64(hashes ^ part)
        else:
            hashes[rows] = mix64(hashes[rows] ^ part)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(mapped[starts[i]:ends[i]].tobytes())
    return hashes, mapped, starts, length, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    k = min(width, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out = mix64(out + words[j:n - k + 1 + j])
    return out


def shingle_runs(words: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """``shingle_hashes`` of each text of a chunk, computed over the chunk at once."""
    whole = shingle_hashes(words, width) if len(words) >= width else None
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield whole[a:b - width + 1] if b - a >= width else shingle_hashes(words[a:b], width)
