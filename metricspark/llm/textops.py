"""Vectorised word hashing over whole texts.

A word is a maximal run of bytes other than ASCII white space
(``[\\x20\\x09-\\x0D]``), which is what ``bytes.split()`` yields.  Words of many
texts are hashed at once: a prefix sum of ``(byte + 1) * P**i`` modulo 2**64
gives every word's polynomial hash from two look-ups, and a finaliser spreads
the bits.  Work arrays hold one piece of a quarter megabyte whatever the length
of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PIECE
    while size < n:
        size *= 2
    if size not in _powers:
        inverse = pow(_BASE, -1, 1 << 64)
        pair = []
        for b in (_BASE, inverse):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        if size > PIECE:
            return pair[0], pair[1]  # a giant word: not kept
        _powers[size] = (pair[0], pair[1])
    return _powers[size]


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    word = np.zeros(len(buf) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[buf]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``starts:ends`` (ascending, not overlapping) of a byte array of any length."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        base = int(starts[done])
        upto = max(done + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        piece = buf[base : ends[upto - 1]].astype(np.uint64) + np.uint64(1)
        power, inverse = _power_tables(len(piece))
        total = np.empty(len(piece) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(piece * power[: len(piece)], out=total[1:])
        a, b = starts[done:upto] - base, ends[done:upto] - base
        out[done:upto] = mix64((total[b] - total[a]) * inverse[a])
        done = upto
    return out


def _hash_piece(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(buf)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    power, inverse = _power_tables(len(buf))
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts]), starts


def hash_words(data: bytes) -> np.ndarray:
    """Hashes of the words of one byte string, in order."""
    if len(data) <= PIECE:
        return _hash_piece(np.frombuffer(data, dtype=np.uint8))[0]
    parts, at = [], 0
    buf = np.frombuffer(data, dtype=np.uint8)
    while at < len(buf):
        end = min(at + PIECE, len(buf))
        while end < len(buf) and not _SPACE[buf[end]]:  # never cut inside a word
            ahead = np.flatnonzero(_SPACE[buf[end : end + PIECE]])
            end = end + int(ahead[0]) if len(ahead) else min(end + PIECE, len(buf))
        parts.append(_hash_piece(buf[at:end])[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def words_by_text(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """Word hashes of each text, small texts hashed together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < PIECE):
            size += len(texts[end]) + 1
            end += 1
        if end - at == 1:
            yield hash_words(texts[at])
        else:
            group = texts[at:end]
            hashes, starts = _hash_piece(np.frombuffer(b"\n".join(group), dtype=np.uint8))
            edges = np.cumsum([len(t) + 1 for t in group[:-1]])
            yield from np.split(hashes, np.searchsorted(starts, edges))
        at = end


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of ``n`` consecutive words (none if there are fewer)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : len(words) - n + 1 + k]
    return mix64(out)


def to_bytes(value: str | None) -> bytes:
    """UTF-8 bytes of a text; none for null."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Record batches in slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
