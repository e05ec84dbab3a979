"""Vectorised word hashing over Arrow string columns.

A word is a maximal run of characters other than space and 0x09-0x0D; A-Z are
folded to lower case.  Work goes through slices of bounded size, cut at white
space or at a text's end, so one very long text needs no more memory than many
short ones (besides 16 bytes a word).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cohortlens.llm.storage import release_idle, return_unused

SLICE_BYTES = 1 << 20
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE_CODE[65:91] = _BYTE_CODE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base), _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    up = _powers(_BASE, 1)
    down = _powers(_BASE_INV, 1)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, SLICE_BYTES + 1)
            cls.up, cls.down = _powers(_BASE, n), _powers(_BASE_INV, n)


def utf8_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _slices(data: np.ndarray, offsets: np.ndarray):
    """Slice bounds of about SLICE_BYTES, each at white space or a text's end."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + SLICE_BYTES)
        if end < n:
            cut = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            space = np.flatnonzero(_SPACE[data[max(at, end - 4096):end]])
            if len(space):
                cut = max(cut, max(at, end - 4096) + int(space[-1]) + 1)
            if cut <= at:  # one huge word: go on to where it ends
                cut = int(offsets[np.searchsorted(offsets, end, "left")])
                for lo in range(end, cut, 1 << 16):
                    space = np.flatnonzero(_SPACE[data[lo:min(cut, lo + (1 << 16))]])
                    if len(space):
                        cut = lo + int(space[0]) + 1
                        break
            end = cut
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, word offsets by text) of a batch of texts."""
    hashes, starts_all = [], []
    for lo, hi in _slices(data, offsets):
        part = data[lo:hi]
        n = len(part)
        _Tables.need(n + 1)
        solid = ~_SPACE[part]
        bounds = offsets[np.searchsorted(offsets, lo, "left"):np.searchsorted(offsets, hi, "right")] - lo
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = bounds[(bounds > 0) & (bounds < n)]
        first[inner] = solid[inner]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        last[inner - 1] = solid[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        run = np.zeros(n + 1, _U)
        np.cumsum(_BYTE_CODE[part] * _Tables.up[:n], out=run[1:])
        hashes.append(mix64((run[ends] - run[starts]) * _Tables.down[starts] + (ends - starts).astype(_U)))
        starts_all.append(starts + lo)
    if not hashes:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts_all)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of k words, offsets by text); a text with 1 to k-1 words gives its whole sequence as one."""
    n = np.diff(at)
    mult = mix64(np.arange(1, k + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    out = np.zeros(out_at[-1], _U)
    if len(words) >= k:
        rolled = words[:len(words) - k + 1] * mult[0]
        for j in range(1, k):
            rolled = rolled + words[j:len(words) - k + 1 + j] * mult[j]
        rolled = mix64(rolled)
        long = np.flatnonzero(n >= k)
        if len(long):
            src = np.repeat(at[:-1][long] - out_at[:-1][long], count[long]) + np.arange(out_at[-1])[np.repeat(n >= k, count)]
            out[np.repeat(n >= k, count)] = rolled[src]
    for i in np.flatnonzero((n > 0) & (n < k)):
        m = int(n[i])
        out[out_at[i]] = mix64((words[at[i]:at[i] + m] * mult[:m]).sum(keepdims=True, dtype=_U) ^ _U(0xA5A5A5A5 + m))[0]
    return out, out_at


def distinct_by_text(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text."""
    parts = [np.unique(values[at[i]:at[i + 1]]) for i in range(len(at) - 1)]
    size = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, _U)), np.concatenate([[0], np.cumsum(size)])


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of equal bits, Spark's long."""
    return x.view(np.int64)


def row_blocks(batch: pa.RecordBatch, text: str, limit: int = 2 << 20):
    """Cut a batch by rows so that each piece holds about ``limit`` bytes of text (at least one row)."""
    release_idle()
    col = batch.column(batch.schema.get_field_index(text))
    _, off = utf8_buffers(col)
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)
    return_unused()  # what the pieces took; the worker may idle from here on
