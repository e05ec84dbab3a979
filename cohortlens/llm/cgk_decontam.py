"""Benchmark decontamination by CGK embedding and bit sampling (operator 9).

A document is contaminated by a benchmark item of n words if some stretch of
it is within floor(``tolerance`` n) word edits of the item.

* A text within k edits of an item keeps at least one of k + 1 disjoint pieces
  of the item word for word, so only windows around such pieces matter: this
  places the item-sized windows and loses nothing.
* The CGK random walk copies a word sequence into 3 n places, at each place
  going on to the next word or repeating it by a hash of place and word; edit
  distance becomes Hamming distance.  Each of ``walks`` walks gives ``tables``
  keys of ``bits`` sampled places; a window goes on with the items that share
  a key with it.
* Those are verified exactly: word edit distance of the item to the best
  stretch around the window.

The benchmark is taken in blocks of bounded size, each against all documents.
Items without words (or null) match nothing; null and empty texts hold
nothing; repeated items or documents are reported row by row; other columns
are ignored; an empty benchmark or table gives no match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit

TOLERANCE = 0.2
WALKS, TABLES, BITS = 16, 4, 2
BLOCK_WORDS = 500_000
_U = np.uint64
_PAD = _U(0x5851F42D4C957F2D)


def gram_hashes(words: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q words from each place on (the last q - 1 places are left out)."""
    if len(words) < q:
        return np.zeros(0, _U)
    mult = textkit.mix64(np.arange(1, q + 1, dtype=_U) * _U(0x9FB21C651E98DF25)) | _U(1)
    out = words[:len(words) - q + 1] * mult[0]
    for j in range(1, q):
        out = out + words[j:len(words) - q + 1 + j] * mult[j]
    return textkit.mix64(out)


def cgk_embed(rows: np.ndarray, n: np.ndarray, walk: int) -> np.ndarray:
    """The walk's 3 n places for word sequences of lengths ``n``, held in rows padded to one width."""
    m, width = rows.shape
    padded = np.concatenate([rows, np.full((m, 1), _PAD)], axis=1)
    out = np.empty((m, 3 * width), _U)
    at, every = np.zeros(m, np.int64), np.arange(m)
    for place in range(3 * width):
        word = padded[every, at]
        out[:, place] = word
        step = textkit.mix64(word + _U((walk * 1_000_003 + place * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & _U(1)
        at = np.minimum(at + step.astype(np.int64), n)
    return out


def cgk_keys(rows: np.ndarray, n: np.ndarray, walk: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """(rows x tables) keys: a hash of the length and of ``bits`` sampled places of the walk."""
    places = np.random.default_rng(walk).random((tables, bits))
    walked, every = cgk_embed(rows, n, walk), np.arange(len(rows))
    key = np.repeat(textkit.mix64(n.astype(_U) + _U((walk + 1) << 32))[:, None], tables, axis=1)
    for t in range(tables):
        for share in np.sort(places[t]):
            key[:, t] = textkit.mix64(key[:, t] * _U(3) + walked[every, np.floor(share * 3 * n).astype(np.int64)])
    return key


def edits_within(items: np.ndarray, n: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least word edits between each item (``n`` words of a padded row) and any stretch of its text; padding matches nothing."""
    steps = np.arange(texts.shape[1] + 1)
    row = np.zeros((len(items), len(steps)), np.int64)
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + ((texts != items[:, i:i + 1]) | (texts == _PAD)), row[:, 1:] + 1)
        row = np.where((i < n)[:, None], np.minimum.accumulate(new - steps, axis=1) + steps, row)
    return row.min(1)


class Items:
    """One block of the benchmark, indexed by pieces and keys."""

    def __init__(self, ids: list[int], words: list[np.ndarray], tolerance: float = TOLERANCE, walks: int = WALKS):
        keep = [i for i, w in enumerate(words) if len(w)]
        self.ids, self.walks = np.array([ids[i] for i in keep], np.int64), walks
        words = [words[i] for i in keep]
        self.n = np.array([len(w) for w in words], np.int64)
        self.k = np.floor(self.n * tolerance + 1e-9).astype(np.int64)
        self.q = self.n // (self.k + 1)
        pieces: dict[int, list] = {}
        for w, n, k, q in zip(words, self.n.tolist(), self.k.tolist(), self.q.tolist()):
            grams = gram_hashes(w, q)
            for at in {p * n // (k + 1) for p in range(k + 1)}:
                pieces.setdefault(q, []).append((grams[at], at, n))
        self.pieces = {}
        for q, rows in pieces.items():
            rows = sorted(set((int(g), at, n) for g, at, n in rows))
            hashes = np.array([r[0] for r in rows], _U)
            near = np.zeros(1 << 16, bool)
            near[(hashes & _U(0xFFFF)).astype(np.int64)] = True
            self.pieces[q] = (hashes, np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), near)
        width = int(self.n.max()) if len(words) else 0
        self.rows = np.full((len(words), width), _PAD)
        for row, w in zip(self.rows, words):
            row[:len(w)] = w
        self.tables = []
        for walk in range(walks if len(words) else 0):
            keys = cgk_keys(self.rows, self.n, walk)
            for t in range(keys.shape[1]):
                order = np.argsort(keys[:, t], kind="stable")
                self.tables.append((keys[order, t], order))

    def windows(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distinct (start, size, text) of item-sized windows around pieces of items."""
        found = []
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for q, (hashes, offset, size, near) in self.pieces.items():
            grams = gram_hashes(words, q)
            pos = np.flatnonzero(near[(grams & _U(0xFFFF)).astype(np.int64)])
            pos = pos[pos + q <= at[1:][text[pos]]]
            lo = np.searchsorted(hashes, grams[pos], "left")
            m = np.searchsorted(hashes, grams[pos], "right") - lo
            pos, lo, m = pos[m > 0], lo[m > 0], m[m > 0]
            piece = np.repeat(lo - (np.cumsum(m) - m), m) + np.arange(m.sum())
            pos = np.repeat(pos, m)
            t = text[pos]
            start = np.maximum(pos - offset[piece], at[:-1][t])
            found.append(np.stack([start, size[piece], t], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def search(self, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item id, edits) of every contaminated text, each with its best match of an item."""
        best: dict[tuple[int, int], int] = {}
        places = self.windows(words, at)
        for lo in range(0, len(places), 2048):
            part = places[lo:lo + 2048]
            end = at[1:][part[:, 2]]
            pairs = self._candidates(_gather(words, part[:, 0], np.minimum(end, part[:, 0] + part[:, 1]), self.rows.shape[1]), part[:, 1])
            for cut in range(0, len(pairs), 2048):
                win, item = pairs[cut:cut + 2048].T
                k = self.k[item]
                begin = np.maximum(part[win, 0] - k, at[:-1][part[win, 2]])
                stop = np.minimum(end[win], part[win, 0] + part[win, 1] + 2 * k)
                edits = edits_within(self.rows[item], self.n[item], _gather(words, begin, stop, int((stop - begin).max())))
                for w, i, e in zip(win[edits <= k].tolist(), item[edits <= k].tolist(), edits[edits <= k].tolist()):
                    key = (int(part[w, 2]), i)
                    best[key] = min(e, best.get(key, e))
        return sorted((t, int(self.ids[i]), e) for (t, i), e in best.items())

    def _candidates(self, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Distinct (window, item) pairs of equal size that share a key in some table."""
        out, at = [], 0
        for walk in range(self.walks):
            keys = cgk_keys(rows, n, walk)
            for t in range(keys.shape[1]):
                known, order = self.tables[at]
                at += 1
                lo = np.searchsorted(known, keys[:, t], "left")
                m = np.searchsorted(known, keys[:, t], "right") - lo
                win = np.repeat(np.arange(len(rows)), m)
                out.append(np.stack([win, order[np.repeat(lo - (np.cumsum(m) - m), m) + np.arange(m.sum())]], 1))
        return np.unique(np.concatenate(out), axis=0)


def _gather(words: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """(rows x width) words from each start, padded beyond each end."""
    pos = start[:, None] + np.arange(width)
    inside = pos < end[:, None]
    return np.where(inside, words[np.minimum(pos, max(0, len(words) - 1))], _PAD)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> list[DataFrame]:
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // (4 * block_words)) + 1
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]


def _load(block: DataFrame, tolerance: float) -> Items:
    """One block on the driver: about ``block_words`` words, whatever the benchmark's size."""
    got = sorted((r.item_id if r.item_id is not None else -1, r.text) for r in block.collect())
    words, at = textkit.word_hashes(*textkit.utf8_buffers(pa.array([t for _, t in got], pa.string())))
    return Items([i for i, _ in got], [words[at[i]:at[i + 1]] for i in range(len(got))], tolerance)


def find_contamination(docs: DataFrame, benchmark: DataFrame, tolerance: float = TOLERANCE, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, edits): every document and item it holds within the tolerance, with the least edits found."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text, block_words):
        items = _load(block, tolerance)

        def run(batches, items=items):
            for batch in batches:
                for part in textkit.row_blocks(batch, "text"):
                    words, at = textkit.word_hashes(*textkit.utf8_buffers(part.column(1)))
                    hits = items.search(words, at)
                    if hits:
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array([t for t, _, _ in hits])), pa.array([i for _, i, _ in hits], pa.int64()),
                             pa.array([e for _, _, e in hits], pa.int64())], names=["doc_id", "item_id", "edits"])

        found = rows.mapInArrow(run, "doc_id long, item_id long, edits long")
        out = found if out is None else out.union(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, tolerance: float = TOLERANCE, text_col: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the same columns."""
    for block in _blocks(benchmark, "item_id", "text", block_words):
        items, where = _load(block, tolerance), docs.columns.index(text_col)

        def run(batches, items=items, where=where):
            for batch in batches:
                for part in textkit.row_blocks(batch, text_col):
                    words, at = textkit.word_hashes(*textkit.utf8_buffers(part.column(where)))
                    keep = np.ones(part.num_rows, bool)
                    keep[[t for t, _, _ in items.search(words, at)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
