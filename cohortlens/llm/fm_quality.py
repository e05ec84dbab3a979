"""Document quality by a factorisation machine (operator 4).

A text's features are hashed words (log counts, scaled to unit length) and
binned structure statistics and metadata: shares of character classes, word,
line and repetition statistics, lengths.  The score of a document is

    sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]),

linear in the number of features.  Labels are learnt from a sample of at most
``TRAIN_ROWS`` labelled rows outside the held-out fold, those with the
smallest hash of their id, so a run repeats exactly; one task fits them and the
driver sees the model only.  Every document's whole text is scored.  Labels, language, source and ids are never features.

Null texts count as empty; an empty text has its statistics' bins only.
Without training rows of both classes the score is the share of label 1
(0.5 if there are none).  Repeated ids are scored row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm import storage, textkit

TRAIN_ROWS = 8_000
PIECE = 1 << 19  # bytes of text whose features are made at once; they take some fifty times as much
WORD_SLOTS = 1 << 15
FACTORS = 8
BINS = 12
_STATS = ("upper", "digit", "mark", "space", "newline", "high", "chars", "words", "word_len", "distinct", "top_word",
          "lines", "line_repeats", "line_len", "shingle_repeats", "end_mark", "mark_runs", "upper_words", "long_words")
SLOTS = WORD_SLOTS + len(_STATS) * BINS

_CLASS = np.zeros(256, np.int64)  # other (lower-case and control)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[128:192] = 6  # continuation bytes
_CLASS[192:] = 7


def _per_text(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets])


def _bin(x: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """Even bins between lo and hi; what lies outside goes to the ends."""
    return np.clip(((x - lo) / (hi - lo) * BINS).astype(np.int64), 0, BINS - 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, values, offsets by text): sparse feature rows of a batch of texts."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    cls = np.bincount(row * 8 + _CLASS[data], minlength=n * 8).reshape(n, 8).astype(float)
    chars = np.maximum(size - cls[:, 6], 1)
    words, at = textkit.word_hashes(data, offsets)
    n_words = np.diff(at)
    mark = _CLASS[data] == 3
    same = np.zeros(len(data), bool)
    same[1:] = mark[1:] & (data[1:] == data[:-1])
    newline = data == 10
    before_gap = np.zeros(len(data), bool)
    if len(data):
        gap = (_CLASS[data] == 4) | newline
        before_gap[:-1] = mark[:-1] & gap[1:]
    capital = np.zeros(len(data), bool)
    if len(data):
        upper = _CLASS[data] == 1
        capital[1:] = upper[1:] & upper[:-1]
    # lines of each text, by hash
    cut = np.unique(np.concatenate([offsets, np.flatnonzero(newline) + 1]))
    begin, end = cut[:-1], cut[1:]
    line_row = np.searchsorted(offsets, begin, "right") - 1
    place = np.arange(len(data)) - np.repeat(begin, end - begin)
    code = textkit.mix64((data.astype(np.int64) + 257 * place + 1).astype(np.uint64))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code)])
    line_hash = run[end] - run[begin]
    lines = np.bincount(line_row, minlength=n)
    order = np.lexsort((line_hash, line_row))
    again = np.zeros(n)
    if len(order) > 1:
        lr, lh = line_row[order], line_hash[order]
        again = np.bincount(lr[1:][(lr[1:] == lr[:-1]) & (lh[1:] == lh[:-1])], minlength=n)
    shingles, sh_at = textkit.shingle_hashes(words, at, 3)
    sh_distinct = np.diff(textkit.distinct_by_text(shingles, sh_at)[1])
    slots, values, sizes = [], [], np.zeros(n, np.int64)
    distinct, top = np.zeros(n), np.zeros(n)
    for i in range(n):
        w, c = np.unique(words[at[i]:at[i + 1]], return_counts=True)
        distinct[i] = len(w)
        top[i] = c.max() if len(c) else 0
        slots.append((w % np.uint64(WORD_SLOTS)).astype(np.int64))
        x = np.log1p(c)
        values.append(x / max(np.sqrt((x * x).sum()), 1e-9))
        sizes[i] = len(w) + len(_STATS)
    w1 = np.maximum(n_words, 1)
    stats = (
        (cls[:, 1] / chars, 0, .3), (cls[:, 2] / chars, 0, .3), (cls[:, 3] / chars, 0, .3), (cls[:, 4] / chars, 0, .3),
        (cls[:, 5] / chars, 0, .06), (cls[:, 7] / chars, 0, .3), (np.log1p(size), 0, 12), (np.log1p(n_words), 0, 10),
        (chars / w1, 2, 14), (distinct / w1, 0, 1), (top / w1, 0, .3), (np.log1p(lines), 0, 6),
        (again / np.maximum(lines, 1), 0, .6), (np.log1p(chars / np.maximum(lines, 1)), 0, 9),
        (1 - sh_distinct / np.maximum(np.diff(sh_at), 1), 0, .6), (_per_text(before_gap, offsets) / w1, 0, 1),
        (_per_text(same, offsets) / w1, 0, 1), (_per_text(capital, offsets) / w1, 0, 1.2),
        (np.log1p(np.maximum(chars - 6 * w1, 0) / w1), 0, 4),
    )
    base = np.stack([WORD_SLOTS + j * BINS + _bin(x, lo, hi) for j, (x, lo, hi) in enumerate(stats)], 1)
    out_at = np.concatenate([[0], np.cumsum(sizes)])
    idx, val = np.empty(out_at[-1], np.int64), np.empty(out_at[-1], np.float64)
    weight = 1 / np.sqrt(len(_STATS))
    for i in range(n):
        a, b = out_at[i], out_at[i + 1]
        idx[a:b - len(_STATS)], idx[b - len(_STATS):b] = slots[i], base[i]
        val[a:b - len(_STATS)], val[b - len(_STATS):b] = values[i], weight
    return idx, val, out_at


class FactorisationMachine:
    """Weights ``b``, ``w`` (slots), ``v`` (slots x factors)."""

    def __init__(self, b: float, w: np.ndarray, v: np.ndarray):
        self.b, self.w, self.v = b, w, v

    def _sums(self, idx, val, at):
        """(linear part, factor sums, pairwise part) of each row; every row has features."""
        xv = self.v[idx] * val[:, None]
        lin = np.add.reduceat(self.w[idx] * val, at[:-1])
        s = np.add.reduceat(xv, at[:-1], axis=0)
        q = np.add.reduceat(xv * xv, at[:-1], axis=0)
        return lin, s, xv, 0.5 * (s * s - q).sum(1)

    def score(self, idx, val, at) -> np.ndarray:
        if len(at) < 2:
            return np.zeros(0)
        lin, _, _, pair = self._sums(idx, val, at)
        return 1 / (1 + np.exp(-np.clip(self.b + lin + pair, -30, 30)))

    @classmethod
    def constant(cls, share: float):
        """Scores every text with ``share``."""
        b = float(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -30, 30))
        return cls(b, np.zeros(SLOTS, np.float32), np.zeros((SLOTS, FACTORS), np.float32))

    @classmethod
    def fit(cls, idx, val, at, y, epochs: int = 8, rows: int = 128, rate: float = 0.15, l2: float = 2e-5, seed: int = 7):
        """AdaGrad on the logistic loss over mini-batches."""
        rng = np.random.default_rng(seed)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        m = cls(float(np.log(share / (1 - share))), np.zeros(SLOTS), rng.normal(0, 0.05, (SLOTS, FACTORS)))
        gb, gw, gv = 1e-8, np.full(SLOTS, 1e-8), np.full((SLOTS, FACTORS), 1e-8)
        n = np.diff(at)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(order), rows):
                pick = order[lo:lo + rows]
                size = n[pick]
                sub = np.concatenate([[0], np.cumsum(size)])
                src = np.repeat(at[pick] - sub[:-1], size) + np.arange(sub[-1])
                i, x = idx[src], val[src]
                lin, s, xv, pair = m._sums(i, x, sub)
                err = 1 / (1 + np.exp(-np.clip(m.b + lin + pair, -30, 30))) - y[pick]
                e = np.repeat(err, size) * x / len(pick)
                used, inv = np.unique(i, return_inverse=True)
                dw = np.bincount(inv, e) + l2 * m.w[used]
                g = e[:, None] * (np.repeat(s, size, axis=0) - xv)
                dv = np.stack([np.bincount(inv, g[:, f]) for f in range(FACTORS)], 1) + l2 * m.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                m.w[used] -= rate * dw / np.sqrt(gw[used])
                m.v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
                db = float(err.mean())
                gb += db * db
                m.b -= rate * db / np.sqrt(gb)
        return m


def held_out(id_col: str):
    """The fold never learnt from."""
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> FactorisationMachine:
    """Fit on at most ``rows`` labelled rows outside the held-out fold."""
    label = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(label_col).alias("_y")))
    # labels without a document don't count towards the bound
    known = label.join(docs.select(id_col).where(F.col(id_col).isNotNull()).distinct(), id_col)
    pick = storage.bounded_sample(known, id_col, rows)
    # at most `rows` (id, label) pairs: a bounded broadcast
    sample = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(pick), id_col).select(id_col, "_y", "_text")

    def run(batches):
        for batch in batches:
            for part in textkit.row_blocks(batch, "_text", PIECE):
                idx, val, at = features(*textkit.utf8_buffers(part.column(2)))
                at32 = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1).cast(pa.int32()),
                     pa.ListArray.from_arrays(at32, pa.array(idx.astype(np.int32))),
                     pa.ListArray.from_arrays(at32, pa.array(val.astype(np.float32)))], names=["id", "y", "idx", "val"])

    def fit(batches):
        """One task on the bounded sample, sorted so that a run repeats exactly."""
        ys, idx, val, size = [np.zeros(0)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)], [np.zeros(0, np.int64)]
        for b in batches:
            ys.append(np.asarray(b.column(1)).astype(float))
            idx.append(np.asarray(b.column(2).flatten()))
            val.append(np.asarray(b.column(3).flatten()))
            size.append(np.diff(np.asarray(b.column(2).offsets)).astype(np.int64))
        y = np.concatenate(ys)
        if not len(y) or y.min() == y.max():
            m = FactorisationMachine.constant(float(y.mean()) if len(y) else 0.5)
        else:
            at = np.concatenate([[0], np.cumsum(np.concatenate(size))])
            m = FactorisationMachine.fit(np.concatenate(idx), np.concatenate(val), at, y)
        yield pa.RecordBatch.from_pydict({"b": [float(m.b)], "w": [m.w.astype(np.float32).tobytes()],
                                          "v": [m.v.astype(np.float32).tobytes()]})

    rows = sample.mapInArrow(run, "id string, y int, idx array<int>, val array<float>")
    got = rows.repartition(1).sortWithinPartitions("id", "y").mapInArrow(fit, "b double, w binary, v binary").collect()
    if not got:
        return FactorisationMachine.constant(0.5)
    return FactorisationMachine(got[0].b, np.frombuffer(got[0].w, np.float32), np.frombuffer(got[0].v, np.float32).reshape(SLOTS, FACTORS))


def score(docs: DataFrame, model: FactorisationMachine, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``_score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.b, model.w, model.v))
    where = docs.columns.index(text_col)

    def run(batches):
        m = FactorisationMachine(*shared.value)
        for batch in batches:
            for part in textkit.row_blocks(batch, text_col, PIECE):
                s = m.score(*features(*textkit.utf8_buffers(part.column(where))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s.astype(np.float64))],
                                                 names=[*part.schema.names, "_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def keep_good(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with the same columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.b, model.w, model.v))
    where = docs.columns.index(text_col)

    def run(batches):
        m = FactorisationMachine(*shared.value)
        for batch in batches:
            for part in textkit.row_blocks(batch, text_col, PIECE):
                yield part.filter(pa.array(m.score(*features(*textkit.utf8_buffers(part.column(where)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
