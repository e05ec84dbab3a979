"""Cross-entropy difference of a target and a background bigram model (operator 6).

Both models share one vocabulary, every distinct word of both corpora (V
counts the boundary and one unseen word besides), and one form:

    p(w | h) = L c(h, w) / c(h) + (1 - L) (c(w) + A) / (N + A V)

with a boundary before the first and after the last word of each text.  A
document's losses are -log p summed over its words and its end; its score is
the target's loss less the background's, per token: low means target-like.

All counts are exact and over whole corpora.  Pairs of the ``HEAD`` most
frequent words are counted in fixed arrays and scored where the text is read,
so no pair that any corpus makes hot is shuffled by key; the other pairs go,
packed, to buckets whose number follows the corpus: that of the history's hash,
or of the word's where the history is a head word.  So a bucket sees all pairs
that begin with its own words, which are these words' counts; the counts of
other buckets' words come by a join with the staged word counts, packed by pair
of buckets.  There a pair's occurrences are counted and scored in one visit.
What a bucket has found for
the documents of one piece of input goes back as one packed row, so rows
follow pieces and buckets, not their documents; these sums travel as 32-bit
floats, which keeps seven digits.

Texts without words (or null) have no tokens, losses 0 and score 0, and do not
count.  Rows that share an id are scored together; rows without an id count
as background but get no score.  Other columns are ignored; either corpus may
be empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit
from cohortlens.llm.storage import release_idle

HEAD = 1 << 10
LAMBDA, ALPHA = 0.6, 0.5
BUCKET_PAIRS = 3_000_000
SHARE_PAIRS = 400_000  # pairs of a bucket counted and scored at a time
PIECE, STEP = 8 << 20, 1 << 20  # bytes of text packed, and hashed, at a time
_BACK, _TARGET, _UNSCORED = 0, 1, 2
_BLOCK = 1 << 14


def _both(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_text: str) -> DataFrame:
    """(kind, doc_id, text) of both corpora."""
    back = docs.select(F.when(F.col(id_col).isNull(), _UNSCORED).otherwise(_BACK).alias("kind"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"), F.col(text_col).alias("text"))
    return back.union(target.select(F.lit(_TARGET).alias("kind"), F.lit(0).cast("long").alias("doc_id"),
                                    F.col(target_text).alias("text")))


def _merge(hashes: list, counts: list):
    h = np.concatenate(hashes)
    keys, inv = np.unique(h, return_inverse=True)
    c = np.concatenate(counts)
    return keys, np.stack([np.bincount(inv, c[:, j], len(keys)) for j in (0, 1)], 1).astype(np.int64)


def word_counts(both: DataFrame) -> DataFrame:
    """(word, back, target): exact counts of hashed words; tasks send each word once."""
    def run(batches):
        hashes, counts = [], []
        for batch in batches:
            for part in textkit.row_blocks(batch, "text", 2 * STEP):
                words, at = textkit.word_hashes(*textkit.utf8_buffers(part.column(2)))
                target = np.repeat(np.asarray(part.column(0)) == _TARGET, np.diff(at))
                if not len(words):
                    continue
                keys, inv = np.unique(words, return_inverse=True)
                t = np.bincount(inv, target, len(keys)).astype(np.int64)
                hashes.append(keys)
                counts.append(np.stack([np.bincount(inv, minlength=len(keys)) - t, t], 1))
                if sum(map(len, hashes)) > 2_000_000:
                    h, c = _merge(hashes, counts)
                    hashes, counts = [h], [c]
                    if len(h) > 1_500_000:
                        yield pa.RecordBatch.from_arrays([pa.array(textkit.signed(h)), pa.array(c[:, 0]), pa.array(c[:, 1])], names=names)
                        hashes, counts = [], []
        if hashes:
            h, c = _merge(hashes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(textkit.signed(h)), pa.array(c[:, 0].copy()), pa.array(c[:, 1].copy())], names=names)

    names = ["word", "back", "target"]
    return both.mapInArrow(run, "word long, back long, target long").groupBy("word").agg(
        F.sum("back").alias("back"), F.sum("target").alias("target"))


def _head_words(counts: DataFrame, size: int):
    """At most ``size`` words by falling count, with their counts; words of about equal count come together or not at all."""
    n = F.col("back") + F.col("target")
    step = F.floor(F.log(n.cast("double")) * 32).alias("step")
    room, least = size, None
    for r in sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("m")).collect(), key=lambda r: -r.step):
        if r.m > room:
            break
        room, least = room - r.m, r.step
    rows = counts.where(step >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    word, back, target = (rows[c].to_numpy() for c in ("word", "back", "target"))
    order = np.lexsort((word, -(back + target)))
    return word[order], back[order].astype(np.int64), target[order].astype(np.int64)


class Head:
    """Ids of the head words, from sorted hashes: 0 is the boundary, -1 any other word."""

    def __init__(self, words: np.ndarray):
        order = np.argsort(words)
        self.sorted, self.ids = words[order], (order + 1).astype(np.int64)

    def pairs(self, words: np.ndarray, at: np.ndarray):
        """(history, word, offsets), ids above hashes: each text's words and its end; texts without words have none."""
        h = textkit.signed(words)
        ids = np.full(len(h), -1, np.int64)
        if len(self.sorted):
            place = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            ids = np.where(self.sorted[place] == h, self.ids[place], -1)
        n = np.diff(at)
        tokens = n + (n > 0)
        off = np.concatenate([[0], np.cumsum(tokens)])
        word = np.zeros((2, off[-1]), np.int64)
        history = np.zeros((2, off[-1]), np.int64)
        slot = np.arange(len(ids)) + np.repeat(off[:-1] - at[:-1], n)
        word[:, slot] = ids, h
        history[:, slot + 1] = ids, h
        return history, word, off


def _head_counts(both: DataFrame, head_words, head: int) -> np.ndarray:
    """(2, head * head) exact pair counts of both corpora; the size is fixed."""
    cells = head * head

    def run(batches):
        head_of = Head(head_words.value)
        total = np.zeros((2, cells), np.int64)
        for batch in batches:
            for part in textkit.row_blocks(batch, "text", 2 * STEP):
                (history, _), (word, _), off = head_of.pairs(*textkit.word_hashes(*textkit.utf8_buffers(part.column(2))))
                target = np.repeat(np.asarray(part.column(0)) == _TARGET, np.diff(off))
                inside = (history >= 0) & (word >= 0)
                key = history * head + word
                total[0] += np.bincount(key[inside & ~target], minlength=cells)
                total[1] += np.bincount(key[inside & target], minlength=cells)
        flat = total.ravel()
        for b in range(0, len(flat), _BLOCK):
            if flat[b:b + _BLOCK].any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b // _BLOCK], pa.int32()), "counts": [flat[b:b + _BLOCK].tobytes()]})

    def add(batches):
        total: dict = {}
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[b] = total.get(b, 0) + np.frombuffer(c, np.int64)
        if total:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(total), pa.int32()), "counts": [c.tobytes() for c in total.values()]})

    kind = "block int, counts binary"
    flat = np.zeros(2 * cells, np.int64)
    for r in both.mapInArrow(run, kind).repartition("block").mapInArrow(add, kind).collect():
        part = np.frombuffer(r.counts, np.int64)
        flat[r.block * _BLOCK:r.block * _BLOCK + len(part)] = part
    return flat.reshape(2, cells)


def _losses(pair: np.ndarray, history: np.ndarray, word: np.ndarray, single: np.ndarray, total: int, size: int) -> np.ndarray:
    """-log p of one model of ``size`` words: pair counts, count of the history, smoothed count of the word; ``single`` by id."""
    c = np.maximum(single[history], 1)
    return -np.log(LAMBDA * pair / c + (1 - LAMBDA) * (single[word] + ALPHA) / (total + ALPHA * size))


def _cut(bucket: np.ndarray, buckets: int):
    """(order, [(bucket, slice)]): a stable order by bucket and where each bucket lies in it."""
    order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return order, [(b, slice(cut[b], cut[b + 1])) for b in np.flatnonzero(np.diff(cut)).tolist()]


_NAMES = ["piece", "bucket", "kinds", "rows", "counts", "data", "words"]
_KINDS = (pa.int64(), pa.int32(), *[pa.binary()] * 5)
_PACKED = "piece long, bucket int, kinds binary, rows binary, counts binary, data binary, words binary"


def _squeeze(values: np.ndarray) -> bytes:
    """An array's bytes, all first ones, all second ones and so on, compressed."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind).ravel()


def _squeeze_sorted(values: np.ndarray) -> bytes:
    return _squeeze(np.diff(values, prepend=values.dtype.type(0)))


def _unsqueeze_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(_unsqueeze(data, kind), dtype=kind)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def _scored(both: DataFrame, shared, head: int, buckets: int) -> DataFrame:
    """Packed rows by piece of input: with bucket -1 its documents, their tokens and losses of head pairs; else its
    other pairs of that bucket, with the rows they come from: the hashes of their words without the head's, and of each
    pair the codes of history and word, which are head ids or ``head`` + the place among these hashes."""
    def run(batches):
        from pyspark import TaskContext
        words, single, head_pairs, totals, size = shared.value
        head_of, piece = Head(words), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in textkit.row_blocks(batch, "text", PIECE):
                piece += 1
                kind, doc = np.asarray(part.column(0)).astype(np.uint8), np.asarray(part.column(1))
                tokens, head_loss, held, first_row = [], [], [], 0
                for some in textkit.row_blocks(part, "text", STEP):  # only what packing needs is kept of a step
                    (history, past), (word, now), off = head_of.pairs(*textkit.word_hashes(*textkit.utf8_buffers(some.column(2))))
                    tokens.append(np.diff(off))
                    row = np.repeat(np.arange(some.num_rows, dtype=np.int32), tokens[-1])
                    inside = (history >= 0) & (word >= 0)
                    own = inside & (kind[first_row + row] == _BACK)
                    at = history[own] * head + word[own]
                    head_loss.append(np.stack([np.bincount(row[own], _losses(head_pairs[m][at], history[own], word[own], single[m], totals[m],
                                                                             size), some.num_rows).astype(float) for m in (0, 1)]))
                    rest = ~inside
                    held.append((row[rest] + np.int32(first_row), history[rest].astype(np.int32), word[rest].astype(np.int32), past[rest], now[rest]))
                    first_row += some.num_rows
                out = [(piece, -1, kind.tobytes(), doc.astype(np.int64).tobytes(), np.concatenate(tokens).astype(np.int64).tobytes(),
                        np.concatenate(head_loss, axis=1).tobytes(), None)]
                row, history, word, past, now = (np.concatenate(x) for x in zip(*held))
                del held
                order, cut = _cut(np.mod(np.where(history < 0, past, now), buckets), buckets)
                for b, s in cut:
                    mine = order[s]
                    rows, m = np.unique(row[mine], return_counts=True)  # in order of rows, as the sort was stable
                    ids = np.concatenate([history[mine], word[mine]])
                    other = ids < 0
                    names, place = np.unique(np.concatenate([past[mine], now[mine]])[other], return_inverse=True)
                    ids[other] = head + place
                    out.append((piece, b, _squeeze(kind[rows]), _squeeze_sorted(rows.astype(np.uint32)), _squeeze(m.astype(np.uint32)),
                                _squeeze(ids.astype(np.uint32)), _squeeze_sorted(names)))
                yield _batch(out)

    return both.mapInArrow(run, _PACKED)


def _groups(batches, key: str):
    """(key, rows) of consecutive rows with an equal key."""
    now, held = None, []
    for batch in batches:
        release_idle()
        for i, own in enumerate(batch.column(batch.schema.get_field_index(key)).to_pylist()):
            if own != now:
                if held:
                    yield now, held
                now, held = own, []
            held.append(tuple(c[i].as_py() for c in batch.columns))  # row by row: only this group is held as bytes
    if held:
        yield now, held


def _other_counts(packed: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Counts of the words that a bucket's pairs end with and another bucket owns: one row for the two buckets, with
    piece -1 - owner and the counts in order of the hashes."""
    def pack(batches):
        held: list = []

        def rows():
            word, back, target = (np.concatenate(x) for x in zip(*held))
            order, cut = _cut(np.mod(word, buckets), buckets)
            word, count = word[order], np.stack([back, target])[:, order]
            return _batch([(-1, b, None, None, _squeeze(count[:, s].ravel()), None, _squeeze(word[s])) for b, s in cut])

        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(c).to_numpy() for c in ("word", "back", "target")])
            if sum(len(h[0]) for h in held) >= 1 << 20:
                yield rows()
                held = []
        if held:
            yield rows()

    def foreign(batches):
        for batch in batches:
            out = []
            for bucket, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = _unsqueeze_sorted(words, np.int64)
                w = w[np.mod(w, buckets) != bucket]
                if len(w):
                    out.append((bucket, _squeeze_sorted(w)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.binary()))], names=["bucket", "words"])

    def ask(batches):
        for asker, held in _groups(batches, "bucket"):
            word = np.unique(np.concatenate([_unsqueeze_sorted(h[1], np.int64) for h in held]))
            order, cut = _cut(np.mod(word, buckets), buckets)
            yield _batch([(asker, owner, None, None, None, None, _squeeze(word[order[s]])) for owner, s in cut])

    def answer(batches):
        for owner, held in _groups(batches, "bucket"):
            own = [h for h in held if h[0] < 0]
            word = np.concatenate([_unsqueeze(h[6], np.int64) for h in own])
            count = np.concatenate([_unsqueeze(h[4], np.int64).reshape(2, -1) for h in own], 1)
            order = np.argsort(word)
            word, count = word[order], count[:, order]
            for h in held:
                if h[0] >= 0:
                    at = np.searchsorted(word, _unsqueeze(h[6], np.int64))
                    yield _batch([(-1 - owner, h[0], None, None, _squeeze(count[:, at].ravel()), None, None)])

    asked = packed.select("bucket", "words").mapInArrow(foreign, "bucket int, words binary").repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(ask, _PACKED)
    return asked.unionByName(counts.mapInArrow(pack, _PACKED)).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        answer, _PACKED)


def _bucket_losses(packed: DataFrame, others: DataFrame, shared, head: int, buckets: int) -> DataFrame:
    """Count and score the pairs of each bucket; one row for each piece it has pairs of."""
    def run(batches):
        _, head_single, _, totals, size = shared.value
        for bucket, rows in _groups(batches, "bucket"):
            held = [h for h in rows if h[0] >= 0]
            kind = [_unsqueeze(h[2], np.uint8) for h in held]
            m = [_unsqueeze(h[4], np.uint32) for h in held]
            names = [_unsqueeze_sorted(h[6], np.int64) for h in held]
            words, place = np.unique(np.concatenate(names), return_inverse=True)
            counts = np.concatenate(m)
            history, word = np.empty((2, int(counts.sum())), np.int32)
            at = to = 0
            for h, w in zip(held, names):
                code = np.concatenate([np.arange(head), head + place[at:at + len(w)]])[_unsqueeze(h[5], np.uint32)].reshape(2, -1)
                history[to:to + code.shape[1]], word[to:to + code.shape[1]] = code
                at, to = at + len(w), to + code.shape[1]
            del names, place
            target = np.repeat(np.concatenate(kind) == _TARGET, counts)
            n = head + len(words)
            single = np.stack([np.bincount(history[~target], minlength=n), np.bincount(history[target], minlength=n)])
            single[:, :head] = head_single
            owner = np.mod(words, buckets)
            for h in rows:
                if h[0] < 0:
                    single[:, head + np.flatnonzero(owner == -1 - h[0])] = _unsqueeze(h[4], np.int64).reshape(2, -1)
            row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            loss = np.zeros((2, len(counts)))
            shares = max(1, -(-len(word) // SHARE_PAIRS))
            share = np.mod(history * np.int32(7919) + word, np.int32(shares)).astype(np.int16)  # equal pairs lie in one share
            for part in range(shares):
                mine = np.flatnonzero(share == part)
                keys, inv = np.unique(history[mine] * np.int64(n) + word[mine], return_inverse=True)
                count_t = np.bincount(inv, target[mine], len(keys))
                count_b = np.bincount(inv, minlength=len(keys)) - count_t
                first, second = np.divmod(keys, n)
                for k, c in ((0, count_b), (1, count_t)):
                    loss[k] += np.bincount(row[mine], _losses(c, first, second, single[k], totals[k], size)[inv], len(counts))
            del history, word, share, row
            out, at = [], 0
            for h, k in zip(held, kind):
                ok = k == _BACK
                if ok.any():
                    mine = [x[at:at + len(k)][ok] for x in loss]
                    out.append((h[0], bucket, None, _unsqueeze_sorted(h[3], np.uint32)[ok].tobytes(), None,
                                np.stack(mine).astype(np.float32).tobytes(), None))
                at += len(k)
            if out:
                yield _batch(out)

    return packed.unionByName(others).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _PACKED)


def _by_document(packed: DataFrame) -> DataFrame:
    """(doc_id, tokens, target_loss, background_loss) from the rows of each piece, which its text's size bounds."""
    def run(batches):
        for _, held in _groups(batches, "piece"):
            first = held[0]  # bucket -1
            kind, doc, tokens = (np.frombuffer(first[i], t) for i, t in ((2, np.uint8), (3, np.int64), (4, np.int64)))
            loss = np.frombuffer(first[5]).reshape(2, -1).copy()
            for h in held[1:]:
                loss[:, np.frombuffer(h[3], np.uint32)] += np.frombuffer(h[5], np.float32).reshape(2, -1)
            ok = kind == _BACK
            yield pa.RecordBatch.from_arrays([pa.array(doc[ok]), pa.array(tokens[ok]), pa.array(loss[1][ok]), pa.array(loss[0][ok])],
                                             names=["doc_id", "tokens", "target_loss", "background_loss"])

    return packed.repartition("piece").sortWithinPartitions("piece", "bucket").mapInArrow(
        run, "doc_id long, tokens long, target_loss double, background_loss double")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                             target_text: str = "text", head: int = HEAD, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Per document id: n_tokens, target_loss, background_loss and score, the difference per token."""
    spark = docs.sparkSession
    both = _both(docs, target, id_col, text_col, target_text)
    counts = storage.stage(word_counts(both), folder, "words")
    words, back, of_target = _head_words(counts, head - 1)
    sums = counts.agg(F.sum("back"), F.sum("target"), F.count(F.lit(1))).first()
    filled = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends = {r.t: r.m for r in both.where(filled).groupBy((F.col("kind") == _TARGET).alias("t")).agg(F.count(F.lit(1)).alias("m")).collect()}
    single = np.stack([np.concatenate([[ends.get(bool(m), 0)], c]) for m, c in ((0, back), (1, of_target))]).astype(np.int64)
    totals, head = [int(sums[m] or 0) + ends.get(bool(m), 0) for m in (0, 1)], single.shape[1]
    head_pairs = _head_counts(both, spark.sparkContext.broadcast(words), head)
    buckets = max(1, -(-(sum(totals) - int(head_pairs.sum())) // bucket_pairs))
    shared = spark.sparkContext.broadcast((words, single, head_pairs, totals, sums[2] + 2))
    parts = storage.stage(_scored(both, shared, head, buckets), folder, "pairs")
    rest = parts.where("bucket >= 0")
    found = parts.where("bucket < 0").unionByName(_bucket_losses(rest, _other_counts(rest, counts, buckets), shared, head, buckets))
    summed = _by_document(found).groupBy("doc_id").agg(
        F.sum("tokens").alias("n_tokens"), F.sum("target_loss").alias("target_loss"), F.sum("background_loss").alias("background_loss"))
    return summed.withColumn("score", F.when(F.col("n_tokens") > 0, (F.col("target_loss") - F.col("background_loss")) / F.col("n_tokens"))
                             .otherwise(0.0))
