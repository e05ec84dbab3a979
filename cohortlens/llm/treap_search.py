"""Ranked lexical search over K2-treaps of the term-document grid.

The documents are dealt into blocks of bounded text.  A block's grid has a row
a term (commonest first) and a column a document (ascending id); a cell holds
the impact (10^9 tf) div (1000 tf + 12 m).  Its K2-treap is the quadtree of the
occupied cells: per level a nibble of child bits a node, and each node's
largest impact, written as the difference to its parent's.  While the grid is
taller than wide (or wider than tall) the first levels halve the longer side
only.  An item follows one row path a term; a state is a range of documents
with the item's cells over it, bounded by the sum of weight x cell maximum.
States with the highest bounds are opened first, all items of a block side by
side, until no state can beat an item's k-th best document found so far.

Each block is one file below a folder of the shared store, and a table lists the
files; they are written once and answer any number of item sets.  A task holds
one block at a time.  Items come in sets of at
most ``ITEM_WORDS`` words, each against the whole index; ``SIDE_BY_SIDE`` items
descend together, which bounds the open states a task holds.

Defined results: a null or term-free text has no terms: such documents are
never returned and do not count for N, such items have no rows.  Every row of
``docs`` is a document of its own, also where ids repeat; a null doc_id ranks
behind other ids of the same score.  Rows of ``items`` with equal item_id are
ranked apart, each with its own ranks (``items`` should have unique ids).  Empty tables give
an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit

BLOCK_BYTES = 2 << 20
ITEM_WORDS = 200_000
BEAM, SIDE_BY_SIDE = 32, 64
NO_ID = np.iinfo(np.int64).max
_U = np.uint64
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
RESULT = "item_id long, rank int, doc_id long, score long"
PARTS = ("terms", "row_counts", "doc_ids", "shape", "bits", "maxima")
BLOCKS_A_TASK = 8


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the terms in a batch of texts; a text's end also ends a term."""
    solid = _TERM[data]
    first, last = solid.copy(), solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each term, A-Z as a-z; term offsets by text), in slices of bounded size."""
    hashes, starts_all = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    starts, ends = term_bounds(data, offsets)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + textkit.SLICE_BYTES, "right")))
        lo, hi = int(starts[at]), int(ends[stop - 1])
        textkit._Tables.need(hi - lo + 1)
        run = np.zeros(hi - lo + 1, _U)
        np.cumsum(textkit._BYTE_CODE[data[lo:hi]] * textkit._Tables.up[:hi - lo], out=run[1:])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        hashes.append(textkit.mix64((run[e] - run[s]) * textkit._Tables.down[s] + (e - s).astype(_U)))
        starts_all.append(starts[at:stop])
        at = stop
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_all), offsets)


def _bits(n: int) -> int:
    return max(0, int(n - 1).bit_length())


_POP = np.array([bin(i).count("1") for i in range(16)], np.int64)


class Treap:
    """The K2-treap of one block: per level the child bits of its nodes and each node's maximum.

    Levels go from the root (level 0: one node) to the cells; step l splits by the
    row bit, the document bit or both, as ``steps[l]`` = (row bits, document bits)."""

    def __init__(self, steps, bits, maxima):
        self.steps, self.bits, self.maxima = steps, bits, maxima
        self.first = [np.concatenate([[0], np.cumsum(_POP[b])])[:-1] for b in bits]

    @staticmethod
    def plan(n_rows: int, n_docs: int) -> list[tuple[int, int]]:
        r, d = _bits(n_rows), _bits(n_docs)
        both = min(r, d)
        return [(1, 0)] * (r - both) + [(0, 1)] * (d - both) + [(1, 1)] * both

    @classmethod
    def build(cls, row: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_rows: int, n_docs: int) -> "Treap":
        steps = cls.plan(n_rows, n_docs)
        r_left, d_left = _bits(n_rows), _bits(n_docs)
        code = np.zeros(len(row), np.int64)
        for r, d in steps:  # Morton code: the bits of each step in turn
            if r:
                r_left -= 1
                code = code << 1 | (row >> r_left & 1)
            if d:
                d_left -= 1
                code = code << 1 | (doc >> d_left & 1)
        order = np.argsort(code, kind="stable")
        code, top = code[order], impact[order].astype(np.int64)
        bits, maxima = [], [top]
        for r, d in reversed(steps):
            width = r + d
            parent = code >> width
            begin = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.zeros(0, np.int64)
            bits.append(np.bitwise_or.reduceat((1 << (code & ((1 << width) - 1))).astype(np.uint8), begin) if len(begin)
                        else np.zeros(0, np.uint8))
            top = np.maximum.reduceat(top, begin) if len(begin) else top[:0]
            maxima.append(top)
            code = parent[begin]
        return cls(steps, bits[::-1], maxima[::-1])

    def pack(self) -> tuple[bytes, bytes, bytes]:
        """(shape, bits, maxima): counts and steps, two nibbles a byte, differences to the parent's maximum."""
        shape = np.array([len(self.steps), *(x for s in self.steps for x in s), *(len(m) for m in self.maxima)], "<i8")
        nibbles = np.concatenate(self.bits) if self.bits else np.zeros(0, np.uint8)
        nibbles = np.append(nibbles, np.zeros(len(nibbles) % 2, np.uint8))
        falls = [self.maxima[0]] + [np.repeat(up, _POP[b]) - m for up, b, m in zip(self.maxima, self.bits, self.maxima[1:])]
        return shape.tobytes(), (nibbles[::2] | nibbles[1::2] << 4).astype(np.uint8).tobytes(), np.concatenate(falls).astype("<u4").tobytes()

    @classmethod
    def unpack(cls, shape: bytes, bits: bytes, maxima: bytes) -> "Treap":
        s = np.frombuffer(shape, "<i8")
        depth = int(s[0])
        steps = [(int(s[1 + 2 * i]), int(s[2 + 2 * i])) for i in range(depth)]
        sizes = s[1 + 2 * depth:]
        pairs = np.frombuffer(bits, np.uint8)
        nibbles = np.stack([pairs & 15, pairs >> 4], 1).ravel()
        at = np.concatenate([[0], np.cumsum(sizes)])
        falls = np.frombuffer(maxima, "<u4")
        levels = [nibbles[at[i]:at[i + 1]] for i in range(depth)]
        top = [falls[at[0]:at[1]].astype(np.int64)]
        for i in range(depth):
            top.append(np.repeat(top[i], _POP[levels[i]]) - falls[at[i + 1]:at[i + 2]])
        return cls(steps, levels, top)

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Index on the next level of each node's child (-1: none); node -1 has none."""
        mask = np.where(node >= 0, self.bits[level][node], 0).astype(np.int64)
        there = mask >> quadrant & 1
        return np.where(there == 1, self.first[level][node] + _POP[mask & ((1 << quadrant) - 1)], -1)


def _measure(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    return 75 + 25 * n * total_docs // max(total_terms, 1)


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents)."""
    def run(batches):
        have = terms = 0
        for batch in batches:
            for part in textkit.row_blocks(batch, text, BLOCK_BYTES):
                data, offsets = textkit.utf8_buffers(part.column(0))
                n = np.diff(np.searchsorted(term_bounds(data, offsets)[0], offsets))
                have, terms = have + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([have]), pa.array([terms])], names=["docs", "terms"])

    got = docs.select(text).mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(got[0] or 0), int(got[1] or 0)


def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Write the index of every document below ``folder``; returns (table of its files, documents with a term)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n_docs, n_terms = corpus_size(docs)

    def run(batches):
        for batch in batches:
            for part in textkit.row_blocks(batch, "text", BLOCK_BYTES):
                data, offsets = textkit.utf8_buffers(part.column(1))
                words, at = term_hashes(data, offsets)
                n = np.diff(at)
                ids = np.asarray(part.column(0).fill_null(NO_ID))
                order = np.argsort(ids, kind="stable")
                order = order[n[order] > 0]
                if not len(order):
                    continue
                place = np.full(len(n), -1, np.int64)
                place[order] = np.arange(len(order))
                doc = np.repeat(place, n)
                terms, local = np.unique(words, return_inverse=True)
                cell, tf = np.unique(local * len(order) + doc, return_counts=True)
                row, doc = np.divmod(cell, len(order))
                df = np.bincount(row, minlength=len(terms))
                common = np.argsort(-df, kind="stable")
                rank = np.empty(len(terms), np.int64)
                rank[common] = np.arange(len(terms))
                m = _measure(n[order], n_docs, n_terms)
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                packed = Treap.build(rank[row], doc, impact, len(terms), len(order)).pack()
                uri = f"{folder}/{uuid.uuid4().hex}.k2"  # a retried task writes other files; the table lists those that count
                _write(uri, [terms[common].astype("<u8").tobytes(), df[common].astype("<u4").tobytes(), ids[order].astype("<i8").tobytes(), *packed])
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(order)])], names=["file", "docs"])

    storage.put_bytes(docs.sparkSession, f"{folder}/READ_ME", b"one .k2 file a block, listed in files")  # makes the folder
    return storage.stage(docs.mapInArrow(run, "file string, docs long"), folder, "files"), n_docs


def _write(uri: str, parts: list[bytes]) -> None:
    fs, path = storage.open_fs(uri)
    small = [pa.compress(p, "zstd", asbytes=True) for p in parts]
    with fs.open_output_stream(path) as out:
        out.write(np.array([[len(p), len(s)] for p, s in zip(parts, small)], "<i8").tobytes())
        for s in small:
            out.write(s)


def _read(uri: str, parts: int) -> list[bytes]:
    """The first ``parts`` of PARTS of a block's file."""
    fs, path = storage.open_fs(uri)
    with fs.open_input_file(path) as f:
        sizes = np.frombuffer(f.read(16 * len(PARTS)), "<i8").reshape(-1, 2)
        return [pa.decompress(f.read(int(s)), int(n), "zstd", asbytes=True) for n, s in sizes[:parts]]


def _spread(index: DataFrame) -> DataFrame:
    return index.select("file").repartition(max(1, -(-index.count() // BLOCKS_A_TASK)))


def document_frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents holding each of the (sorted) terms."""
    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held = _read(uri, 2)
                own, count = np.frombuffer(held[0], "<u8"), np.frombuffer(held[1], "<u4")
                order = np.argsort(own)
                at = np.minimum(np.searchsorted(own, terms, sorter=order), len(own) - 1)
                row = order[at]
                total += np.where(own[row] == terms, count[row], 0)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["term", "df"])

    got = _spread(index).mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(len(terms), np.int64)
    for r in got:  # one row a term of the item set
        df[r["term"]] = r["df"]
    return df


class Items:
    """A set of items as (item, term) entries with weight x multiplicity; entries of an item lie together."""

    def __init__(self, hashes: np.ndarray, at: np.ndarray):
        item = np.repeat(np.arange(len(at) - 1), np.diff(at))
        self.terms, term = np.unique(hashes, return_inverse=True)
        key, times = np.unique(item * max(len(self.terms), 1) + term, return_counts=True)
        self.item, self.term = np.divmod(key, max(len(self.terms), 1))
        self.times, self.count = times, len(at) - 1

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)
        self.weight = self.times * w[self.term] if len(self.term) else self.times
        live = self.weight > 0
        self.item, self.term, self.weight = self.item[live], self.term[live], self.weight[live]


class Best:
    """The k best (score, document id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.full((items, k), NO_ID, np.int64)
        self.k = k

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        for i in np.unique(item).tolist():
            own = item == i
            s, d = np.concatenate([self.score[i], score[own]]), np.concatenate([self.doc[i], doc[own]])
            keep = np.lexsort((d, -s))[:self.k]
            self.score[i], self.doc[i] = s[keep], d[keep]

    def may_enter(self, item, bound, least_doc) -> np.ndarray:
        last = self.score[item, -1]
        return (bound > last) | ((bound == last) & (bound > 0) & (least_doc < self.doc[item, -1]))


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 of each run."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def descend(treap: Treap, ids: np.ndarray, rows: np.ndarray, items: Items, best: Best, beam: int = BEAM) -> int:
    """Best-first joint descent of all items' row paths; ``rows``: the row of each entry or -1.  Returns the states opened.

    A state is (level, document prefix, item) with the cell of each of its entries in a flat array."""
    depth, has = len(treap.steps), np.flatnonzero(rows >= 0)
    if not len(has):
        return 0
    row_bits = np.cumsum([0] + [r for r, _ in treap.steps])
    doc_bits = np.cumsum([0] + [d for _, d in treap.steps])
    entry_item, entry_row, weight = items.item[has], rows[has], items.weight[has]
    start = np.flatnonzero(np.concatenate([[True], entry_item[1:] != entry_item[:-1]]))
    size = np.diff(np.append(start, len(entry_item)))
    # open states: parallel arrays; cells and their entries lie in per-state slices of flat arrays
    level, prefix, item = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), entry_item[start]
    entry, cell, n_cells = np.arange(len(has)), np.zeros(len(has), np.int64), size
    bound = np.add.reduceat(weight * treap.maxima[0][0], start)
    opened = 0
    while len(item):
        least = ids[np.minimum(prefix << (doc_bits[-1] - doc_bits[level]), len(ids) - 1)]
        keep = best.may_enter(item, bound, least)
        order = np.lexsort((prefix, -level, -bound, item))
        order = order[keep[order]]
        if not len(order):
            break
        own = item[order]
        place = _runs(np.diff(np.append(np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])), len(own))))
        now, later = order[place < beam], np.sort(order[place >= beam])
        begin = np.cumsum(n_cells) - n_cells

        def slices(which):
            return np.repeat(begin[which], n_cells[which]) + _runs(n_cells[which])

        rest = slices(later)
        out = [(level[later], prefix[later], item[later], bound[later], n_cells[later], entry[rest], cell[rest])]
        opened += len(now)
        for lv in np.unique(level[now]).tolist():
            mine = now[level[now] == lv]
            flat = slices(mine)
            state = np.repeat(np.arange(len(mine)), n_cells[mine])
            r, d = treap.steps[lv]
            row_bit = entry_row[entry[flat]] >> (row_bits[-1] - row_bits[lv] - 1) & 1 if r else 0
            for doc_bit in ((0, 1) if d else (0,)):
                quadrant = (row_bit << d | doc_bit) if r else np.full(len(flat), doc_bit)
                nxt = treap.child(lv, cell[flat], quadrant)
                hit = np.flatnonzero(nxt >= 0)
                if not len(hit):
                    continue
                st, nx, en = state[hit], nxt[hit], entry[flat[hit]]
                head = np.flatnonzero(np.concatenate([[True], st[1:] != st[:-1]]))
                b = np.add.reduceat(weight[en] * treap.maxima[lv + 1][nx], head)
                which = mine[st[head]]
                p = prefix[which] << d | doc_bit
                if lv + 1 == depth:
                    best.add(item[which], b, ids[p])
                else:
                    out.append((np.full(len(which), lv + 1), p, item[which], b, np.diff(np.append(head, len(st))), en, nx))
        level, prefix, item, bound, n_cells, entry, cell = (np.concatenate(x) for x in zip(*out))
    return opened


def search_index(index: DataFrame, items: Items, n_docs: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best of each item of the set, best documents first found shared by its blocks."""
    items.weigh(document_frequencies(index, items.terms), n_docs)

    def run(batches):
        best = Best(items.count, k)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held = _read(uri, len(PARTS))
                own, ids = np.frombuffer(held[0], "<u8"), np.frombuffer(held[2], "<i8")
                order = np.argsort(own)
                at = order[np.minimum(np.searchsorted(own, items.terms, sorter=order), len(own) - 1)]
                row = np.where(own[at] == items.terms, at, -1)
                treap = Treap.unpack(*held[3:])
                if not treap.steps:  # one term in one document
                    hit = np.flatnonzero(row[items.term] >= 0)
                    best.add(items.item[hit], items.weight[hit] * treap.maxima[0][0],
                             np.repeat(ids, len(hit)))
                    continue
                entry_row = row[items.term]
                for g in range(0, items.count, SIDE_BY_SIDE):
                    descend(treap, ids, np.where(items.item // SIDE_BY_SIDE == g // SIDE_BY_SIDE, entry_row, -1), items, best)
        item, place = np.nonzero(best.score > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(best.doc[item, place]), pa.array(best.score[item, place])],
                                         names=["item", "doc_id", "score"])

    return _spread(index).mapInArrow(run, "item long, doc_id long, score long")


def _item_sets(items: DataFrame, words: int):
    """Sets of rows of at most ``words`` words (or one row), read one set at a time."""
    held, size = [], 0
    for r in items.toLocalIterator():
        n = len((r["text"] or "").split()) + 1
        if held and size + n > words:
            yield held
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += n
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, folder: str, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", item_words: int = ITEM_WORDS) -> DataFrame:
    """Columns ``RESULT``: each item's k best documents; index and results go below ``folder``."""
    spark = docs.sparkSession
    index, n_docs = build_index(docs, folder, doc_id, doc_text)
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    paths = []
    for rows in _item_sets(items, item_words):
        data, offsets = textkit.utf8_buffers(pa.array([t for _, t in rows], pa.large_string()))
        found = search_index(index, Items(*term_hashes(data, offsets)), n_docs, k)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "item long, item_id long")
        paths.append(f"set_{len(paths)}")
        storage.stage(_best(found, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), folder, paths[-1])
    if not paths:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*[f"{folder}/{p}" for p in paths])


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first within shares of the tasks' results, then of what these leave."""
    order = [F.desc("score"), F.asc("doc_id")]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    some = (found.withColumn("share", share)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).where(F.col("rank") <= k))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).drop("share")
