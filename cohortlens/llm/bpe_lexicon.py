"""BPE encoding through a minimal acyclic transducer, and decoding (operator 2).

``build_lexicon`` counts the normalised words of the whole corpus and compiles
the most frequent ones, with their ids, into a minimal acyclic automaton:
words share prefixes and suffixes, an arc carries the number of words it
passes over, and the sum along a path is the word's place in a table of ids.
The automaton is one file in the shared folder; Spark hands it to each
executor and every Python worker maps it into memory.  Words outside it are
merged exactly, all words of a batch at once, so the lexicon's size (a
parameter) changes speed only, never ids.

Null texts count as empty: no ids, empty decoded text.  Special tokens spelt
out in a text are single ids, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import mmap
from collections import Counter
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit
from cohortlens.llm.bpe_text import TextEncoder, byte_symbols, task_done, worker_encoder

LEXICON_WORDS = 65_536
_PIECE_WORDS = 32_768  # words that one batch of counts holds and that are merged at once
_ARRAYS = (("arc_key", np.int64), ("arc_target", np.int32), ("arc_skip", np.int32), ("final", np.uint8),
           ("ids_at", np.int32), ("ids", np.int32))


class MergeTable:
    """BPE merges as sorted arrays; ``merge`` applies them to many words at once."""

    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        made: dict[int, int] = {}
        keys, new = [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            if made.get(a, -1) >= rank or made.get(b, -1) >= rank or c in made:
                raise ValueError("a merge precedes the one that makes its parts")
            made[c] = rank
            keys.append(a * self.size + b)
            new.append(c)
        # Parts are always made before they are used, so merging every place
        # of the lowest pair at once equals merging them one by one.
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = np.array(keys, np.int64)[order], order.astype(np.int64)
        self.new = np.array(new, np.int32)
        symbols = byte_symbols()
        self.code = {s: i for i, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + end] for s in symbols], np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) of words given as raw bytes (none empty)."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        none = len(self.keys)
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[np.frombuffer(b"".join(words), np.uint8)[ends]]
        word = np.repeat(np.arange(len(words)), size)
        done_sym, done_word = [], []
        rank = np.full(len(sym), none)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._ranks(sym[inside], sym[inside + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            span = np.diff(np.append(first, len(sym)))
            low = np.repeat(best, span)
            live = low < none
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, rank, low = sym[live], word[live], rank[live], low[live]
                if not len(sym):
                    break
            hit = rank == low
            pos = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(pos) != 1])  # in a run like "aaa", every other place
            if not run.all():
                start = np.maximum.accumulate(np.where(run, pos, -1))
                pos = pos[(pos - start) % 2 == 0]
            sym = sym.copy()
            sym[pos] = self.new[rank[pos]]
            keep = np.ones(len(sym), bool)
            keep[pos + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[pos]
            sym, word, rank = sym[keep], word[keep], rank[keep]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[touched] = none
            touched = touched[touched + 1 < len(sym)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._ranks(sym[touched], sym[touched + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


def compile_automaton(entries: list[tuple[bytes, tuple]]) -> bytes:
    """Minimal acyclic automaton of (word, ids) as one byte string; words need not be sorted, the first of equal ones counts."""
    table = dict(reversed(entries))
    words = sorted(table)
    known: dict[tuple, int] = {}
    count: list[int] = []
    nodes: list[tuple] = []

    def freeze(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(nodes)
            nodes.append(key)
            count.append(final + sum(count[t] for _, t in arcs))
        return known[key]

    open_finals, open_arcs, last = [False], [[]], b""

    def close(depth: int) -> None:
        while len(open_arcs) - 1 > depth:
            node = freeze(open_finals.pop(), open_arcs.pop())
            open_arcs[-1].append((last[len(open_arcs) - 1], node))

    for w in words:
        shared = next((i for i, (a, b) in enumerate(zip(last, w)) if a != b), min(len(last), len(w)))
        close(shared)
        for _ in w[shared:]:
            open_finals.append(False)
            open_arcs.append([])
        open_finals[-1] = True
        last = w
    close(0)
    root = freeze(open_finals[0], open_arcs[0])
    key, target, skip = [], [], []
    for n, (final, arcs) in enumerate(nodes):
        over = int(final)
        for b, t in arcs:
            key.append(n * 256 + b)
            target.append(t)
            skip.append(over)
            over += count[t]
    ids = [table[w] for w in words]
    arrays = (key, target, skip, [n[0] for n in nodes], np.concatenate([[0], np.cumsum([len(x) for x in ids])]),
              list(chain.from_iterable(ids)))
    parts = [np.asarray(a, kind).tobytes() for a, (_, kind) in zip(arrays, _ARRAYS)]
    head = json.dumps({"root": root, "words": len(words), "bytes": [len(p) for p in parts]}).encode().ljust(512)
    return head + b"".join(p.ljust(-(-len(p) // 8) * 8, b"\0") for p in parts)


class Automaton:
    """The compiled automaton over a mapped file or a byte string."""

    def __init__(self, data):
        head = json.loads(bytes(data[:512]))
        self.root, self.words, at = head["root"], head["words"], 512
        for (name, kind), n in zip(_ARRAYS, head["bytes"]):
            setattr(self, name, np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at))
            at += -(-n // 8) * 8

    @classmethod
    def map_file(cls, path: str) -> "Automaton":
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the id table, -1 where it is not in the lexicon; all words walk together."""
        n = len(words)
        place, state = np.zeros(n, np.int64), np.full(n, self.root, np.int64)
        if not n or not len(self.arc_key):
            return np.full(n, -1)
        size = np.fromiter(map(len, words), np.int64, n)
        data, at = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum(size)[:-1]])
        walk, step = np.arange(n), 0
        while True:
            walk = walk[size[walk] > step]
            if not len(walk):
                break
            key = state[walk] * 256 + data[at[walk] + step]
            arc = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            on = self.arc_key[arc] == key
            state[walk[~on]] = -1
            walk, arc = walk[on], arc[on]
            state[walk] = self.arc_target[arc]
            place[walk] += self.arc_skip[arc]
            step += 1
        return np.where((state >= 0) & (self.final[np.maximum(state, 0)] > 0), place, -1)

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all places, number of ids of each)."""
        size = (self.ids_at[places + 1] - self.ids_at[places]).astype(np.int64)
        end = np.cumsum(size)
        return self.ids[np.arange(size.sum()) + np.repeat(self.ids_at[places] - (end - size), size)], size


class LexiconEncoder(TextEncoder):
    """Distinct words walk the mapped automaton; the others are merged."""

    def __init__(self, tokenizer_json: str, lexicon_file: str | None):
        super().__init__(tokenizer_json)
        self.merges = MergeTable(tokenizer_json)
        self.lexicon = None
        if lexicon_file is not None:
            from pyspark import SparkFiles
            self.lexicon = Automaton.map_file(SparkFiles.get(lexicon_file))
        spec = json.loads(tokenizer_json)
        self.token = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}

    def _raw(self, word: str) -> bytes:
        return word.encode() if word.isascii() else bytes(map(self.merges.code.__getitem__, word))

    def encode_words(self, words):
        parts = [self._encode_piece(words[i:i + _PIECE_WORDS]) for i in range(0, max(1, len(words)), _PIECE_WORDS)]
        return tuple(map(np.concatenate, zip(*parts)))

    def _encode_piece(self, words):
        raw = list(map(self._raw, words))
        if self.lexicon is None:
            return self.merges.merge(raw)
        place = self.lexicon.places(raw)
        seen, unseen = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        parts = (self.lexicon.ids_of(place[seen]), self.merges.merge([raw[i] for i in unseen.tolist()]))
        size = np.zeros(len(raw), np.int64)
        size[seen], size[unseen] = parts[0][1], parts[1][1]
        end = np.cumsum(size)
        ids = np.empty(int(size.sum()), np.int32)
        for of, (flat, n) in zip((seen, unseen), parts):
            ids[np.arange(len(flat)) + np.repeat((end - size)[of] - (np.cumsum(n) - n), n)] = flat
        return ids, size

    def decode(self, ids: np.ndarray) -> str:
        """The tokenizer has no decoder of its own, so tokens are joined by spaces."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def word_counts(docs: DataFrame, tokenizer_json: str, text_col: str = "text", held: int = 400_000) -> DataFrame:
    """(word, n): normalised words of every whole text, pre-summed in each task."""
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def count(batches):
        cutter = worker_encoder(TextEncoder, model.value)
        seen: Counter = Counter()

        def words():
            rest = iter(seen.items())
            while some := list(islice(rest, _PIECE_WORDS)):
                word = pa.array([w[1:] if w[0] == "\0" else cutter.spell(w) for w, _ in some], pa.string())
                yield pa.RecordBatch.from_arrays([word, pa.array([n for _, n in some], pa.int64())], names=["word", "n"])
            seen.clear()

        for batch in batches:
            for part in textkit.row_blocks(batch, "text"):
                for t in part.column(0).to_pylist():
                    if t:
                        seen.update(cutter.cut(t))
                if len(seen) > held:
                    yield from words()
        yield from words()
        task_done()

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, tokenizer_json: str, folder: str, words: int = LEXICON_WORDS,
                  text_col: str = "text") -> str | None:
    """Compile the most frequent words of the corpus, at most ``words``, and hand the file to all executors; returns its name.

    A histogram of counts (a few hundred rows) gives the count from which on words are taken, so tasks send the
    driver those words only."""
    spark = docs.sparkSession
    counts = storage.stage(word_counts(docs, tokenizer_json, text_col), folder, "word_counts")
    step = F.floor(F.log("n") * 32).alias("step")
    room, least = words, None
    for r in sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("m")).collect(), key=lambda r: -r.step):
        if r.m > room:
            break
        room, least = room - r.m, r.step
    top = counts.where((step >= least) & (F.length("word") <= 64)).collect() if least is not None else []
    if not top:
        return None
    merges = MergeTable(tokenizer_json)
    raw = [bytes(map(merges.code.__getitem__, r.word)) for r in top]
    ids, size = merges.merge(raw)  # the order of words does not matter to the automaton
    data = compile_automaton(list(zip(raw, map(tuple, np.split(ids, np.cumsum(size)[:-1])))))
    name = f"lexicon-{folder.rpartition('/')[2]}-{hashlib.sha1(data).hexdigest()[:12]}.fsa"
    spark.sparkContext.addFile(storage.put_bytes(spark, f"{folder}/{name}", data))
    return name


def encode_documents(docs: DataFrame, tokenizer_json: str, lexicon: str | None, keep: tuple = ("doc_id",),
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 (and ids) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + [extra])

    def run(batches):
        encoder = worker_encoder(LexiconEncoder, model.value, lexicon)
        for batch in batches:
            for part in textkit.row_blocks(batch, "_text", 1 << 20):
                flat, at = encoder.encode([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                ids = np.split(flat, at[1:-1])
                cols = [*part.columns[:-1], pa.array(np.diff(at)),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids])]
                names = [*part.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
        task_done()

    return rows.mapInArrow(run, schema)
