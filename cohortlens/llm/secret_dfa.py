"""Secret scan with one deterministic automaton for all rules (operator 5).

Rule patterns (a small regex subset: literals, classes, groups, ``|``, ``?``,
``*``, ``+``) become NFAs; subset construction with leftmost-longest,
non-overlapping semantics per rule gives one search automaton a rule, their
product is minimised, and the result is a flat transition array over bytes.
One pass over a text's bytes finds the ends of all rules' matches; a short
backward pass from each end finds its start.  Bytes that lead every state to
the start state cut a batch into segments, and all segments of a batch step
together, so the pass is vectorised.

Null texts count as empty.  Spans are code points, end exclusive.  At most
eight rules (a bit each).  Every row is scanned by itself, also where ids
repeat or are null; an empty table gives an empty result, extra columns are
ignored by ``find_secrets`` and kept by ``redact``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit


@dataclass(frozen=True)
class Rule:
    """A match counts if its last ``tail`` bytes or more, each by itself, could end a match: the bytes
    of its final ``+`` class.  ``fold``: letters of the pattern in either case."""
    kind: str
    pattern: str
    tail: int
    fold: bool = False


# The rules of the contract (6 characters of value; 20 with AKIA, so 16 after it; 24).
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, fold=True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 24),
)
# Published token formats (prefix and least length of what follows) and the private-key header.
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 16),
    Rule("pem", r"-----BEGIN [A-Z ]+PRIVATE KEY----[-]+", 1),
)
ALL_RULES = BASE_RULES + MORE_RULES


# ---- regex -> NFA -------------------------------------------------------

class _Nfa:
    """Thompson construction; edges are (byte set or None, target)."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold
        self.edges: list[list] = []
        self.start, self.accept = self._alt()
        if self.at != len(pattern):
            raise ValueError(f"bad pattern at {self.at}: {pattern}")

    def _node(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def _alt(self):
        s, e = self._node(), self._node()
        while True:
            a, b = self._seq()
            self.edges[s].append((None, a))
            self.edges[b].append((None, e))
            if self.at < len(self.text) and self.text[self.at] == "|":
                self.at += 1
                continue
            return s, e

    def _seq(self):
        s = e = self._node()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            a, b = self._atom()
            mark = self.text[self.at:self.at + 1]
            if mark and mark in "?*+":
                self.at += 1
                x, y = self._node(), self._node()
                self.edges[x].append((None, a))
                self.edges[b].append((None, y))
                if mark != "+":
                    self.edges[x].append((None, y))
                if mark != "?":
                    self.edges[b].append((None, a))
                a, b = x, y
            self.edges[e].append((None, a))
            e = b
        return s, e

    def _char(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def _atom(self):
        c = self.text[self.at]
        if c == "(":
            self.at += 1
            out = self._alt()
            self.at += 1
            return out
        if c == "[":
            self.at += 1
            chars = set()
            while self.text[self.at] != "]":
                lo = hi = self._char()
                if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                    self.at += 1
                    hi = self._char()
                chars.update(range(lo, hi + 1))
            self.at += 1
        else:
            chars = {self._char()}
        if self.fold:
            chars |= {ord(chr(b).swapcase()) for b in chars if chr(b).isalpha()}
        s, e = self._node(), self._node()
        self.edges[s].append((frozenset(chars), e))
        return s, e

    def closure(self, states) -> frozenset:
        out, todo = set(states), list(states)
        while todo:
            for label, t in self.edges[todo.pop()]:
                if label is None and t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    def step(self, states, byte: int) -> frozenset:
        return self.closure({t for s in states for label, t in self.edges[s] if label is not None and byte in label})


def _minimise(step: list[list[int]], mark: list) -> tuple[list[list[int]], list[int]]:
    """Moore partition refinement; returns (steps of blocks, block of each state)."""
    names: dict = {}
    block = [names.setdefault(m, len(names)) for m in mark]
    while True:
        names = {}
        new = [names.setdefault((block[s], *(block[t] for t in row)), len(names)) for s, row in enumerate(step)]
        if len(names) == len(set(block)):
            break
        block = new
    out = [None] * len(set(block))
    for s, row in enumerate(step):
        out[block[s]] = [block[t] for t in row]
    return out, block


def _search(nfa: _Nfa) -> tuple[list[list[int]], list[bool]]:
    """Search automaton of one rule: leftmost-longest, non-overlapping.

    A state is the list of NFA state sets of the live starts, earliest first.
    Once one accepts, later starts are dropped and none begins until it ends.
    """
    begin = nfa.closure({nfa.start})
    if nfa.accept in begin:
        raise ValueError("a rule matches the empty text")

    def settle(groups) -> tuple:
        out, seen = [], set()
        for g in groups:
            g = g - seen
            if not g:
                continue
            seen |= g
            out.append(g)
            if nfa.accept in g:
                if len(out) > 1:
                    raise ValueError("a start inside another live one accepts first; the rule needs backing up")
                break
        return tuple(out)

    ids, todo, step, accept = {(): 0}, [()], [], []
    while todo:
        state = todo.pop(0)
        matched = bool(state) and nfa.accept in state[0]
        row = []
        for b in range(256):
            moved = [nfa.step(g, b) for g in state]
            if matched and nfa.accept not in moved[0]:
                if moved[0] - {nfa.accept} and any(label for s in moved[0] for label, _ in nfa.edges[s]):
                    raise ValueError("a match goes on without accepting; the rule needs backing up")
                moved = []  # it ended before b, and b may begin the next one
            if not (moved and nfa.accept in moved[0]):
                moved.append(nfa.step(begin, b))
            new = settle(moved)
            if new not in ids:
                ids[new] = len(ids)
                todo.append(new)
            row.append(ids[new])
        step.append(row)
        accept.append(matched)
    step, block = _minimise(step, accept)
    out = [False] * len(step)
    for s, m in enumerate(accept):
        out[block[s]] = m
    # state 0 of the unminimised automaton is the start; keep it first
    first = block[0]
    perm = [first, *(s for s in range(len(step)) if s != first)]
    back = {s: i for i, s in enumerate(perm)}
    return [[back[t] for t in step[s]] for s in perm], [out[s] for s in perm]


class Automaton:
    """All rules at once.  ``table[state * 256 + byte]`` is the next state; ``inside[state]`` has a bit for each rule
    whose match could end with the last byte."""

    def __init__(self, rules=BASE_RULES):
        self.rules = tuple(rules)
        nfas = [_Nfa(r.pattern, r.fold) for r in rules]
        single = [_search(n) for n in nfas]
        ids, todo, step = {(0,) * len(rules): 0}, [(0,) * len(rules)], []
        states = list(todo)
        while todo:
            state = todo.pop(0)
            row = []
            for b in range(256):
                new = tuple(s[0][q][b] for s, q in zip(single, state))
                if new not in ids:
                    ids[new] = len(ids)
                    todo.append(new)
                    states.append(new)
                row.append(ids[new])
            step.append(row)
        mark = [sum(bool(s[1][q]) << i for i, (s, q) in enumerate(zip(single, state))) for state in states]
        step, block = _minimise(step, mark)
        first = block[0]
        perm = [first, *(s for s in range(len(step)) if s != first)]
        back = {s: i for i, s in enumerate(perm)}
        self.table = np.array([[back[t] for t in step[s]] for s in perm], np.int32).ravel()
        self.inside = np.zeros(len(step), np.uint8)
        for s, m in enumerate(mark):
            self.inside[back[block[s]]] = m
        grid = self.table.reshape(-1, 256)
        self.reset = (grid == 0).all(axis=0)  # bytes that lead every state to the start
        self.reverse = [self._backward(n) for n in nfas]

    @staticmethod
    def _backward(n: _Nfa) -> tuple[list[list[int]], list[bool]]:
        """Anchored automaton of the reversed rule; row -1 is the dead state, kept last."""
        into: list[list] = [[] for _ in n.edges]
        for s, out in enumerate(n.edges):
            for label, t in out:
                into[t].append((label, s))

        def closure(states):
            out, todo = set(states), list(states)
            while todo:
                for label, t in into[todo.pop()]:
                    if label is None and t not in out:
                        out.add(t)
                        todo.append(t)
            return frozenset(out)

        start = closure({n.accept})
        ids, todo, step, accept = {start: 0}, [start], [], []
        while todo:
            state = todo.pop(0)
            row = []
            for b in range(256):
                new = closure({t for s in state for label, t in into[s] if label is not None and b in label})
                if not new:
                    row.append(-1)
                    continue
                if new not in ids:
                    ids[new] = len(ids)
                    todo.append(new)
                row.append(ids[new])
            step.append(row)
            accept.append(n.start in state)
        return step, accept

    def states(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``inside`` after each byte; every text begins in the start state."""
        n = len(data)
        out = np.zeros(n, np.uint8)
        if not n:
            return out
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        cut[1:] |= self.reset[data]
        at = np.flatnonzero(cut[:-1])
        size = np.diff(np.append(at, n))
        order = np.argsort(-size, kind="stable")
        at, size = at[order], size[order]
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")  # segments longer than step
        state = np.zeros(len(at), np.int64)
        table, inside = self.table, self.inside
        for step, m in enumerate(alive.tolist()):
            if m < 24:  # a few long segments are left: byte by byte
                flat, marks = table.tolist(), inside.tolist()
                for i in range(m):
                    lo, hi, s = int(at[i]) + step, int(at[i]) + int(size[i]), int(state[i])
                    got = bytearray(hi - lo)
                    for j, b in enumerate(data[lo:hi].tobytes()):
                        s = flat[s << 8 | b]
                        got[j] = marks[s]
                    out[lo:hi] = np.frombuffer(bytes(got), np.uint8)
                break
            pos = at[:m] + step
            moved = table[state[:m] * 256 + data[pos]]
            state[:m] = moved
            out[pos] = inside[moved]
        return out

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, rule, start byte, end byte) of every match long enough, in the whole batch's bytes."""
        inside, found = self.states(data, offsets), []
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        for r, rule in enumerate(self.rules):
            on = (inside >> r & 1).astype(bool)
            first, last = on.copy(), on.copy()
            first[1:] &= ~on[:-1] | edge[1:-1]
            last[:-1] &= ~on[1:] | edge[1:-1]
            ends = np.flatnonzero(last) + 1
            tail = ends - np.flatnonzero(first)
            text = np.searchsorted(offsets, ends - 1, "right") - 1
            floor = np.maximum(offsets[text], np.concatenate([[0], ends[:-1]])) if len(ends) else ends
            step, accept = self.reverse[r]
            for i in np.flatnonzero(tail >= rule.tail).tolist():
                state, start, at, stop = 0, 0, int(ends[i]), int(floor[i])
                while at > stop:
                    state = step[state][int(data[at - 1])]
                    if state < 0:
                        break
                    at -= 1
                    if accept[state]:
                        start = at
                found.append((int(text[i]), r, start, int(ends[i])))
        return found


def find_secrets(docs: DataFrame, rules=ALL_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col`` and ``spans``, an array of (start, kind, end) by start, then rule order."""
    machine = Automaton(rules)

    def run(batches):
        kinds = [r.kind for r in machine.rules]
        for batch in batches:
            for part in textkit.row_blocks(batch, "_text", 2 << 20):
                data, offsets = textkit.utf8_buffers(part.column(1))
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                spans: list[list] = [[] for _ in range(part.num_rows)]
                for t, r, a, b in machine.scan(data, offsets):
                    base = chars[offsets[t]]
                    spans[t].append((int(chars[a] - base), r, int(chars[b] - base)))
                rows = [[{"start": a, "kind": kinds[r], "end": b} for a, r, b in sorted(s)] for s in spans]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.struct(
                    [("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])))], names=[id_col, "spans"])

    rows = docs.select(id_col, F.col(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<start: long, kind: string, end: long>>")


def redact(docs: DataFrame, rules=ALL_RULES, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """The same rows and columns with every found span replaced by ``mark`` (overlapping spans by one); ``n_chars`` follows."""
    machine = Automaton(rules)
    names = docs.columns

    def run(batches):
        where = names.index(text_col)
        for batch in batches:
            for part in textkit.row_blocks(batch, text_col, 2 << 20):
                data, offsets = textkit.utf8_buffers(part.column(where))
                spans: dict[int, list] = {}
                for t, _, a, b in machine.scan(data, offsets):
                    spans.setdefault(t, []).append((a, b))
                if spans:
                    texts = part.column(where).to_pylist()
                    raw = data.tobytes()
                    for t, found in spans.items():
                        out, at = [], int(offsets[t])
                        for a, b in sorted(found):
                            if a >= at:
                                out += [raw[at:a], mark.encode()]
                            at = max(at, b)
                        texts[t] = b"".join([*out, raw[at:int(offsets[t + 1])]]).decode()
                    part = part.set_column(where, part.schema.field(where), pa.array(texts, part.schema.field(where).type))
                yield part

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast("long")) if "n_chars" in names else out


def secret_digests(docs: DataFrame, rules=ALL_RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """doc_id, n_<kind> of the first ``base`` rules and base_sha256 of their spans, and the spans of all rules as text."""
    found = find_secrets(docs, rules)
    names = [r.kind for r in rules[:base]]
    show = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    basic = F.filter("spans", lambda s: s["kind"].isin(names))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of(k) for k in names]
    return found.select("doc_id", *counts, F.sha2(show(basic), 256).alias("base_sha256"), show(F.col("spans")).alias("spans"))
