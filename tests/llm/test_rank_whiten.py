"""Ranked lexical search over K2-treaps and block-matrix whitening against plain versions."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from cohortlens.llm import block_whitening, storage, textkit, treap_search
from helpers import SF

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        want, scores = Counter(terms(text)), []
        for doc, c, n in held:
            m = 75 + 25 * n * n_docs // total
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, times in want.items() if t in c)
            if s > 0:
                scores.append((-s, doc if doc is not None else float("inf"), doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return out


def found(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_treap_round_trip_and_paths():
    rng = np.random.default_rng(5)
    for n_rows, n_docs, cells in ((1, 1, 1), (1, 9, 5), (300, 3, 200), (17, 40, 400), (64, 64, 1000)):
        cell = np.unique(rng.integers(0, n_rows * n_docs, cells))
        row, doc = np.divmod(cell, n_docs)
        impact = rng.integers(1, 10**6, len(cell))
        treap = treap_search.Treap.unpack(*treap_search.Treap.build(row, doc, impact, n_rows, n_docs).pack())
        want = dict(zip(zip(row.tolist(), doc.tolist()), impact.tolist()))
        r_all, d_all = sum(s[0] for s in treap.steps), sum(s[1] for s in treap.steps)
        assert treap.maxima[0][0] == impact.max()
        for r in range(n_rows):
            for d in range(n_docs):
                node, r_left, d_left, above = 0, r_all, d_all, treap.maxima[0][0]
                for level, (rb, db) in enumerate(treap.steps):
                    quadrant = 0
                    if rb:
                        r_left -= 1
                        quadrant = r >> r_left & 1
                    if db:
                        d_left -= 1
                        quadrant = quadrant << 1 | (d >> d_left & 1)
                    node = int(treap.child(level, np.array([node]), np.array([quadrant]))[0])
                    if node < 0:
                        break
                    assert treap.maxima[level + 1][node] <= above
                    above = treap.maxima[level + 1][node]
                assert (above if node >= 0 else None) == want.get((r, d))


def test_descent_opens_few_states_where_bounds_differ():
    """One document far above the others: the search does not look at all of them."""
    n = 4096
    treap = treap_search.Treap.build(np.zeros(n, np.int64), np.arange(n), np.where(np.arange(n) == 1234, 900, 10), 1, n)
    items = treap_search.Items(np.array([7], np.uint64), np.array([0, 1]))
    items.weight = items.times
    best = treap_search.Best(1, 1)
    opened = treap_search.descend(treap, np.arange(n), np.zeros(1, np.int64), items, best, beam=1)
    assert (best.doc[0, 0], best.score[0, 0]) == (1234, 900) and opened <= 24


def test_terms_as_the_pattern_finds_them():
    texts = ["Ab-c1 Äb x", None, "", "...", "a\x00b C", "end"]
    data, offsets = textkit.utf8_buffers(pa.array(texts))
    words, at = treap_search.term_hashes(data, offsets)
    assert np.diff(at).tolist() == [len(terms(t)) for t in texts]
    again, _ = treap_search.term_hashes(*textkit.utf8_buffers(pa.array([" ".join(terms(t)) for t in texts])))
    assert (words == again).all()


def test_slices_do_not_change_hashes(monkeypatch):
    data, offsets = textkit.utf8_buffers(pa.array(["alpha beta " * 50 + "x" * 300, "gamma"]))
    whole = treap_search.term_hashes(data, offsets)[0]
    monkeypatch.setattr(textkit, "SLICE_BYTES", 40)
    assert (treap_search.term_hashes(data, offsets)[0] == whole).all()


ODD = [(1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, "... --"), (None, "a b c"), (7, "c " * 30000 + "zeta"), (8, "Z" * 200000),
       (1, "a a b"), (9, "zeta zeta zeta c")]
ASKED = [(10, "A b zeta"), (11, None), (12, ""), (13, "c c c"), (None, "zeta"), (15, "nowhere")]


@pytest.mark.parametrize("parts", [1, 3])
def test_odd_rows(spark, parts):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in ODD], "doc_id long, text string, score int, rank string").repartition(parts)
    items = spark.createDataFrame([(i, t, 1) for i, t in ASKED], "item_id long, text string, item int")
    got = treap_search.ranked(docs, items, storage.work_folder(spark, "t"), k=3, item_words=4)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_ranking(ODD, ASKED, 3), key=key)


def test_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found(E.queries()["op13_treap_search"](spark, SF)) == sorted(plain_ranking(docs, items))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    ask = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs, items), (docs, ask), (some, items)):
        assert treap_search.ranked(d, i, storage.work_folder(spark, "t")).collect() == []
    assert block_whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>"),
                                  storage.work_folder(spark, "t")).collect() == []


def plain_whitening(rows, k):
    ids = [i for i, _ in rows]
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    values, axes = values[order], axes[:, order]
    return ids, n, ((n * x - s) ** 2).sum(1), (x - s / n) @ axes / np.sqrt(values), values / (centred**2).sum() * n


def check_whitening(df, rows, k):
    got = df.toPandas().sort_values(["vec_id", "component"], kind="stable")
    ids, n, deviation, white, explained = plain_whitening(rows, k)
    order = np.argsort(ids, kind="stable")
    assert len(got) == len(rows) * k and (got.n == n).all()
    assert (got.deviation.to_numpy().reshape(-1, k) == deviation[order][:, None]).all()
    mine = got.whitened.to_numpy().reshape(-1, k)
    sign = np.sign((mine * white[order]).sum(0))
    assert np.abs(mine * sign - white[order]).max() < 1e-9
    assert np.abs(got.explained.to_numpy().reshape(-1, k) - explained).max() < 1e-9
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_of_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(E.queries()["op12_block_whitening"](spark, SF), rows, 4)


def test_whitening_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(block_whitening, "ROWS", 16)
    monkeypatch.setattr(block_whitening, "COLS", 4)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=10).tolist()) for i in range(50)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # a hot vector counts once
    bad = [(900, None), (901, [1.0] * 9 + [None]), (902, [float("nan")] * 10), (903, [float("inf")] * 10), (904, [0.5, 0.5]), (905, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, x string").repartition(5)
    check_whitening(block_whitening.whiten(df, storage.work_folder(spark, "t"), k=4), rows, 4)


def test_whitening_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<double>")
    got = block_whitening.whiten(one, storage.work_folder(spark, "t")).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got] == \
        [(i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)]
    line = spark.createDataFrame([(1, [0.0, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<double>")
    got = block_whitening.whiten(line, storage.work_folder(spark, "t")).orderBy("vec_id", "component").collect()
    assert [abs(r.whitened) if r.whitened is not None else None for r in got] == [1.0, None, 1.0, None]
