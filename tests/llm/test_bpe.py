"""Encoding and decoding against the tokenizers library (operators 2 and 10)."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from helpers import SF, word_bpe

from cohortlens.llm import bpe_lexicon, registry, storage, token_files
from cohortlens.llm.bpe_text import LibraryEncoder

registry.load_all()
ODD = ["", "Hello World's  a\x1cb   x́ ÉÈ ΣΑΣ İx 12 ½² ａb   z", "a" * 3000, "ab" * 2000 + "!!!???" * 50,
       "<|endoftext|>hi <|startoftext|> x<|endoftext|", "日本語 한국어 😀😀", "\x1c\x1d a", "don't we'll I'M"]


@pytest.fixture(scope="module")
def bpe():
    return word_bpe()


@pytest.mark.parametrize("kind", ["library", "lexicon"])
def test_encoders_equal_the_library(bpe, kind):
    model, library = bpe
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("aaabcdeEÉß' \n\t.!1é's日́ſŉ\x85\xa0") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    encoder = LibraryEncoder(model) if kind == "library" else bpe_lexicon.LexiconEncoder(model, None)
    flat, at = encoder.encode(texts)
    for text, ids in zip(texts, np.split(flat, at[1:-1])):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        if kind == "lexicon":
            assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_automaton_is_minimal_and_exact():
    rng = random.Random(4)
    words = list({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))).encode() for _ in range(2000)})
    entries = [(w, (i,) * (1 + i % 3)) for i, w in enumerate(words)]
    a = bpe_lexicon.Automaton(bpe_lexicon.compile_automaton(entries))
    place = a.places([*words, b"zz", b"abcdabcdab", b"e"])
    assert (place[-3:] == -1).all() and sorted(place[:-3]) == list(range(len(words)))
    for p, (_, ids) in zip(place, entries):
        assert tuple(a.ids_of(np.array([p]))[0]) == ids
    states = {(a.final[n], tuple((k & 255, t) for k, t in zip(a.arc_key, a.arc_target) if k >> 8 == n)) for n in range(len(a.final))}
    assert len(states) == len(a.final)  # no two states have the same future
    empty = bpe_lexicon.Automaton(bpe_lexicon.compile_automaton([]))
    assert empty.places([b"a"]).tolist() == [-1]


def test_op2_query(spark, bpe):
    _, library = bpe
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    got = registry.QUERIES["op2_bpe_lexicon"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op2_edges(spark, bpe):
    model, library = bpe
    rows = [(1, None, 0), (2, "", 1), (2, "same id", 2), (None, "x" * 50000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    lexicon = bpe_lexicon.build_lexicon(docs, model, storage.work_folder(spark, "t"))
    got = bpe_lexicon.encode_documents(docs, model, lexicon).collect()
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows)
    assert sorted(r.n_tokens for r in got) == want
    none = docs.limit(0)
    assert bpe_lexicon.build_lexicon(none, model, storage.work_folder(spark, "t")) is None
    assert bpe_lexicon.encode_documents(none, model, None).count() == 0


def test_op10_query(spark, bpe):
    _, library = bpe
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = {r.doc_id: r for r in registry.QUERIES["op10_token_files"](spark, SF).collect()}
    start = 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        r = got.pop(i)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_op10_edges_and_selective_reads(spark, bpe):
    model, _ = bpe
    docs = spark.createDataFrame([(3, "b", 9), (1, None, 9), (2, "", 9), (None, "a", 9), (3, "b", 9)], "doc_id long, text string, start int")
    folder = storage.work_folder(spark, "t")
    token_files.write_token_files(docs, folder, model)
    rows = token_files.token_digests(spark, folder).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 2), (1, 2, 1), (2, 3, 1), (3, 4, 2), (3, 6, 2)]
    some = token_files.read_token_files(spark, folder, ("doc_id", "n_tokens"), "doc_id = 3")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 2 and "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan
    folder = storage.work_folder(spark, "t")
    token_files.write_token_files(docs.limit(0), folder, model)
    assert token_files.token_digests(spark, folder).count() == 0


def test_words_met_again_outlive_a_full_table(bpe, monkeypatch):
    """The table keeps words that later batches held; ids stay those of the library."""
    from cohortlens.llm import bpe_text
    model, library = bpe
    monkeypatch.setattr(bpe_text, "TABLE_WORDS", 60)
    encoder, learned = LibraryEncoder(model), []
    learn = encoder._learn
    encoder._learn = lambda new: (learned.extend(new), learn(new))
    for n in range(30):
        texts = ["always here <|endoftext|> again " + " ".join("new" + chr(97 + n % 26) * (2 + i) for i in range(12)), "", "日 本"]
        flat, at = encoder.encode(texts)
        assert [x.tolist() for x in np.split(flat, at[1:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [learned.count(w) for w in ("always", "here", "again")] == [1, 1, 1] and len(encoder._place) < 100
    monkeypatch.setattr(bpe_text, "TABLE_WORDS", 2)  # more words met again than half of the table
    for text in ("always here again", "a b c", "here a"):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_workers_hold_one_vocabulary_and_one_texts_words(bpe):
    """Normalising and cutting need no vocabulary, and a block's words are not all held at once."""
    import tracemalloc
    model, library = bpe
    encoder = bpe_lexicon.LexiconEncoder(model, None)
    assert encoder.library.get_vocab_size() == 0
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + n % 26)}" for i in range(1000)) for n in range(300)]
    encoder.encode(texts)
    tracemalloc.start()
    flat, at = encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert flat[:at[1]].tolist() == library.encode(texts[0], add_special_tokens=False).ids
    assert peak < 65 * 300_000, peak


def test_an_ended_task_leaves_no_words(bpe):
    from cohortlens.llm import bpe_text
    encoder = bpe_text.worker_encoder(bpe_lexicon.LexiconEncoder, bpe[0], None)
    try:
        encoder.encode(["some words of a task <|endoftext|>"])
        bpe_text.task_done()
        assert list(encoder._place) == list(encoder.special)
        assert bpe_text.worker_encoder(bpe_lexicon.LexiconEncoder, bpe[0], None) is encoder
        assert encoder.encode(["of a task"])[0].tolist() == bpe[1].encode("of a task", add_special_tokens=False).ids
    finally:
        bpe_text.task_done()
        storage.release_idle()


def test_counts_leave_a_task_in_pieces(spark, bpe, monkeypatch):
    monkeypatch.setattr(bpe_lexicon, "_PIECE_WORDS", 3)
    docs = spark.createDataFrame([("a b c d e f g É é",), (None,), ("",), ("a É g g",)], "text string").coalesce(1)
    got = {r.word: r.n for r in bpe_lexicon.word_counts(docs, bpe[0]).collect()}
    assert got == {"a": 2, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 3, "Ã©": 3}
    encoder = bpe_lexicon.LexiconEncoder(bpe[0], None)
    assert encoder.encode(["one two three four five"])[0].tolist() == bpe[1].encode("one two three four five", add_special_tokens=False).ids
