"""Texts to token ids through a table of the normalised words seen so far.

BPE never joins symbols across words, so a text's ids are its words' ids in
order.  Texts of plain Latin letters are lower-cased and cut by one pattern;
others go chunk by chunk through the library's own normalising and cutting
steps.  ``encode_words`` of a subclass gives the ids of distinct words.  The
table is emptied when it holds ``TABLE_WORDS`` words; ``LibraryEncoder`` keeps
those that a later batch held.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np

from cohortlens.llm.storage import process_cache, return_unused

#: Here str.lower(), NFC and the letter and digit classes agree between Python and the library.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\u012f\u0131-\u017f]*").fullmatch
#: The pre-tokenizer's pattern over that range, after lower-casing.
_CUT = ("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0100-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
        "|[^\\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0100-\u017f0-9\xb2\xb3\xb9\xbc-\xbe]+")
_FIND = re.compile(_CUT).findall
_FIXED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the tokenizer file's
TABLE_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class _Places(dict):
    """Place by word; a word asked for the first time takes the next place and is noted in ``new``."""

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class TextEncoder:
    """Base: word table, word cutting, special tokens.  ``tokenizer_json`` is the tokenizers file's text."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        spec = json.loads(tokenizer_json)
        # normalising and cutting only: the library's own copy of the vocabulary would take some 25 MB of every worker
        bare = {**spec, "model": {**spec["model"], "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None,
                "truncation": None, "padding": None}
        self.library = Tokenizer.from_str(json.dumps(bare))
        cut = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        self._plain = cut == [_FIXED_PATTERN]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._table = str.maketrans({chr(b): s for b, s in enumerate(byte_symbols())})
        self._clear()

    def _clear(self) -> None:
        """Only the special tokens are known."""
        self._place = _Places(zip(self.special, range(len(self.special))))
        self._size = np.ones(len(self.special), np.int64)
        self._at = np.arange(len(self.special))
        self._ids = np.array(list(self.special.values()), np.int32)
        self._again = np.ones(len(self.special), bool)

    def _forget(self) -> None:
        """Room in a full table; words are cheap to learn anew unless a subclass says otherwise."""
        self._clear()

    def rest(self) -> None:
        """Between tasks."""
        self._clear()

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) for distinct words in the byte-level alphabet."""
        raise NotImplementedError

    def spell(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self._table)

    def cut(self, text: str) -> list[str]:
        """Normalised words of a text; words of other than plain texts come marked, in the byte-level alphabet."""
        if self._special and "<" in text and self._special.search(text):
            parts = self._special.split(text)
            return list(chain.from_iterable([p] if i % 2 else self.cut(p) for i, p in enumerate(parts)))
        if self._plain and _PLAIN(text):
            return _FIND(text.lower())
        out = []
        for piece in re.findall(r"[^\t-\r ]+", text):  # bounded pieces; the library cuts at any white space
            text = self.library.normalizer.normalize_str(piece)
            out += ["\0" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def _learn(self, new: list[str]) -> None:
        ids, size = self.encode_words([w[1:] if w[0] == "\0" else self.spell(w) for w in new])
        self._at = np.concatenate([self._at, len(self._ids) + np.cumsum(size) - size])
        self._size = np.concatenate([self._size, size])
        self._ids = np.concatenate([self._ids, ids])
        self._again = np.concatenate([self._again, np.zeros(len(new), bool)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text); the words of one text at a time are held, besides their places."""
        if len(self._place) > TABLE_WORDS:
            self._forget()
        known, self._place.new, n_words = len(self._place), [], [0]

        def places():
            for text in texts:
                words = self.cut(text)
                n_words.append(len(words))
                yield map(self._place.__getitem__, words)

        place = np.fromiter(chain.from_iterable(places()), np.int32)
        self._again[place[place < known]] = True
        if self._place.new:
            self._learn(self._place.new)
            self._place.new = []
        size = self._size[place]
        end = np.cumsum(size)
        at = np.repeat(self._at[place] - (end - size), size)
        at += np.arange(len(at))
        return self._ids[at], np.concatenate([[0], end])[np.cumsum(n_words)]


class LibraryEncoder(TextEncoder):
    """Each distinct word goes through the tokenizers library's BPE model once."""

    def __init__(self, tokenizer_json: str):
        super().__init__(tokenizer_json)
        from tokenizers import Tokenizer
        spec = json.loads(tokenizer_json)
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self._model = Tokenizer.from_str(json.dumps(spec))

    def encode_words(self, words):
        got = self._model.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(got.ids, np.int32), np.bincount(np.array(got.word_ids, np.int64), minlength=len(words))

    def rest(self) -> None:
        """The words stay: the library's model is dear."""

    def _forget(self) -> None:
        """Words that no later batch held go; all go if that leaves more than half of the table."""
        keep = np.flatnonzero(self._again)
        if len(keep) > TABLE_WORDS // 2:
            return self._clear()
        words, size = list(self._place), self._size[keep]
        at = np.cumsum(size) - size
        self._place = _Places((words[i], n) for n, i in enumerate(keep.tolist()))
        self._ids = self._ids[np.arange(size.sum()) + np.repeat(self._at[keep] - at, size)]
        self._size, self._at, self._again = size, at, np.arange(len(keep)) < len(self.special)


def worker_encoder(kind: type, tokenizer_json: str, *args) -> TextEncoder:
    """One encoder for all tasks of a Python worker; another kind or lexicon takes its place."""
    cache, key = process_cache(), (kind.__name__, hash(tokenizer_json), *args)
    if cache.get("encoder_key") != key:
        cache.pop("encoder", None)
        cache["encoder"], cache["encoder_key"] = kind(tokenizer_json, *args), key
        return_unused()  # what reading the file took
    cache["encoder_busy"] = True
    return cache["encoder"]


def task_done() -> None:
    """The task's last word: its encoder stays for the next task of the stage, until another operator needs the worker;
    a table that is cheap to learn anew is emptied, since an idle worker keeps its memory as long as it lives."""
    cache = process_cache()
    cache["encoder_busy"] = False
    cache["encoder"].rest()
    return_unused()
