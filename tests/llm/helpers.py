"""Brute-force versions the operators are compared with."""

import re
from collections import defaultdict

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def shingle_set(text, k):
    w = words(text)
    if len(w) >= k:
        return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def jaccard_groups(rows, k, percent):
    """{id: (set size, smallest id of its group)}"""
    sets = {i: shingle_set(t, k) for i, t in rows}
    groups, holders = Groups(sets), defaultdict(list)
    for i, s in sets.items():
        shared = defaultdict(int)
        for g in s:
            for other in holders[g]:
                shared[other] += 1
            holders[g].append(i)
        for other, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                groups.join(i, other)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


MORE = [(r"gh[opsur]_[A-Za-z0-9]+", 4 + 36), (r"xox[abprs]-[A-Za-z0-9-]+", 5 + 10), (r"[rs]k_live_[A-Za-z0-9]+", 8 + 24),
        (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0), (r"-----BEGIN [A-Z ]+PRIVATE KEY-----+", 0)]


def all_secrets(text):
    """The base spans and those of the further rules."""
    out = secrets(text)
    for k, (pattern, least) in enumerate(MORE, 3):
        for m in re.finditer(pattern, text or ""):
            if len(m[0]) >= least and (k != 6 or len(m[0].rpartition(".")[2]) >= 16):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def word_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read(), Tokenizer.from_file(str(path))
