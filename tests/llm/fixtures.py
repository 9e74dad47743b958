"""Small documents and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import regex

GAP = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id string, n_lines string, sig int, part int, `Lang_Pred` int"


def rows(seed: int = 7) -> list[tuple]:
    """Documents with nulls, empty and long texts, copies, near copies,
    repeated lines and columns that the operators use for their own."""
    rng = random.Random(seed)
    vocab = {"en": [f"{a}{b}" for a in ("the", "on", "wh", "st", "ing", "er") for b in ("at", "ion", "ble", "ou", "nd", "re", "ly")],
             "de": [f"{a}{b}" for a in ("sch", "der", "ung", "zu", "ei", "ver") for b in ("keit", "heit", "ß", "ä", "ich", "en", "tz")]}
    text = lambda lang, n, per=12: "\n".join(" ".join(rng.choice(vocab[lang]) for _ in range(min(per, n - i))) + "." for i in range(0, n, per))
    out = [(lang, text(lang, rng.choice((30, 60, 150, 300)))) for lang in ("en", "de") for _ in range(25)]
    base = text("en", 400, 100)
    out += [("en", base)] * 3
    for _ in range(30):
        w = base.split(" ")
        for _ in range(rng.choice((1, 2, 8, 40))):
            w[rng.randrange(len(w))] = rng.choice(vocab["en"])
        out.append(("en", " ".join(w)))
    shared = text("de", 60)
    out += [("de", text("de", 40) + "\n" + shared + "\n" + text("de", 30)) for _ in range(6)]
    out += [("en", x) for x in ("", " \n\t ", "a", "Ab", "12 34", "a b", "a b", "x\n\nx\n", "!!! ??? ...", "the same line here again\n" * 5)]
    out += [("en", text("en", 6000, 2500)), ("en", "a" * 5000), (None, text("en", 50)), ("de", None), (None, None)]
    out += [("en", "mail bob.42@mail8.example.com or +1 (988) 555-2485, card 4111111111111111 born 1990-02-28 at 10.1.200.7 end"),
            ("de", "card 4111 1111 1111 1111 and 4111111111111112, mail bob.42@mail8.example.com <|endoftext|> It's İstanbul é ﬁ 東京  x")]
    docs = [(i, t, lang, None if i % 9 == 0 else f"src{i % 2}", None if t is None else len(t)) for i, (lang, t) in enumerate(out)]
    docs.append(docs[10])  # a row that comes twice
    docs.append((None, text("en", 40), "en", "src0", 3))
    return [(*d, "x", "y", "z", 1, 2, 3) for d in docs]


def words(t: str | None) -> list[str]:
    return [w for w in GAP.split(t or "") if w]


def components(n: int, links: list[tuple[int, int]]) -> list[int]:
    """For each of 0..n-1 the smallest number in its component."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard(docs: dict[int, str | None], size: int, a: int, b: int) -> dict[int, tuple[int, int]]:
    """(number of shingles, component) of each document, by all pairs."""
    ids = sorted(docs)
    sets = []
    for i in ids:
        w = words((docs[i] or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < size else {tuple(w[k:k + size]) for k in range(len(w) - size + 1)})
    links = [(i, j) for i in range(len(ids)) for j in range(i + 1, len(ids))
             if sets[i] and len(sets[i] & sets[j]) * b >= len(sets[i] | sets[j]) * a]
    return {i: (len(s), ids[c]) for i, s, c in zip(ids, sets, components(len(ids), links))}


def edits(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def line_words(line: str) -> list[str]:
    """Runs of letters and digits with their marks, in lower case."""
    return regex.findall(r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*", line.lower())


def dedup_lines(docs: dict[int, str | None]) -> dict[int, tuple[str | None, int, int]]:
    """(text, lines, removed lines) of each document, by the edits of all pairs of lines."""
    first: dict[tuple, tuple[int, int]] = {}
    every = [(i, k, tuple(line_words(x))) for i in sorted(docs) if docs[i] is not None for k, x in enumerate(docs[i].split("\n"))]
    for i, k, w in every:
        if w:
            first.setdefault(w, (i, k))
    keys = sorted(first, key=first.get)
    bags = [Counter(w) for w in keys]
    links = []
    for i, j in combinations(range(len(keys)), 2):
        most = max(len(keys[i]), len(keys[j])) // 5
        # each edit brings in one word that the other has more often, at most
        if abs(len(keys[i]) - len(keys[j])) <= most and max(len(keys[i]), len(keys[j])) - (bags[i] & bags[j]).total() <= most and edits(keys[i], keys[j]) <= most:
            links.append((i, j))
    keep = {keys[i]: first[keys[c]] for i, c in enumerate(components(len(keys), links))}
    gone = defaultdict(set)
    for i, k, w in every:
        if w and keep[w] != (i, k):
            gone[i].add(k)
    return {i: (t, 0, 0) if t is None else ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), t.count("\n") + 1, len(gone[i]))
            for i, t in docs.items()}
