"""Small hostile tables and brute-force versions for the tests of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, source string, n_chars int, n_words string, kept string, node string"
SPACES = "\t\n\x0b\x0c\r "


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> list[str]:
    return ["w%03d" % rng.randrange(vocabulary) for _ in range(words)]


def documents(seed: int = 5) -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, near copies, repeated rows and clashing names."""
    rng = random.Random(seed)
    base = prose(rng, 300)
    texts: list[str | None] = [None, "", " \n\t ", "one", "one two", "Élan vital, c'est ça!", "x" * 3000, "a b " * 2000, "<|endoftext|> odd\x01 <|x"]
    texts += [" ".join(base)]
    for _ in range(12):  # each within 0.9 of the base, hardly any of another
        copy = list(base)
        for at in rng.sample(range(20, 280, 12), 4):
            copy[at] = "edit%d" % rng.randrange(10**6)
        texts.append(" ".join(copy))
    shared = prose(rng, 60)
    for _ in range(8):
        texts.append(" ".join(prose(rng, 80) + shared + prose(rng, rng.randrange(5, 50))))
    line = " ".join(prose(rng, 25))
    texts += ["\n".join([" ".join(prose(rng, 20)), line, " ".join(prose(rng, 20))]) for _ in range(4)]
    texts += ["\n".join([line.replace("w1", "v1", 1), " ".join(prose(rng, 20)), line])]
    texts += [" ".join(prose(rng, n)) for n in (3, 9, 10, 11, 12, 13, 14, 26, 500)]
    texts += [texts[9], texts[30], texts[30], " ".join(prose(rng, 12) * 8)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[t], None if i % 7 == 0 else "src", None if texts[t] is None else len(texts[t]), "x", None, "y") for i, t in enumerate(order)]
    return rows + [rows[11], rows[12], (None, " ".join(base), None, None, None, None, None), (None, None, None, None, None, None, None)]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, width: int = 3) -> frozenset:
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def union_find(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]
