"""Plain counterparts the operators are tested against."""

import random

import pytest

ODD_TEXTS = [
    None, "", " ", "\n", "one", "two words", "a b c d e", "A B c d E", "tab\tand\x0bfeed\x0c", "  two  spaces ", "line\n\nline\n",
    "<|endoftext|> inside<|endoftext|>", "naïve Ünïcode ſtrange İ ǅ", "日本語 テキスト", "é à", "a b   c", "nul\x00 inside",
    "don't it's I'LL", "12 345 6.7!", "word " * 3000, "x" * 5000,
]


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(nodes, links):
    """Smallest reachable node of every node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def prose(seed, n_words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n_words))


def changed(text, seed, n):
    """A copy with ``n`` words replaced."""
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.randrange(10**9)}"
    return " ".join(w)


def tokenizer_path(name):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path(name)
