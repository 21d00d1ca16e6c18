import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tally.llm import spelling
from tally.llm.spelling import near_words, variants

DOC = "doc_id long, text string, word string, n long, key string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_near(n):
    near = defaultdict(set)
    for a in n:
        for b in n:
            if one_edit(a, b):
                near[a].add(b)
    return near


def brute(docs, min_length=5, min_count=3, every=97):
    seen = Counter()
    for i, text, *_ in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += len(w) >= min_length
    n = {w: c for w, c in seen.items() if c >= min_count}
    near = brute_near(n)
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: best[w] if w in best and n[best[w]] >= 2 * n[w] else None for w in n}

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(spark, docs, **more):
    rows = variants(spark.createDataFrame(docs, DOC), **more)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in rows.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, docs=40, letters="abé"):
    """Texts of short words over few letters: many near words, ties and chains."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(150)]
    return [(k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=80)), None, 0, "x")
            for k in range(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    want = brute(docs, every=7)
    assert len(want) > 50 and any(f for _, f, *_ in want) and any(f and r != f for _, f, r, *_ in want)
    assert found(spark, docs, every=7) == want
    # A key of more than two words is cut further, and each row has nearly its own bucket.
    assert found(spark, docs, every=7, limit=2, bucket_rows=5) == want


def test_words_and_odd_rows(spark):
    docs = [(1, "Straße STRASSE straÉe straÉe x-ray×÷ ÀÉ÷îÿ ÀÉ÷îÿ ÀÉ÷îÿ", "w", 9, "k"),
            (None, None, None, None, None), (None, "words words Words", None, 0, ""), (2, "", "", 0, ""),
            (3, "word's WORDS wordß Ÿwords āwords 12words34", "w", 1, "k"),
            (3, "word's WORDS wordß Ÿwords āwords 12words34", "w", 1, "k"),
            (4, "again " * 50_000 + "agains " * 3 + "z" * 30_000, "w", 1, "k"),
            (5, ("y" * 2_000 + " ") * 3 + ("y" * 1_999 + " ") * 9 + ("x" + "y" * 1_999 + " ") * 3, "w", 1, "k")]
    for every in (1, 97):
        assert found(spark, docs, every=every) == brute(docs, every=every)


def test_ties_and_chains(spark):
    text = " ".join(["abcde"] * 3 + ["abcdx"] * 6 + ["abcdy"] * 6 + ["abcyy"] * 12 + ["abyyy"] * 23 + ["qqqqq"] * 3)
    rows = {r[0]: r[1:] for r in found(spark, [(1, text, None, 0, "")], every=10 ** 9)}
    assert rows["abcde"] == ("abcdx", "abcdx", 3, 2, 6)      # a tie goes to the smaller word
    assert rows["abcdx"] == (None, "abcdx", 6, 2, None)       # 6 is not twice 6
    assert rows["abcdy"] == ("abcyy", "abcyy", 6, 3, 12)
    assert rows["abcyy"] == (None, "abcyy", 12, 2, None)      # 23 is not twice 12
    assert rows["qqqqq"] == (None, "qqqqq", 3, 0, None)


def test_empty_table(spark):
    assert found(spark, []) == set()


def test_hot_key_and_small_steps(spark, monkeypatch):
    """Thousands of words with one beginning, ranges looked at a few at a time."""
    rng = random.Random(3)
    n = {"commonstart" + "".join(rng.choices("abcdef", k=rng.randint(2, 5))): rng.randint(1, 50) for _ in range(1500)}
    near = brute_near(n)
    want = {(w, len(s), n[b], b) for w, s in near.items() if s for b in [min(s, key=lambda v: (-n[v], v))]}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    for limit in (60_000, 100):
        assert {tuple(r) for r in near_words(words, limit=limit).collect()} == want
    monkeypatch.setattr(spelling, "STEP", 50)
    text = np.array(sorted(w for w in n if len(w) in (14, 15)))
    zeros = np.zeros(len(text), np.int64)
    pairs = {(text[a], text[b]) for q, w in spelling.list_pairs(text, zeros, zeros + 11, 14) for a, b in zip(q, w)}
    assert pairs == {(a, b) for a in text for b in text if len(a) == 14 and one_edit(a, b)}
