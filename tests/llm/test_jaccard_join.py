import collections
import random
import re

import pytest

from tally.llm import jaccard_join as jj
from tally.llm.components import Forest, connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """All pairs of distinct sets, compared."""
    sets = {k: shingles(t) for k, (_, t) in enumerate(rows)}
    distinct = list({s for s in sets.values() if s})
    f = Forest()
    for i, a in enumerate(distinct):
        for j, b in enumerate(distinct[:i]):
            n = len(a & b)
            if 100 * n >= 75 * (len(a) + len(b) - n):
                f.join(i, j)
    at = {s: f.root(i) for i, s in enumerate(distinct)}
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if sets[k] and i is not None:
            ids[at[sets[k]]].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        own = ids[at[sets[k]]] if sets[k] else [i]
        out.append((i, len(sets[k]), min(own) if own else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.near_components(df).collect()), key=str)


def family(rng, size, words, change, vocabulary=3000):
    """Near copies of one text: some of its words are replaced."""
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(size):
        t = list(base)
        for _ in range(rng.randrange(change + 1)):
            t[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for size, words, change in ((40, 60, 4), (25, 30, 3), (12, 200, 12), (3, 9, 1), (2, 5, 1)):
        texts += family(rng, size, words, change)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 80))) for _ in range(60)]
    texts += ["a b c d", "A B\tc  D", "a b c", "", "  ", None, "x", "x"]
    texts += [f"alone {k} text number {k * 7} here {k}" for k in range(40)]
    texts += rng.sample([t for t in texts if t], 30)
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block,meet", [(1024, 32), (8, 2), (4, 3)])
def test_against_all_pairs(spark, monkeypatch, block, meet):
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "MEET", meet)
    rows = corpus(block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df) == brute(rows)


def test_large_group_of_unlinked_texts(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 64)
    monkeypatch.setattr(jj, "MEET", 2)

    def bounded(pdf):
        if len(pdf) > 64 * 2:
            raise ValueError(f"{len(pdf)} classes in one task")
        return jj.join_block(pdf)
    monkeypatch.setattr(jj, "_join_known", bounded)
    rng = random.Random(5)
    passages = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(40)]
    texts = [" ".join(rng.sample(passages, 4)) for _ in range(1200)]
    texts += [t + " end" for t in texts[:200]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert len({c for _, _, c in want}) > 1000
    assert result(df) == want


def test_frequent_tokens_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(jj, "HOT_TEXTS", 5)
    monkeypatch.setattr(jj, "BUCKET_TOKENS", 500)
    rows = corpus(99)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(odd_docs) == brute(rows)
    assert result(no_docs) == []
    kept = jj.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {i for i, _, c in brute(rows) if i == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_edge_of_threshold(spark):
    a = [f"t{k}" for k in range(24)]  # 20 shingles
    rows = [(0, " ".join(a)), (1, " ".join(a[:19])), (2, " ".join(a[:18])),  # 15 of 20; 14 of 20, but 14 of 15
            (10, "b c d e f g h"), (11, "b c d e f g h i"), (12, "b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows)


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_components(spark, bound):
    rng = random.Random(bound)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(1000, 1050)]
    f = Forest()
    for a, b in edges:
        f.join(a, b)
    want = {(x, f.root(x)) for x in f.up if f.root(x) != x}
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6), bound)
    assert {(r.node, r.root) for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), bound).count() == 0


def test_whole_small_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert result(spark.read.parquet(f"{small}/documents.parquet")) == brute(rows)


def test_batches_of_few_words():
    """A batch with fewer words in all than a shingle has."""
    import pyarrow as pa

    from tally.llm.shingles import shingle_sets
    for texts in ([], [""], ["one"], ["one two", None], ["a b c"], ["a b c d"], ["a", "b c d"], ["a b c d e"]):
        flat, n = shingle_sets(pa.array(texts, pa.string()))
        assert n.tolist() == [int(bool(t)) for t in texts] and len(flat) == n.sum()
