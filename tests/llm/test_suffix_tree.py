import math
import random
import re
import zlib
from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tally.llm.common import crc_bucket
from tally.llm.suffix_tree import ADD, Chunk, Tree, _chunked, _sums, score, unpack

DOC = "doc_id long, text string, score double, held_out string, chunk long, n_known long"
SMALL = Tree(depth=3, min_count=3, divergence=0.2, parent=(4.0, 2.0, 1.0), chunk_bytes=300)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def tokens(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["\n"]


def brute(docs, tree):
    """Rows from n-gram counts in plain dictionaries."""
    train = [tokens(t) for i, t, *_ in docs if not held(i)]
    grams = Counter(tuple(x[j:j + k]) for x in train for k in range(1, tree.depth + 2) for j in range(len(x) - k + 1))
    n = sum(map(len, train))
    vocabulary = sum(len(g) == 1 for g in grams)

    def chances(past, w, own):
        """p(w | the last k words of past) for every k."""
        p = [(max(grams[(w,)] - own, 0) + ADD) / (max(n - own, 0) + ADD * (vocabulary + 1))]
        for k in range(1, len(past) + 1):
            s = tuple(past[-k:])
            if grams[s] < tree.min_count:
                break
            weight = tree.parent[k - 1]
            p.append((max(grams[(*s, w)] - own, 0) + weight * p[-1]) / (max(grams[s] - own, 0) + weight))
        return p

    gain = Counter()
    for x in train:
        for j, w in enumerate(x):
            p = chances(x[max(0, j - tree.depth):j], w, 1)
            for k in range(1, len(p)):
                gain[tuple(x[j - k:j])] += round(1000 * math.log(p[k] / p[k - 1]))
    states = {()}
    for s in sorted(gain, key=len):
        if s[1:] in states and gain[s] >= tree.divergence * 1000:
            states.add(s)
    rows = []
    for i, text, *_ in docs:
        x, base, model = tokens(text), 0.0, 0.0
        for j, w in enumerate(x):
            past = x[max(0, j - tree.depth):j]
            p = chances(past, w, 0)
            k = max(k for k in range(len(p)) if all(tuple(past[len(past) - d:]) in states for d in range(k + 1)))
            base, model = base + math.log10(p[0]), model + math.log10(p[k])
        rows.append((i, held(i), len(x), sum(grams[(w,)] > 0 for w in x), n, base, model))
    return rows, states


def found(spark, docs, tree, **more):
    df = score(spark.createDataFrame(docs, DOC).repartition(3), crc_bucket(F.col("doc_id"), 10) == 0, tree, **more)
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return [tuple(r) for r in df.collect()]


def same(got, want):
    def order(r):
        return r[0] is None, r[0] or 0, r[2], r[5]
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "cat", "Sat", "on", "É"]
    follow = {(v, w): rng.choices(words, k=2) for v in words for w in words}
    docs = []
    for k in range(n):
        x = rng.choices(words, k=2)
        for _ in range(rng.randint(0, 60)):
            x.append(rng.choice(follow[x[-k % 3 - 1] if len(x) > 3 else x[-2], x[-1]]) if rng.random() < 0.8
                     else rng.choice(words))
        docs.append((k, " ".join(x), 0.0, "x", 7, 1))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    want, states = brute(docs, SMALL)
    assert {len(s) for s in states} == {0, 1, 2, 3}
    assert any(abs(r[5] - r[6]) > 1 for r in want)
    same(found(spark, docs, SMALL), want)
    same(found(spark, docs, SMALL, bucket_keys=20), want)  # many buckets


def test_odd_rows(spark):
    docs = corpus(3, 12) + [
        (100, None, None, None, None, None), (101, "", 0.0, "", 0, 0), (102, " \t\n\x0b\x0c\r ", 0.0, "", 0, 0),
        (None, "the cat sat", 0.0, "", 0, 0), (None, "the cat sat", 0.0, "", 0, 0), (5, "another the cat", 0.0, "", 0, 0),
        (103, "the cat sat on\u0085mat \x1c x", 0.0, "", 0, 0), (104, "the cat sat on a mat " * 3_000, 0.0, "", 0, 0)]
    want, _ = brute(docs, SMALL)
    same(found(spark, docs, SMALL), want)


def test_no_training_rows_and_empty_table(spark):
    docs = [(i, "some text here", 0.0, "", 0, 0) for i in range(300) if held(i)]
    assert len(docs) > 5
    same(found(spark, docs, SMALL), brute(docs, SMALL)[0])
    assert found(spark, [], SMALL) == []


def test_foretells_held_out_better(spark):
    rows = found(spark, corpus(5, 300), Tree(chunk_bytes=2_000))
    out = [r for r in rows if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out) + 10


def asked_of(parts, tree, bits=1):
    """Scores in the order of the documents, and the n-grams that the chunks asked about in every round.

    ``parts`` holds (id, text) of each chunk's documents; the exchange is played through without Spark.
    """
    rows = []
    for part in parts:
        b = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in part], "text": [t for _, t in part],
                                        "held_out": [held(i) for i, _ in part]})
        rows += [r for c in _chunked([b], 1 << 20) for r in c.to_pylist()]
    rows = [r | {"chunk": j} for j, r in enumerate(rows)]
    train, root, counts = sum(r["train"] for r in rows), None, []
    for k in range(tree.depth + 2):
        asked = pd.concat([Chunk(r, k, tree).question(k, root or (train, 0), bits) for r in rows])
        told = [_sums(g, bits) for _, g in asked.groupby("bucket")]
        told = pd.concat(told) if told else pd.DataFrame([], columns=["chunk", "bucket", "totals", "seen"])
        if k == 0:
            root = (float(train), float(told["seen"].sum()))
        for j, r in enumerate(rows):
            r[f"blocks{k}"] = told[told["chunk"] == j].sort_values("bucket").to_dict("records")
        grams = told[(told["chunk"] >= 0) & (told["bucket"].astype(int).to_numpy() >> bits == 0)]
        counts.append(sum(len(unpack(t, 1)[0]) for t in grams["totals"]))
    return [float(v) for r in rows for v in Chunk(r, tree.depth + 2, tree).scores(root)[2]], counts


def agrees(parts, tree):
    got, counts = asked_of(parts, tree)
    want, _ = brute([d for part in parts for d in part], tree)
    assert got == pytest.approx([r[6] for r in want], rel=1e-9)
    return counts


def test_asks_nothing_of_n_grams_that_do_not_branch():
    passage = " ".join(f"p{j}" for j in range(30))
    parts = [[(10 * c + j, passage) for j in range(3)] for c in range(6)]
    counts = agrees(parts, SMALL)
    # Six chunks, 30 words and the end; one after each word; longer ones all follow from these.
    assert counts[:4] == [6 * 31, 6 * 30, 0, 0]


def test_asks_nothing_of_n_grams_with_a_part_in_no_other_chunk():
    rng = random.Random(4)
    parts = [[(10 * c + j, " ".join(f"{c}w{rng.randrange(4)}" for _ in range(80))) for j in range(3)] for c in range(5)]
    counts = agrees(parts, SMALL)
    # Words are a chunk's own but for the end, and so is each n-gram after them.
    assert counts[:4] == [5 * 5, 0, 0, 0]


@pytest.mark.parametrize("seed", [6, 7])
def test_asked_n_grams_and_rules_agree_with_brute_force(seed):
    docs = corpus(seed, 90) + [(k, "a mat that only this text has and this text only has", 0.0, "", 0, 0) for k in range(100, 130)]
    parts = [[d[:2] for d in docs[c::4]] for c in range(4)]
    counts = agrees(parts, SMALL)
    assert all(counts[:4])
