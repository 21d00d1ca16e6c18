import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tally.llm import quality as q
from tally.llm.wordmemo import WordMemo


def test_streams_mark_repeats():
    ids, lengths = q.streams(WordMemo(q.token_buckets), pa.array(["the cat", "so so so", None, "a. b. b. b.", "AB 12 cd ab"]))
    assert lengths.tolist() == [2, 3, 0, 8, 5]
    assert (ids[2:5] == q.REPEAT).tolist() == [False, True, True]
    assert (ids[5:13] == q.REPEAT).tolist() == [False, False, False, True, True, True, True, True]
    assert ids[13] == q.CAPITALS and ids[15] == q.NUMBER and ids[14] == ids[17]


def test_sums_against_plain_loops(spark):
    texts = ["one two three", "two one", "", None, "three one two one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vectors, weights = q.word_vectors(q.id_and_text(df))
    places, signs = q.index_vectors()
    index = np.zeros((q.BUCKETS, q.DIMENSIONS))
    np.put_along_axis(index, places, signs, 1)
    sums, counts = np.zeros_like(index), np.zeros(q.BUCKETS)
    memo = WordMemo(q.token_buckets)
    for t in texts:
        ids, _ = q.streams(memo, pa.array([t]))
        for k, w in enumerate(ids):
            counts[w] += 1
            for n in ids[max(0, k - 1):k].tolist() + ids[k + 1:k + 2].tolist():
                sums[w] += index[n]
    want = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9) + index / np.sqrt(q.NONZERO)
    assert np.allclose(vectors, want, atol=1e-5)
    assert np.allclose(weights, q.COMMON / (q.COMMON + counts / counts.sum()))


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 6))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] * x[:, 1] + x[:, 2])))
    y = (rng.random(3000) < p).astype(float)
    net = q.train(x[:2000], y[:2000])
    got = net(x[2000:])
    assert np.mean((got - p[2000:]) ** 2) < 0.03
    one = q.train(x[:50], np.ones(50))
    assert np.allclose(one(x[:5]), 51 / 52)
    assert np.allclose(q.train(np.zeros((0, 6)), np.zeros(0))(x[:3]), 0.5)


def test_edges(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(None, 1), (4, None), (5, 3)], "doc_id long, label int")
    out = q.classify(odd_docs, labels, q.training_row).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert q.classify(no_docs, labels, q.training_row).count() == 0
    assert {r.score for r in q.classify(odd_docs, labels.limit(0), q.training_row).collect()} == {0.5}


def test_repeats_of_an_id_are_one_sampled_row(spark, monkeypatch):
    seen, train = [], q.train
    monkeypatch.setattr(q, "train", lambda x, y: seen.append((x.shape, sorted(y.tolist()))) or train(x, y))
    rows = [(1, f"text {k} of one id") for k in range(300)] + [(k, f"word {k}") for k in range(2, 9)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id long, label int")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = q.classify(df, labels, lambda c: c > 0, 4).collect()
    assert len(out) == 307 and seen[0][0][0] == 4
    q.classify(df, labels, lambda c: c > 0).collect()
    assert seen[1] == ((8, q.DIMENSIONS + 2), [0, 0, 0, 0, 1, 1, 1, 1])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = q.op4_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    acc = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert acc > 0.93
