"""Operator 4: quality classifier on random-indexing word vectors.

Random indexing: every token bucket has a fixed sparse index vector of few +1
and -1; a token's vector is the sum of its neighbours' index vectors over the
whole corpus, scaled to length one, plus its own index vector. Tokens are
letter runs, runs of signs, numbers, and marks for capitals and for words that
repeat at once; they fall into a fixed number of buckets by hash. Each task adds
up its own texts; the sums of all tasks are a table of fixed size.

A document is the mean of its tokens' vectors, weighted down by frequency,
with its length and share of repeats. A two-layer network in numpy turns that
into a logit; a temperature fitted on rows that it was not trained on
calibrates the probability.

The network is fitted on a bounded sample of labelled rows (``sample`` ids,
the first by hash, and one row of each: of repeats, that whose features hash least). Corpus sums cover all texts, and every text is
read whole and scored.

Defined cases: null and empty texts are the zero vector with length 0. Labels
other than 0 and 1, null labels and null ids train nothing; without both labels
every score is the share of label 1 (one half without any). Repeated rows
score alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import chunks, crc_bucket, id_and_text, materialise, table, tidy, tidy_group
from tally.llm.wordmemo import WordMemo

BUCKETS, DIMENSIONS, NONZERO = 4096, 64, 4
#: Buckets of the marks; words hash to the rest.
REPEAT, CAPITALS, NUMBER, MARKS = 0, 1, 2, 8
#: Labelled rows used to fit the network.
SAMPLE_ROWS = 20_000
#: Frequencies well above this are weighted down.
COMMON = 0.01
HIDDEN, EPOCHS, BATCH = 32, 40, 256
ROWS_PER_PART = 256
#: Groups of tasks whose sums are added first.
SALTS = 512

_PARTS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def token_buckets(words: Sequence[str]) -> list[list[int]]:
    """Buckets of each word's tokens."""
    out = []
    for w in words:
        ids = []
        for t in _PARTS.findall(w):
            if t[0].isdigit():
                ids.append(NUMBER)
                continue
            if len(t) > 1 and t.isupper():
                ids.append(CAPITALS)
            ids.append(MARKS + xxhash.xxh32_intdigest(t.lower()) % (BUCKETS - MARKS))
        out.append(ids)
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of each bucket's nonzero entries; the same everywhere."""
    rng = np.random.default_rng(17)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def streams(memo: WordMemo, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all tokens, tokens of each text); immediate repeats are marked."""
    ids, lengths = memo.texts(column)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = ids.copy()
    for back in (1, 2):
        same = np.zeros(len(ids), bool)
        same[back:] = (ids[back:] == ids[:-back]) & (place[back:] >= back)
        out[same] = REPEAT
    return out, lengths


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of neighbours' index vectors and its token counts, in packed rows."""
    memo = WordMemo(token_buckets)
    places, signs = index_vectors()
    sums, counts = np.zeros(BUCKETS * DIMENSIONS), np.zeros(BUCKETS)
    for whole in batches:
        for b in chunks(whole):
            ids, lengths = streams(memo, b.column(1))
            counts += np.bincount(ids, minlength=BUCKETS)
            ends = np.cumsum(lengths)
            inner = np.ones(len(ids), bool)
            inner[ends[lengths > 0] - 1] = False  # a text's last token has no right neighbour
            left, right = ids[:-1][inner[:-1]], ids[1:][inner[:-1]]
            for own, other in ((left, right), (right, left)):
                for k in range(NONZERO):
                    sums += np.bincount(own * DIMENSIONS + places[other, k], weights=signs[other, k],
                                        minlength=BUCKETS * DIMENSIONS)
    full = np.concatenate([sums.reshape(BUCKETS, DIMENSIONS), counts[:, None]], 1)
    parts = range(0, BUCKETS, ROWS_PER_PART)
    salt = TaskContext.get().partitionId() % SALTS
    yield pa.record_batch([pa.array([p for p in parts], pa.int32()), pa.array([salt] * len(parts), pa.int32()),
                           pa.array([full[p:p + ROWS_PER_PART].tobytes() for p in parts], pa.binary())],
                          names=["part", "salt", "sums"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(ROWS_PER_PART * (DIMENSIONS + 1))
    for x in pdf["sums"]:
        total += np.frombuffer(x)
    return pd.DataFrame([(pdf["part"].iloc[0], pdf["salt"].iloc[0], total.tobytes())], columns=["part", "salt", "sums"])


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(vector of each bucket, weight of each bucket) from all texts.

    What reaches the driver has a fixed size whatever the corpus. The tasks'
    sums are added in two steps, so that no group takes those of all tasks.
    """
    kind = "part int, salt int, sums binary"
    rows = (docs.mapInArrow(tidy(_gather), kind).groupBy("part", "salt").applyInPandas(tidy_group(_add), kind)
            .groupBy("part").applyInPandas(tidy_group(_add), kind).collect())
    full = np.zeros((BUCKETS, DIMENSIONS + 1))
    for r in rows:
        full[r["part"]:r["part"] + ROWS_PER_PART] = np.frombuffer(r["sums"]).reshape(-1, DIMENSIONS + 1)
    sums, counts = full[:, :-1], full[:, -1]
    vectors = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    places, signs = index_vectors()
    np.add.at(vectors, (np.arange(BUCKETS)[:, None], places), signs / np.sqrt(NONZERO))
    return vectors.astype(np.float32), (COMMON / (COMMON + counts / max(counts.sum(), 1.0))).astype(np.float32)


def pool(docs: DataFrame, vectors: np.ndarray, weights: np.ndarray) -> DataFrame:
    """doc_id and features (array of float) of every row: weighted mean vector, log length, share of repeats."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordMemo(token_buckets)
        scaled = vectors * weights[:, None]
        for whole in batches:
            for b in chunks(whole):
                ids, lengths = streams(memo, b.column(1))
                ends = np.cumsum(lengths)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                out = np.zeros((len(lengths), DIMENSIONS + 2), np.float32)
                for a in range(0, len(lengths), 256):  # count vectors of so many texts at a time
                    e = min(a + 256, len(lengths))
                    part = slice(ends[a] - lengths[a], ends[e - 1])
                    n = np.bincount((doc[part] - a) * BUCKETS + ids[part], minlength=(e - a) * BUCKETS)
                    n = n.reshape(e - a, BUCKETS).astype(np.float32)
                    out[a:e, :DIMENSIONS] = n @ scaled / np.maximum(n @ weights, 1e-9)[:, None]
                    out[a:e, DIMENSIONS + 1] = n[:, REPEAT] / np.maximum(lengths[a:e], 1)
                out[:, DIMENSIONS] = np.log1p(lengths)
                at = np.arange(0, out.size + 1, DIMENSIONS + 2, dtype=np.int32)
                yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(out.ravel()))],
                                      names=["doc_id", "features"])
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, features array<float>")


@dataclass(frozen=True)
class Network:
    """Standardised input, one hidden layer of tanh, a logit and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """Fit the network by Adam on four fifths of the rows and the temperature on the rest."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    width = x.shape[1] if x.ndim == 2 else DIMENSIONS + 2
    if len(y) < 10 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(p / (1 - p))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = len(y) - max(1, len(y) // 5)
    fit, rest = order[:cut], order[cut:]
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z = (x - mean) / scale
    share = (y[fit].sum() + 1) / (len(fit) + 2)
    p = [rng.standard_normal((width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN),
         rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.array(np.log(share / (1 - share)))]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    step = 0
    epochs = max(EPOCHS, 4000 * BATCH // len(fit) // 10)
    for _ in range(epochs):
        rng.shuffle(fit)
        for a in range(0, len(fit), BATCH):
            r = fit[a:a + BATCH]
            h = np.tanh(z[r] @ p[0] + p[1])
            s = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30)))
            d = (s - y[r]) / len(r)
            back = np.outer(d, p[2]) * (1 - h * h)
            g = [z[r].T @ back + 1e-4 * p[0], back.sum(0), h.T @ d + 1e-4 * p[2], d.sum()]
            step += 1
            for k in range(4):
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.tanh(z[rest] @ p[0] + p[1]) @ p[2] + p[3]
    best = min(np.geomspace(0.25, 8, 61), key=lambda t: np.logaddexp(0, np.where(y[rest] > 0, -logit, logit) / t).mean())
    return Network(mean, scale, p[0], p[1], p[2], float(p[3]), float(best))


def score(pooled: DataFrame, network: Network) -> DataFrame:
    """doc_id and score of pooled rows."""
    kind = pooled.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(1).flatten(), dtype=float).reshape(b.num_rows, -1)
            yield pa.record_batch([b.column(0), pa.array(network(x))], names=["doc_id", "score"])
    return pooled.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, training, sample: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and score of every row, learnt from ``labels`` (doc_id, label) where ``training(doc_id)`` holds."""
    docs = id_and_text(docs)
    vectors, weights = word_vectors(docs)
    pooled = materialise(pool(docs, vectors, weights), "quality-pooled")
    ids = (labels.select("doc_id", F.col("label").cast("int").alias("label"))
           .filter("doc_id is not null and label in (0, 1)").filter(training(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` ids are broadcast, and one row for each, whatever its repeats, reaches the driver.
    rows = (pooled.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label")
            .agg(F.min_by("features", F.xxhash64("features")).alias("features")).toPandas())
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), DIMENSIONS + 2)
    return score(pooled, train(x, rows["label"].to_numpy()))


def training_row(doc_id):
    """Rows whose labels may be learnt from."""
    return crc_bucket(doc_id, 5) != 0


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: score of every document, learnt from the rows not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    out = classify(table(spark, sf_dir, "documents"), labels, training_row)
    return out.select("doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
