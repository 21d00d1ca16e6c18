"""Operator 5: toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other alphabets and
full-width forms to Latin, and digits or signs standing for a letter (1diot,
m0ron) where a letter follows. An Aho-Corasick automaton finds every lexicon
term in one pass; a term counts at the start of a word (a stem) or as a whole
word. A hit inside an exception phrase does not count. The sum of the hits'
weights, per 100 words, goes through a logistic curve to a score.

The lexicon is a given list of insults and stems mined from labelled rows;
weights are log odds. Mining and the curve use a bounded sample of labelled
rows (``sample`` rows, the first by hash of the id; ``max_terms`` terms). Of
sampled texts with the same min-wise word signature (near copies) one counts.
Scoring reads every text whole, in one pass and without a shuffle.

Defined cases: null and empty texts have no hits and the curve's score at
zero. Labels other than 0 and 1, null labels and null ids train nothing. With
no usable labels the given list, default weights and a fixed curve are used.
Repeated rows score alike; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import chunks, crc_bucket, id_and_text, table, tidy

# Insults that are always in the lexicon (whole words and plurals as stems).
INSULTS = ("idiot", "moron", "stupid", "pathetic", "loser", "scum", "trash", "worthless", "clown", "disgusting",
           "imbecile", "dumbass", "bastard", "asshole", "bitch", "fuck", "shithead", "retard", "scumbag")
# Phrases in which those words mean no insult.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "idiot proof", "idiot-proof",
              "loser bracket", "scum line", "pond scum")
# Look-alikes of Latin letters, and digits and signs used for letters.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁһӏαβεικνορτυχ", "abekmhopctyxijsdhlabeiknoptux"))
SUBSTITUTES = dict(zip("013457@$!", "oieastasi"))

_TABLE = {ord(k): v for k, v in LOOKALIKES.items()}
_SUB = re.compile(r"[013457@$!](?=[013457@$!]*[a-z])")
_WORD = re.compile(r"[^\W\d_]+")

#: Labelled rows used to mine terms and fit the curve.
SAMPLE_ROWS = 20_000
#: Mined terms at most, the weightiest first.
MAX_TERMS = 2_000
#: Weight of a given term that no sampled row holds.
DEFAULT_WEIGHT = 3.0


def fold(text: str) -> str:
    """The text as the automaton reads it."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_TABLE)
        if any("＀" <= c <= "￮" for c in text):
            text = unicodedata.normalize("NFKC", text).lower()
    return _SUB.sub(lambda m: SUBSTITUTES[m[0]], text)


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights; True marks a stem (any word that starts with it)."""

    terms: tuple[tuple[str, float, bool], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS


class Matcher:
    """Sums the weights of a lexicon's hits in a text."""

    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for term, weight, stem in lexicon.terms:
            self.auto.add_word(term, (len(term), weight, stem))
        self.size = len(lexicon.terms)
        if self.size:
            self.auto.make_automaton()
        self.exceptions = [re.compile(r"\b" + re.escape(p)) for p in lexicon.exceptions]

    def __call__(self, text: str) -> tuple[int, int, float]:
        """(words, hits, summed weight) of a text."""
        words = len(text.split())
        if not words or not self.size:
            return words, 0, 0.0
        text = fold(text)
        best: dict[int, tuple[int, float]] = {}  # of hits at one place, the longest
        for end, (n, weight, stem) in self.auto.iter(text):
            start = end - n + 1
            if start and text[start - 1].isalpha():
                continue
            if not stem and end + 1 < len(text) and text[end + 1].isalpha():
                continue
            if n > best.get(start, (0, 0))[0]:
                best[start] = (n, weight)
        if best:
            for p in self.exceptions:
                for m in p.finditer(text):
                    for at in [s for s in best if m.start() <= s < m.end()]:
                        del best[at]
        return words, len(best), sum(w for _, w in best.values())


def density(words, weight):
    """Weight per 100 words on a log scale."""
    return np.log1p(100.0 * np.asarray(weight, float) / np.maximum(np.asarray(words, float), 1.0))


def labelled_sample(docs: DataFrame, labels: DataFrame, train, rows: int) -> DataFrame:
    """doc_id, label and text of the first ``rows`` training ids by hash.

    At most ``rows`` ids are broadcast, so ``docs`` is not shuffled.
    """
    ids = (labels.select("doc_id", F.col("label").cast("int").alias("label"))
           .filter("doc_id is not null and label in (0, 1)").filter(train(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.join(F.broadcast(ids), "doc_id")


def _words(sample: DataFrame) -> DataFrame:
    """label, sig, words (distinct folded words) of each sampled row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole):
                words = [sorted(set(_WORD.findall(fold(t)))) for t in b.column(1).to_pylist()]
                yield pa.record_batch([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])
    w = sample.select("label", "text").mapInArrow(tidy(run), "label int, words array<string>")
    least = [F.expr(f"array_min(transform(words, x -> xxhash64(x, {k})))") for k in range(3)]
    return w.withColumn("sig", F.struct(*least))


def mine(sample: DataFrame, min_rows: int = 6, min_odds: float = 3.0, max_terms: int = MAX_TERMS) -> Lexicon:
    """Lexicon of the given insults and of stems that labels tell apart."""
    one = _words(sample).filter("size(words) > 0").groupBy("label", "sig").agg(F.first("words").alias("words"))
    one = one.persist()
    try:
        sizes = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        weight = lambda a, b: math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        stems = F.array_distinct(F.flatten(F.transform("words", lambda w: F.transform(
            F.sequence(F.lit(4), F.lit(9)), lambda k: F.when(F.length(w) >= k, F.substring(w, F.lit(1), k))))))
        counts = (one.select("label", F.explode(F.array_compact(stems)).alias("stem"))
                  .groupBy("stem").agg(F.sum(F.col("label")).alias("a"), F.sum(1 - F.col("label")).alias("b")))
        odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
        found = (counts.filter((F.col("a") >= min_rows) & (odds >= min_odds))
                 .withColumn("odds", odds)
                 # Rare among clean rows even at the pessimistic end.
                 .filter(F.col("b") <= 0.02 * F.col("a"))
                 .orderBy(F.desc("odds"), "stem").limit(max_terms).collect())
        given = {r["stem"]: (r["a"], r["b"]) for r in
                 one.select("label", F.explode(F.array_distinct(F.flatten(F.transform("words", lambda w: F.filter(
                     F.array(*map(F.lit, INSULTS)), lambda g: F.startswith(w, g)))))).alias("stem"))
                 .groupBy("stem").agg(F.sum(F.col("label")).alias("a"), F.sum(1 - F.col("label")).alias("b")).collect()}
    finally:
        one.unpersist()
    terms = {}
    for g in INSULTS:
        w = weight(*given[g]) if g in given and n1 and n0 else DEFAULT_WEIGHT
        if w > 0:
            terms[g] = w
    chosen: set[str] = set()
    for r in sorted(found, key=lambda r: len(r["stem"])):
        s = r["stem"]
        if not any(s[:k] in chosen or s[:k] in terms for k in range(4, len(s) + 1)):
            chosen.add(s)
            terms[s] = r["odds"]
    return Lexicon(tuple((t, round(w, 6), True) for t, w in sorted(terms.items())))


def curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a + b x))) by ridge-penalised Newton steps; b is never negative."""
    if len(x) == 0 or y.min() == y.max() or x.min() == x.max():
        return -4.0, 4.0
    m = np.stack([np.ones_like(x), x], 1)
    p = np.array([math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), 0.0])
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(m @ p, -30, 30)))
        g = m.T @ (s - y) / len(y) + ridge * np.array([0.0, p[1]])
        h = (m * (s * (1 - s) + 1e-9)[:, None]).T @ m / len(y) + np.diag([1e-9, ridge])
        step = np.linalg.solve(h, g)
        p = p - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return (float(p[0]), float(p[1])) if p[1] >= 0 else (-4.0, 4.0)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    a: float
    b: float


def _hits(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(lexicon)
        for whole in batches:
            for b in chunks(whole):
                got = [match(t or "") for t in b.column(b.schema.get_field_index("text")).to_pylist()]
                cols = np.array(got, dtype=float).reshape(-1, 3)
                yield pa.record_batch([b.column(0), pa.array(cols[:, 0].astype(np.int64)),
                                       pa.array(cols[:, 1].astype(np.int64)), pa.array(cols[:, 2])],
                                      names=[b.schema.names[0], "n_words", "n_hits", "weight"])
    return run


def fit(docs: DataFrame, labels: DataFrame, train, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn lexicon weights and curve from ``labels`` (doc_id, label) where ``train(doc_id)`` holds."""
    sample = labelled_sample(id_and_text(docs), labels, train, sample_rows)
    lexicon = mine(sample)
    got = (sample.select("label", "text").mapInArrow(tidy(_hits(lexicon)), "label int, n_words long, n_hits long, weight double")
           .toPandas())  # at most sample_rows small rows (times repeats of an id)
    a, b = curve(density(got["n_words"], got["weight"]), got["label"].to_numpy(float))
    return ToxicityModel(lexicon, a, b)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, n_words, n_hits, weight, score of every row, in one pass."""
    ids = id_and_text(docs)
    kind = ids.schema["doc_id"].dataType.simpleString()
    out = ids.mapInArrow(tidy(_hits(model.lexicon)), f"doc_id {kind}, n_words long, n_hits long, weight double")
    x = F.log1p(100.0 * F.col("weight") / F.greatest(F.col("n_words").cast("double"), F.lit(1.0)))
    return out.withColumn("score", 1.0 / (1.0 + F.exp(-(F.lit(model.a) + F.lit(model.b) * x))))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` without rows that score ``threshold`` or more; one pass, no shuffle, all columns kept."""
    lexicon, a, b = model.lexicon, model.a, model.b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(lexicon)
        for whole in batches:
            for part in chunks(whole):
                got = np.array([match(t or "") for t in part.column(part.schema.get_field_index("text")).to_pylist()],
                               dtype=float).reshape(-1, 3)
                s = 1 / (1 + np.exp(-(a + b * density(got[:, 0], got[:, 2]))))
                yield part.filter(pa.array(s < threshold))
    return docs.mapInArrow(tidy(run), docs.schema)


def training_row(doc_id):
    """Rows whose labels may be learnt from."""
    return crc_bucket(doc_id, 4) != 2


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicityModel:
    """The model for the given tables: labels.toxic of the training rows."""
    return fit(docs, table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")), training_row)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: score of every document, learnt from the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    out = score(docs, toxicity_model(spark, docs, sf_dir))
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_words", "n_hits")
