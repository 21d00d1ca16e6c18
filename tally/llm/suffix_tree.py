"""Operator 12: language-model scores from a probabilistic suffix tree.

The tree's states are contexts of up to ``depth`` words, read backwards from
the word to come; the root is the empty context. A context seen at least
``min_count`` times in the training texts is a candidate, and is retained if
its parent (the context without its oldest word) is and if the training
texts diverge from the parent's prediction: the log likelihood ratio of the
two next-token distributions, summed over the context's occurrences with each
occurrence left out of the counts that predict it, is at least ``divergence``
nats. (Leaving out is what keeps a rare context with many different successors
from looking sharp.) A state's distribution is smoothed by its parent's,

    p(w | state) = (count(state, w) + k * p(w | parent)) / (count(state) + k),

down to the root's, the additive unigram estimate. A token is scored by the
longest retained suffix of the words before it in its text, so the
probabilities of all tokens after any words add up to one (the root's sum
includes one unknown token).

How it is spread: the texts become chunks of some hundred thousand tokens,
each a row with its documents, its distinct words and its tokens as their
numbers. In rounds, every chunk sends the distinct n-grams it asks about to
buckets by hash, with its own training counts, and gets each one's total back
(``exchange``): words; then pairs after words that are frequent enough; then
longer n-grams after candidate contexts, together with the divergence sums of
the contexts one word shorter. An n-gram is sent once a chunk however often it
occurs, so that no frequent word is a hot key: a key's rows are at most one a
chunk. What follows from counts already told is not asked (``Chunk._level``, ``Chunk._asked``),
so that longer n-grams, of which ever more have candidate contexts as the
corpus grows, move only where the tree really branches. Nothing but the numbers of tokens and words reaches the driver, and
no part of the model is held in one place. What moves in a round is joined to
its chunk where that lies: the chunk tables are bucketed by chunk in the
shared folder, and are read back after a lost executor.

Defined cases: null text is the empty text, whose only token is the end. A
null id is a training row. Repeated rows and ids count each time and each get
their row. A single text longer than a chunk is a chunk. Without training
rows every count is zero and the distribution is even. An empty table gives no
rows. Other columns are ignored, whatever their names. Words and n-grams are
told apart by 64 bits of hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import CHUNK_BYTES, chunks, crc_bucket, id_and_text, materialise, table, tidy, tidy_group
from tally.llm.shingles import scramble, word_hashes
from tally.session import scratch_path

#: The root's additive constant.
ADD = 0.1
#: Keys of a bucket aimed at.
BUCKET_KEYS = 1_500_000
#: Most buckets of the chunk tables.
MOST_BUCKETS = 16_384
#: Divergence sums are whole numbers of this part of a nat, so that their order does not matter.
NAT = 1_000



@dataclass(frozen=True)
class Tree:
    """Parameters of the tree."""

    #: Words of the longest contexts.
    depth: int = 3
    #: Training occurrences that make a context a candidate.
    min_count: int = 8
    #: Nats by which a context must foretell better than its parent, summed over its occurrences.
    divergence: float = 4.0
    #: Weight of the parent's distribution in a state of one, two, ... words, in occurrences.
    parent: tuple[float, ...] = (300.0, 30.0, 5.0)
    #: Bytes of text in a chunk.
    chunk_bytes: int = CHUNK_BYTES


_U = np.uint64
_END = _U(xxhash.xxh64_intdigest(b"\n"))  # no word holds a line break


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, equal bytes of neighbours side by side, compressed."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, columns: int, kind=np.int64) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return [np.ascontiguousarray(p.reshape(8, -1).T).view(kind).ravel() for p in planes.reshape(columns, -1)]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit keys, place of every key among them).

    Sorts the keys with their positions in place of their last bits, which is
    several times as fast as sorting positions by key, and right unless two
    keys differ in these bits alone; then it sorts positions.
    """
    n = len(keys)
    low = _U((1 << n.bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(n, dtype=_U)) & low).astype(np.int64)
    run = keys[order]
    if (run[1:] < run[:-1]).any():
        order = np.argsort(keys)
        run = keys[order]
    new = np.ones(n, bool)
    new[1:] = run[1:] != run[:-1]
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(new) - 1
    return run[new], at


def _chunked(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Texts as chunks: ids and marks of the documents, distinct words, tokens as numbers of these."""
    for whole in batches:
        for b in chunks(whole, limit=size):
            hashes, words = word_hashes(b.column(1))
            ends = np.cumsum(words + 1) - 1
            tokens = np.full(len(hashes) + len(words), _END, _U)
            inner = np.ones(len(tokens), bool)
            inner[ends] = False
            tokens[inner] = hashes
            words_here, codes = distinct(scramble(tokens))
            held = np.asarray(b.column(2)).astype(bool)
            yield pa.record_batch([
                pa.array([b.column(0).to_pylist()], pa.list_(b.schema.field(0).type)),
                pa.array([pack(words + 1, held.astype(np.int64))], pa.binary()), pa.array([pack(words_here)], pa.binary()),
                pa.array([pack(codes)], pa.binary()), pa.array([len(tokens)], pa.int64()),
                pa.array([int((words + 1)[~held].sum())], pa.int64())],
                names=["doc_ids", "docs", "words", "codes", "tokens", "train"])


class Shared:
    """Tables bucketed by chunk under the shared folder, joined without moving."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        own = f"tally_pst_{name}_{uuid.uuid4().hex[:12]}"
        (df.repartition(self.buckets, "chunk").write.format("parquet").bucketBy(self.buckets, "chunk").sortBy("chunk")
         .option("path", scratch_path(self.spark, f"llm-pst-{name}")).saveAsTable(own))
        self.names.append(own)
        # Shuffle files of finished rounds go when their frames are collected.
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.table(own)

    def drop(self) -> None:
        """Forget the tables' names (their files lie in the scratch folder)."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def unsigned(v: np.ndarray) -> np.ndarray:
    """0, -1, 1, -2, ... as 0, 1, 2, 3, ..., so that the first bytes of small numbers are 0."""
    return (v << 1) ^ (v >> 63)


def signed(v: np.ndarray) -> np.ndarray:
    return (v >> 1) ^ -(v & 1)


def _sums(pdf: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A bucket's blocks of keys and values: the sum of each block's keys over all blocks.

    An n-gram's sum is told as one more than it is, or as 0 if its block alone asked about it.
    """
    blocks = [unpack(d, 2) for d in pdf["keys"]]
    own, place = distinct(np.concatenate([np.cumsum(b[0].view(_U)) for b in blocks]))
    total = np.zeros(len(own), np.int64)
    np.add.at(total, place, signed(np.concatenate([b[1] for b in blocks])))
    cuts = np.cumsum([len(b[0]) for b in blocks])[:-1]
    bucket = int(pdf["bucket"].iloc[0])
    seen = int((total > 0).sum())
    if bucket >> bits == 0:
        total = np.where(np.bincount(place, minlength=len(own)) == 1, 0, total + 1)
    else:
        total = unsigned(total)
    out = [(int(c), bucket, pack(total[p]), 0) for c, p in zip(pdf["chunk"], np.split(place, cuts))]
    return pd.DataFrame([*out, (-1, bucket, b"", seen)], columns=["chunk", "bucket", "totals", "seen"])


def exchange(shared: Shared, asked: DataFrame, bits: int, name: str) -> DataFrame:
    """chunk, blocks, seen: what each chunk asked about, totalled; chunk -1 has the number of keys with a total.

    ``asked`` is (chunk, bucket, keys): steps between sorted distinct keys, and values, cut into buckets by their first ``bits`` bits.
    """
    back = asked.groupBy("bucket").applyInPandas(
        tidy_group(partial(_sums, bits=bits)), "chunk long, bucket long, totals binary, seen long")
    blocks = F.sort_array(F.collect_list(F.struct("bucket", "totals"))).alias("blocks")
    return shared.write(back.repartition(shared.buckets, "chunk").groupBy("chunk")
                        .agg(blocks, F.sum("seen").alias("seen")), name)


def ask(chunk: int, keys: np.ndarray, values: np.ndarray, bits: int, kind: int = 0) -> list[tuple]:
    """Blocks of sorted keys, as steps, by their first ``bits`` bits; each kind of key has its own buckets."""
    bucket = (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys))
    values = unsigned(values)
    return [(chunk, int(bucket[a]) + (kind << bits), pack(np.diff(keys[a:b], prepend=_U(0)), values[a:b]))
            for a, b in zip(at[:-1], at[1:])]


class Chunk:
    """A chunk's tokens with what the rounds have told about them so far.

    Level k has the n-grams of k + 1 tokens that end at the tokens ``at[k]``,
    those after a candidate context of k words: ``keys[k]`` distinct ones,
    ``own[k]`` their training counts here, ``code[k]`` each token's among them,
    ``count[k]`` their counts, ``rule[k]`` those that follow from shorter ones (else
    -1) and ``alone[k]`` whether it is known that no other chunk has them.
    ``state[k]`` tells the tokens whose context of k words is a state.
    """

    def __init__(self, row, rounds: int, tree: Tree = Tree()):
        self.tree, self.chunk = tree, int(row["chunk"])
        self.lengths, held = unpack(row["docs"], 2)
        self.held = held.astype(bool)
        (words,), (codes,) = unpack(row["words"], 1, _U), unpack(row["codes"], 1)
        self.train = np.repeat(~self.held, self.lengths)
        self.last = np.cumsum(self.lengths) - 1  # every text's end
        self.at, self.key = [np.arange(len(codes))], [words[codes]]
        self.keys, self.code = [words], [codes]
        self.own = [np.bincount(codes[self.train], minlength=len(words)).astype(np.int64)]
        self.rule = [np.full(len(codes), -1)]
        self.count: list[np.ndarray] = []
        self.alone: list[np.ndarray] = []
        self.state = [np.ones(len(codes), bool)]
        for k in range(rounds):
            blocks = row[f"blocks{k}"]  # none: the chunk asked nothing
            blocks = [] if blocks is None else blocks
            self._told(k, np.concatenate([unpack(t["totals"], 1)[0] for t in blocks] or [np.zeros(0, np.int64)]))

    def _level(self, k: int) -> None:
        """The n-grams of level k, from the counts of the contexts before them."""
        if k < len(self.at) or k > self.tree.depth:
            return
        before = self.at[k - 1]
        before = before[self.count[k - 1][before] >= self.tree.min_count]
        ends = np.zeros(len(self.train), bool)
        ends[self.last] = True
        at = before[~ends[before]] + 1
        if k == self.tree.depth and k > 2:
            # The longest n-grams are no contexts, and a state's ancestors are states.
            at = at[self.state[k - 2][at]]
        # The counts follow where the context without its oldest word is always followed by this token
        # (the context is too) or always follows that oldest word (with or without it is the same), in every chunk.
        rule = np.full(len(at), -1)
        if k > 1:
            gram, context, parent = self.count[k - 1][at], self.count[k - 1][at - 1], self.count[k - 2][at - 1]
            rule = np.where(gram == parent, context, np.where(context == parent, gram, rule))
        new = at[rule < 0] if k == self.tree.depth else at
        with np.errstate(over="ignore"):
            grams = scramble(self.key[k - 1][new - 1] + self.key[0][new] * _U(0x9E3779B97F4A7C15), k)
        key, code = np.zeros_like(self.key[0]), np.zeros_like(self.code[0])
        key[new] = grams
        keys, code[new] = distinct(grams)
        self.at.append(at)
        self.rule.append(rule)
        self.key.append(key)
        self.keys.append(keys)
        self.code.append(code)
        self.own.append(np.bincount(code[new[self.train[new]]], minlength=len(keys)).astype(np.int64))

    def _asked(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of level k whose count no rule gives, their places among the keys; which keys to ask about.

        Not those of which no other chunk has the n-gram without its oldest word, or the context.
        """
        new = self.at[k][self.rule[k] < 0]
        code = self.code[k][new]
        asked = np.zeros(len(self.keys[k]), bool)
        asked[code if k == 0 else code[~(self.alone[k - 1][new] | self.alone[k - 1][new - 1])]] = True
        return new, code, asked

    def _contexts(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of level k whose context's parent is a state; which keys of level k - 1 are the contexts; places there."""
        at = self.at[k]
        at = at[self.state[k - 1][at]]
        code = self.code[k - 1][at - 1]
        asked = np.zeros(len(self.keys[k - 1]), bool)
        asked[code] = True
        return at, asked, (np.cumsum(asked) - 1)[code]

    def question(self, k: int, root: tuple[float, float], bits: int) -> pd.DataFrame:
        """Round k: training counts of level k, divergence sums of the contexts of level k - 1."""
        self._level(k)
        rows = []
        if k <= self.tree.depth:
            *_, asked = self._asked(k)
            rows += ask(self.chunk, self.keys[k][asked], self.own[k][asked], bits)
        if k > 1:
            mine, asked, place = self._contexts(k - 1)
            p = self.chances(k - 1, root, left_out=1)
            gain = np.rint(NAT * np.log(p[k - 1][mine] / p[k - 2][mine]))
            # Whole numbers, exact in double precision.
            value = np.bincount(place, np.where(self.train[mine], gain, 0), int(asked.sum())).astype(np.int64)
            rows += ask(self.chunk, self.keys[k - 2][asked], value, bits, kind=1)
        return pd.DataFrame(rows, columns=["chunk", "bucket", "keys"])

    def _told(self, k: int, totals: np.ndarray) -> None:
        """The totals of round k, in the order in which they were asked for."""
        self._level(k)
        grams = 0
        if k <= self.tree.depth:
            at, (new, code, asked) = self.at[k], self._asked(k)
            grams = int(asked.sum())
            told, only = self.own[k].copy(), np.ones(len(asked), bool)
            only[asked] = totals[:grams] == 0
            told[asked] = np.where(only[asked], told[asked], totals[:grams] - 1)
            count, alone = np.zeros(len(self.train), np.int64), np.zeros(len(self.train), bool)
            count[at] = self.rule[k]
            count[new] = told[code]
            if k:
                alone[at] = self.alone[k - 1][at] | self.alone[k - 1][at - 1]
            alone[new] = only[code]
            self.count.append(count)
            self.alone.append(alone)
        if k > 1:
            at, _, place = self._contexts(k - 1)
            state = np.zeros(len(self.train), bool)
            state[at] = signed(totals[grams:])[place] >= self.tree.divergence * NAT
            self.state.append(state)

    def chances(self, depth: int, root: tuple[float, float], left_out: int = 0) -> list[np.ndarray]:
        """p(token | the last k words) at the tokens of level k up to ``depth``, as if every context were a state.

        With ``left_out``, each training token's own occurrence is taken out of the counts.
        """
        tokens, words = root
        own = left_out * self.train
        out = [np.maximum(self.count[0] - own + ADD, ADD) / (np.maximum(tokens - own, 0) + ADD * (words + 1))]
        for k, weight in zip(range(1, depth + 1), self.tree.parent):
            at = self.at[k]
            p, mine = np.zeros_like(out[0]), own[at]
            context = np.maximum(self.count[k - 1][at - 1] - mine, 0)
            p[at] = (np.maximum(self.count[k][at] - mine, 0) + weight * out[-1][at]) / (context + weight)
            out.append(p)
        return out

    def scores(self, root: tuple[float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known tokens, base score, model score) of every document."""
        p = self.chances(self.tree.depth, root)
        base = np.log10(p[0])
        model = base.copy()
        for k in range(1, self.tree.depth + 1):
            model[self.state[k]] = np.log10(p[k][self.state[k]])
        first = self.last + 1 - self.lengths
        return tuple(np.add.reduceat(v, first) for v in ((self.count[0] > 0).astype(np.int64), base, model))


def score(docs: DataFrame, held_out, tree: Tree = Tree(), bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Scores of all texts by the tree of those that the condition ``held_out`` on doc_id is not true for."""
    spark = docs.sparkSession
    docs = id_and_text(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = Shared(spark, min(MOST_BUCKETS, 2 * docs.rdd.getNumPartitions()))
    made = docs.mapInArrow(tidy(partial(_chunked, size=tree.chunk_bytes)), f"doc_ids array<{kind}>, docs binary, words binary, codes binary, "
                                           "tokens long, train long")
    rows = shared.write(made.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    size = rows.agg(F.sum("tokens"), F.sum("train")).first()
    tokens, train = (int(v or 0) for v in size)
    bits = max(0, (-(-tokens // bucket_keys) - 1).bit_length())
    rows = rows.drop("tokens", "train")

    told: list[DataFrame] = []
    rounds = tree.depth + 2
    root = (float(train), 0.0)
    for k in range(rounds):
        known = reduce(lambda a, b: a.join(b, "chunk", "left"), told, rows)

        def question(pdf: pd.DataFrame, k=k, root=root) -> pd.DataFrame:
            return Chunk(pdf.iloc[0], k, tree).question(k, root, bits)
        asked = known.groupBy("chunk").applyInPandas(tidy_group(question), "chunk long, bucket long, keys binary")
        answer = exchange(shared, asked, bits, f"round{k}")
        if k == 0:
            # Distinct tokens with a training count.
            root = (float(train), float(answer.filter("chunk = -1").agg(F.sum("seen")).first()[0] or 0))
        told.append(answer.select("chunk", F.col("blocks").alias(f"blocks{k}")))

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf.iloc[0], rounds, tree)
        n_known, base, model = c.scores(root)
        return pd.DataFrame({"doc_id": list(pdf["doc_ids"].iloc[0]), "held_out": c.held, "n_tokens": c.lengths,
                             "n_known": n_known, "train_tokens": train, "base_score": base, "score": model})
    known = reduce(lambda a, b: a.join(b, "chunk", "left"), told, rows)
    out = materialise(known.groupBy("chunk").applyInPandas(
        tidy_group(final), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double"), "pst-scores")
    shared.drop()
    return out


def op12_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: scores of every text of ``documents``, a tenth of them held out."""
    return score(table(spark, sf_dir, "documents"), crc_bucket(F.col("doc_id"), 10) == 0)
