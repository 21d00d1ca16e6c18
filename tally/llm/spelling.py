"""Operator 13: spelling variants, by dynamic programming over sorted word lists.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. Within a sorted list of words the edit matrix of a query is
worked out row by row, a row per code point of the list's words, and only the
three cells of a row that one edit can reach (the band). Neighbours in the
list share their first rows, as many as their longest common prefix has code
points, so a row is computed once for a whole range of words, and a range
whose shared prefix is already more than one edit away is skipped whole.
All queries of a list go down together, one numpy step per depth.

Lists are made by what a near pair must share. Cut the shorter word's ``m``
places into two windows: the edit lies in one of them, so the rest is equal.
A word of length m gives a row for each window of m and, as a longer partner,
for each window of m - 1: four rows, whose key is the word without the
window. Rows of equal keys meet in one bucket and are sorted so that the
shared part comes first (words are turned round where it is at their end).
A pair counts in the window of its first difference only, hence once.
A key that too many words share (``LIST_WORDS``) is cut again: its window is
halved until its lists are small or the window is one place, where no more
words fit than the alphabet allows.

A word's form is its near word with the largest count, if that is at least
twice its own. Counts double along forms, so chains are short and without
cycles; their ends are found by pointer jumping over the words' links.

Defined cases: null text has no words; a null id is the text '' in the hash;
repeated rows and ids count like any others. Empty tables give no rows. Very
long words are words like others (lists are worked off by length, so that
one long word widens no other list). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import materialise, table, tidy_group

#: Rows of a bucket aimed at, and words of one key beyond which it is cut again.
BUCKET_ROWS = 60_000
LIST_WORDS = 60_000
#: Ranges that are looked at in one step.
STEP = 2_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FAR = 2  # two edits or more

NEAR = ["word", "n_near", "form_n", "form"]
NEAR_SCHEMA = "word string, n_near long, form_n long, form string"


def slipped(run: Column, doc_id: Column, every: int = 97) -> Column:
    """The run, or without one of its code points if ``every`` divides the hash of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3, every: int = 97) -> DataFrame:
    """word, n: words of at least ``min_length`` code points and ``min_count`` occurrences."""
    # Lower-casing A-Z first leaves the same runs.
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.split(text, "[^a-zÀ-ÿ]+")).alias("run"))
    words = runs.filter(F.length("run") >= min_length).select(slipped(F.col("run"), F.col("doc_id"), every).alias("word"))
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) with ``key``: a hash of the window and of the word without it."""
    extra = F.length("word") - F.col("m")  # a longer partner has one more place in the window
    rest = F.concat(F.expr("substring(word, 1, a)"), F.lit("\0"),
                    F.substring(F.col("word"), F.col("b") + extra + 1, F.length("word")))
    return rows.withColumn("key", F.xxhash64("m", "a", "b", rest))


def windows(words: DataFrame, min_length: int, limit: int = LIST_WORDS) -> DataFrame:
    """word, n, m, a, b, key: every word's rows, keys of more than ``limit`` words cut further."""
    length = F.length("word")
    pairs = F.explode(F.when(length > min_length, F.array(length, length - 1)).otherwise(F.array(length))).alias("m")
    half = (F.col("m") / 2).cast("int")
    whole = words.select("word", "n", pairs).select(
        "word", "n", "m", F.explode(F.array(F.struct(F.lit(0).alias("a"), half.alias("b")),
                                            F.struct(half.alias("a"), F.col("m").alias("b")))).alias("w"))
    rows = _keyed(whole.select("word", "n", "m", "w.a", "w.b"))
    done = None
    while True:
        rows = materialise(rows, "windows")
        hot = rows.filter("b - a > 1").groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > limit)
        hot = materialise(hot.select("key"), "hot-keys")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(hot, "key", "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        mid = ((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.explode(F.array(F.struct(F.col("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b")))).alias("w")
        cut = rows.filter("b - a > 1").join(hot, "key", "left_semi").select("word", "n", "m", halves)
        rows = _keyed(cut.select("word", "n", "m", "w.a", "w.b"))


def _row(last: np.ndarray, mid: np.ndarray, nxt: np.ndarray, x: list[np.ndarray], ch: np.ndarray):
    """The next row's band: cells one before, on and one after the diagonal.

    ``x`` holds the query's code points at the three cells' places; -1 is past its end.
    """
    a = np.minimum(last + (x[0] != ch), mid + 1)
    b = np.minimum(np.minimum(mid + (x[1] != ch), nxt + 1), a + 1)
    c = np.minimum(np.where(x[2] < 0, FAR, nxt + (x[2] != ch)), b + 1)
    return tuple(np.minimum(v, FAR).astype(np.int8) for v in (a, b, c))


def list_pairs(words: np.ndarray, lists: np.ndarray, shared: np.ndarray, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, word) one edit apart, a bounded number at a time.

    ``words`` (lengths m or m + 1) stands sorted by (list, word); a list's words
    share at least the first ``shared`` places within its ranges, which are told
    apart by them. Queries are the words of length m.
    """
    k = len(words)
    codes = words.view(np.uint32).reshape(k, m + 1).astype(np.int32)
    query = np.concatenate([codes[:, :m], np.full((k, 2), -1, np.int32)], 1)  # past the end
    differ = codes[1:] != codes[:-1]
    lcp = np.concatenate([[-1], np.where(differ.any(1), differ.argmax(1), m + 1)])
    lcp[1:][lists[1:] != lists[:-1]] = -1
    starts: dict[int, np.ndarray] = {}

    def nodes(depth: int) -> np.ndarray:
        """First words of the ranges that share ``depth`` places."""
        if depth not in starts:
            starts[depth] = np.append(np.flatnonzero(lcp < depth), k)
        return starts[depth]

    work = []
    for s in np.unique(shared):  # every list's ranges of words with an equal shared part
        q = np.flatnonzero((shared == s) & (codes[:, m] == 0))
        at = nodes(int(s))
        node = np.searchsorted(at, q, "right") - 1
        one = np.ones(len(q), np.int8)
        # The shared part costs nothing: zero on the diagonal, one beside it.
        work.append((int(s), q, at[node], at[node + 1], one if s else one + 1, one * 0, one))
    while work:
        d, q, lo, hi, last, mid, nxt = work.pop()
        at = nodes(d + 1)
        first = np.searchsorted(at, lo)
        count = np.searchsorted(at, hi) - first
        total = int(count.sum())
        if total > STEP and len(q) > 1:
            h = len(q) // 2
            work.append((d, q[h:], lo[h:], hi[h:], last[h:], mid[h:], nxt[h:]))
            work.append((d, q[:h], lo[:h], hi[:h], last[:h], mid[:h], nxt[:h]))
            continue
        up = np.repeat(np.arange(len(q)), count)
        node = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + first[up]
        q, word = q[up], at[node]
        ch = codes[word, d]
        if d == m:  # ranges are single words now: of length m, or one longer
            a = np.minimum(last[up] + (query[q, m - 1] != ch), mid[up] + 1)
            near = np.where(ch == 0, mid[up], a) == 1
            if near.any():
                yield q[near], word[near]
            continue
        x = [query[q, d - 1] if d else np.full(total, -2), query[q, d], query[q, d + 1]]
        band = _row(last[up], mid[up], nxt[up], x, ch)
        alive = np.minimum(np.minimum(band[0], band[1]), band[2]) < FAR
        if alive.any():
            node = node[alive]
            work.append((d + 1, q[alive], at[node], at[node + 1], *(v[alive] for v in band)))


def _of_length(m: int, word: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """The rows of one m: near counts and best near word per word, from pairs first differing in their window."""
    text = word.astype(f"U{m + 1}")
    back = (a == 0) & (b < m)  # the shared part is at the end
    turned = text.copy()
    turned[back] = [w[::-1] for w in text[back].tolist()]
    order = np.lexsort((turned, a, b))
    turned, text, n, a, b, back = (v[order] for v in (turned, text, n, a, b, back))
    window = a.astype(np.int64) * (m + 2) + b
    codes = np.concatenate([text.view(np.uint32).reshape(len(text), m + 1)], 1)
    rank = np.empty(len(text), np.int64)
    rank[np.argsort(text, kind="stable")] = np.arange(len(text))
    src, dst = [], []
    for q, w in list_pairs(turned, window, np.where(back, m - b, a), m):
        differ = codes[q] != codes[w]
        at = differ.argmax(1)
        here = (at >= a[q]) & ((at < b[q]) | (b[q] == m))
        q, w = q[here], w[here]
        longer = codes[w, m] != 0
        src += [q, w[longer]]
        dst += [w, q[longer]]
    s, d = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (src, dst))
    best = np.lexsort((rank[d], -n[d], s))
    s, d = s[best], d[best]
    one = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    return pd.DataFrame({"word": text[s[one]].astype(object), "n_near": np.bincount(s, minlength=len(text))[s[one]],
                         "form_n": n[d[one]], "form": text[d[one]].astype(object)}, columns=NEAR)


def near_words(words: DataFrame, min_length: int = 5, limit: int = LIST_WORDS,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """word, n_near, form_n, form: near words' number, and the one with the largest count (then the smallest).

    ``words`` are distinct with their counts ``n``; those without near words give no row.
    """
    rows = windows(words, min_length, limit)
    buckets = max(1, -(-rows.count() // bucket_rows))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for m, part in pdf.groupby("m"):
            if len(part) > 1:
                out.append(_of_length(int(m), part["word"].to_numpy(object), part["n"].to_numpy(np.int64),
                                      part["a"].to_numpy(np.int64), part["b"].to_numpy(np.int64)))
        out = [o for o in out if len(o)]
        if not out:
            return pd.DataFrame([], columns=NEAR)
        # One contiguous column each, whatever type pandas takes for text.
        return pd.DataFrame({c: np.concatenate([o[c].to_numpy(object) for o in out]).tolist() for c in NEAR})

    found = (rows.withColumn("bucket", F.pmod("key", F.lit(buckets))).select("bucket", "m", "a", "b", "word", "n")
             .groupBy("bucket").applyInPandas(tidy_group(meet), NEAR_SCHEMA))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def chain_ends(links: DataFrame) -> DataFrame:
    """word, root for every (word, form): the last word that forms lead to."""
    ends = materialise(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = ends.select(F.col("word").alias("u_word"), F.col("root").alias("u_root"))
        step = materialise(ends.join(up, F.col("root") == F.col("u_word"), "left").select(
            "word", F.coalesce("u_root", "root").alias("root"), F.col("u_root").isNotNull().alias("moved")), "roots")
        ends = step.drop("moved")
        if step.filter("moved").isEmpty():
            return ends


def variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, every: int = 97, ratio: int = 2,
             limit: int = LIST_WORDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every counted word with its form, the root of its chain of forms, and its counts."""
    words = materialise(word_counts(docs, min_length, min_count, every), "words")
    near = near_words(words, min_length, limit, bucket_rows).withColumnRenamed("word", "n_word")
    rows = words.join(near, F.col("word") == F.col("n_word"), "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    rows = materialise(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(formed, F.col("form")).alias("form"),
                                   F.when(formed, F.col("form_n")).alias("form_n")), "near-words")
    ends = chain_ends(rows.filter("form is not null")).withColumnRenamed("word", "e_word")
    return rows.join(ends, F.col("word") == F.col("e_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the words of ``documents`` with their forms and roots."""
    return variants(table(spark, sf_dir, "documents"))
