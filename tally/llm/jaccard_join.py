"""Operator 10: n-gram Jaccard join by several global token orders.

Tokens are hashes of five-word shingles; texts alike in every character are
one class. For a threshold t, two sets that meet it share a token among the
first n - ceil(t n) + 1 of each, under any order of all tokens. Here every
order puts rare tokens first, by the number of classes that hold them, and the
orders break ties differently; a pair must share a prefix token under all of
them, and pass the length filter, before its sets are intersected. Tokens of
one class alone come first in each order and link nothing, so most sets have
no prefix left to match.

1. One pass over the texts hashes each set and deals its tokens in packed
   blocks to buckets by hash, five bytes a token. A token that a large share of
   a chunk's texts hold is sent once per chunk with its count, its members stay
   behind under the chunk's number.
2. A bucket counts classes per token and sends the tokens of two or more
   classes back to their classes with the counts; for frequent tokens the
   chunks' member lists meet the counts chunk by chunk.
3. Classes take their prefixes under each order. The rest of the work is on
   classes that share prefix tokens: connected groups of these hold all links.
4. A group of up to ``BLOCK`` classes is joined in one task; a pair already
   connected is skipped. Larger groups are dealt into blocks: each block is
   joined; members of the blocks' components of more than one class are joined,
   a bounded number at a time, up a tree; then each class outside its group's largest component is joined with
   every block of the group that holds one of its prefix tokens. That covers
   every pair of different components, without a pass over all pairs of a group.
5. Components of the links found are contracted by stars.

The result holds each class's component; it is exact, but for chance: a class
is known by 64 bits of its text's hash and a token by 40 bits and its bucket.

Defined cases: null and empty texts and texts without words have no set, link
with nothing and are their own component. Fewer than five words make one
shingle. Rows with equal texts are linked (equal sets). Rows that repeat an id
share a component. A null id is no component's name while another id is in it.
Texts of any length are read whole. Columns other than id and text are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import chunks, id_and_text, materialise, table, tidy, tidy_group
from tally.llm.components import Forest, connected_components
from tally.llm.shingles import scramble, shingle_sets

WIDTH, PERCENT = 5, 75
#: Tokens aimed at in a bucket (the number of buckets grows with the texts), and bytes of text a token stands for.
BUCKET_TOKENS, TOKEN_BYTES = 4_000_000, 6
#: Classes joined in one task at a time.
BLOCK = 1024
#: A token held by this share of a chunk's texts (and so many at least) is counted per chunk.
HOT_SHARE, HOT_TEXTS = 8, 64
#: Members of a component that stand for it up the tree, and blocks that meet at a time there.
STAND_INS, MEET = 8, 32

_U = np.uint64
_LOW = _U((1 << 40) - 1)
PIECES, SIZES, HOT_COUNTS, HOT_MEMBERS = 0, 1, 2, 3
BLOCK_SCHEMA = "kind int, bucket int, chunk long, cls binary, cnt binary, tok binary"
BLOCK_NAMES = ["kind", "bucket", "chunk", "cls", "cnt", "tok"]


def prefix_length(n):
    """Tokens of a set of n of which one at least is shared with any set that meets the threshold."""
    return n - (PERCENT * n + 99) // 100 + 1


def meets(shared, n, m):
    return 100 * shared >= PERCENT * (n + m - shared)


def _pack5(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack5(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _group_of(cls: np.ndarray, groups: int) -> np.ndarray:
    return (scramble(cls.view(_U), 7) % _U(groups)).astype(np.int64)


def _blocks(buckets: int):
    """Texts (cls, text) to packed blocks: tokens by bucket, set sizes, frequent tokens' members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for b in chunks(whole):
                number += 1
                cls = np.asarray(b.column(0), dtype=np.int64)
                _, first = np.unique(cls, return_index=True)
                b, cls = b.take(pa.array(first)), cls[first]
                flat, n = shingle_sets(b.column(1), WIDTH)
                rows: list[tuple] = []
                groups = _group_of(cls, buckets)
                for g in np.unique(groups):
                    at = groups == g
                    rows.append((SIZES, buckets + int(g), 0, cls[at].tobytes(), n[at].astype("<i8").tobytes(), b""))
                doc = np.repeat(np.arange(len(cls)), n)
                where = ((flat >> _U(40)) * _U(buckets)) >> _U(24)
                token = (where << _U(40)) | (flat & _LOW)
                least = max(HOT_TEXTS, len(cls) // HOT_SHARE)
                cell = (flat & _U((1 << 20) - 1)).astype(np.int64)
                maybe = np.bincount(cell, minlength=1 << 20)[cell] >= least
                if maybe.any():
                    spots = np.flatnonzero(maybe)
                    value, inverse, count = np.unique(token[spots], return_inverse=True, return_counts=True)
                    spots = spots[count[inverse] >= least]
                    if len(spots):
                        spots = spots[np.argsort(token[spots], kind="stable")]
                        value, count = np.unique(token[spots], return_counts=True)
                        rows.append((HOT_MEMBERS, buckets + number % buckets, number, cls[doc[spots]].tobytes(),
                                     count.astype("<i8").tobytes(), value.astype("<u8").tobytes()))
                        for g in np.unique(value >> _U(40)):
                            at = (value >> _U(40)) == g
                            rows.append((HOT_COUNTS, int(g), number, b"", count[at].astype("<i8").tobytes(),
                                         _pack5(value[at] & _LOW)))
                        keep = np.ones(len(token), bool)
                        keep[spots] = False
                        token, doc, where = token[keep], doc[keep], where[keep]
                order = np.argsort(where.astype(np.uint32), kind="stable")
                token, doc, where = token[order] & _LOW, doc[order], where[order]
                cuts = np.flatnonzero(np.diff(where)) + 1
                for a, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(where)]):
                    if a == e:
                        continue
                    heads = np.flatnonzero(np.diff(doc[a:e], prepend=-1))
                    sizes = np.diff(np.append(heads, e - a))
                    rows.append((PIECES, int(where[a]), 0, cls[doc[a:e][heads]].tobytes(),
                                 sizes.astype("<i8" if sizes.max() > 65535 else "<u2").tobytes(), _pack5(token[a:e])))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=BLOCK_NAMES)
    return run


COUNTED_SCHEMA = "kind int, part int, chunk long, cls binary, cnt binary, tok binary, df binary"
COUNTED = ["kind", "part", "chunk", "cls", "cnt", "tok", "df"]


def _sizes_of(cnt: bytes, classes: int) -> np.ndarray:
    return np.frombuffer(cnt, "<u2" if len(cnt) == 2 * classes else "<i8").astype(np.int64)


def _by_group(cls: np.ndarray, token: np.ndarray, df: np.ndarray, parts: int) -> list[tuple]:
    """(class, token, count) entries as packed rows by group of classes."""
    order = np.lexsort((cls, _group_of(cls, parts)))
    cls, token, df = cls[order], token[order], df[order]
    group = _group_of(cls, parts)
    cuts = np.flatnonzero(np.diff(group)) + 1
    out = []
    for a, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cls)]):
        if a < e:
            heads = np.flatnonzero(np.append(True, np.diff(cls[a:e]) != 0))
            out.append((PIECES, int(group[a]), 0, cls[a:e][heads].tobytes(),
                        np.diff(np.append(heads, e - a)).astype("<i8").tobytes(),
                        token[a:e].astype("<u8").tobytes(), df[a:e].astype("<u4").tobytes()))
    return out


def _count(buckets: int):
    """A bucket's blocks to the tokens of two or more classes, by group of classes."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        if bucket >= buckets:  # set sizes and frequent tokens' members pass through
            out = pdf.assign(part=bucket - buckets, df=b"")
            return out[COUNTED]
        rows: list[tuple] = []
        plain, hot = pdf[pdf["kind"] == PIECES], pdf[pdf["kind"] == HOT_COUNTS]
        base = _U(bucket) << _U(40)
        hot_keys = [_unpack5(x) for x in hot["tok"]]
        hot_values, place = np.unique(np.concatenate([np.zeros(0, _U), *hot_keys]), return_inverse=True)
        seen: set[int] = set()  # a class from several chunks counts once
        cls, key, owner = [], [], []
        for c, n, t in zip(plain["cls"], plain["cnt"], plain["tok"]):
            c = np.frombuffer(c, np.int64)
            n = _sizes_of(n, len(c))
            once = np.array([x not in seen for x in c.tolist()])
            seen.update(c.tolist())
            key.append(_unpack5(t)[np.repeat(once, n)])
            owner.append(np.repeat(np.arange(once.sum(), dtype=np.int32) + np.int32(sum(map(len, cls))), n[once]))
            cls.append(c[once])
        del plain, pdf, seen
        cls = np.concatenate([np.zeros(0, np.int64), *cls])
        key = np.concatenate([np.zeros(0, _U), *key])
        owner = np.concatenate([np.zeros(0, np.int32), *owner])
        order = np.argsort(key)
        key = key[order]
        # Tokens of one class alone go here, before anything is made of them.
        same = key[1:] == key[:-1]
        shared = np.append(same, False) | np.append(False, same)
        if len(hot_values):
            at = np.minimum(np.searchsorted(hot_values, key), len(hot_values) - 1)
            shared |= hot_values[at] == key
        key, owner = key[shared], owner[order[shared]]
        del order, same, shared
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        own = np.diff(np.append(heads, len(key)))
        df = own.copy()
        if len(hot_values):
            hot_df = np.bincount(place, weights=np.concatenate([np.frombuffer(x, "<i8") for x in hot["cnt"]])).astype(np.int64)
            values = key[heads]
            at = np.searchsorted(values, hot_values)
            known = at < len(values)
            known[known] = values[at[known]] == hot_values[known]
            hot_df[known] += own[at[known]]
            df[at[known]] = hot_df[known]
            for chunk, k in zip(hot["chunk"], hot_keys):
                rows.append((HOT_COUNTS, 0, int(chunk), b"", b"", (k | base).astype("<u8").tobytes(),
                             hot_df[np.searchsorted(hot_values, k)].astype("<u4").tobytes()))
        rows += _by_group(cls[owner], key | base, np.repeat(df, own), buckets)
        return pd.DataFrame(rows, columns=COUNTED)
    return run


def _hot_pieces(parts: int):
    """A chunk's members of frequent tokens meet the tokens' counts."""
    def run(counts: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(counts) and len(members):
            token = np.concatenate([np.frombuffer(x, "<u8") for x in counts["tok"]])
            df = np.concatenate([np.frombuffer(x, "<u4") for x in counts["df"]])
            order = np.argsort(token)
            token, df = token[order], df[order]
            for cls, cnt, tok in zip(members["cls"], members["cnt"], members["tok"]):
                mine = np.repeat(np.frombuffer(tok, "<u8"), np.frombuffer(cnt, "<i8"))
                rows += _by_group(np.frombuffer(cls, np.int64), mine, df[np.searchsorted(token, mine)], parts)
        return pd.DataFrame(rows, columns=COUNTED)
    return run


CANDIDATES = "cls long, n long, tokens binary, first array<long>, second binary, third binary"


def _prefixes(pdf: pd.DataFrame) -> pd.DataFrame:
    """A group's classes with their shared tokens and prefixes; those without a prefix to match are left out."""
    sized, plain = pdf[pdf["kind"] == SIZES], pdf[pdf["kind"] == PIECES]
    names = ["cls", "n", "tokens", "first", "second", "third"]
    if not len(plain):
        return pd.DataFrame([], columns=names)
    known = np.concatenate([np.frombuffer(x, np.int64) for x in sized["cls"]])
    total = np.concatenate([np.frombuffer(x, "<i8") for x in sized["cnt"]])
    known, at = np.unique(known, return_index=True)
    total = total[at]
    cls = np.concatenate([np.repeat(np.frombuffer(c, np.int64), np.frombuffer(k, "<i8"))
                          for c, k in zip(plain["cls"], plain["cnt"])])
    token = np.concatenate([np.frombuffer(x, "<u8") for x in plain["tok"]])
    df = np.concatenate([np.frombuffer(x, "<u4") for x in plain["df"]])
    order = np.lexsort((token, cls))
    cls, token, df = cls[order], token[order], df[order]
    new = np.append(True, (cls[1:] != cls[:-1]) | (token[1:] != token[:-1]))
    cls, token, df = cls[new], token[new], df[new]
    heads = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
    ends = np.append(heads[1:], len(cls))
    n = total[np.searchsorted(known, cls[heads])]
    left = prefix_length(n) - (n - (ends - heads))  # tokens of no other class come first
    rows = []
    for k in np.flatnonzero(left > 0):
        t, d = token[heads[k]:ends[k]], df[heads[k]:ends[k]]
        pick = [t[np.lexsort((scramble(t, s), r))[:left[k]]]
                for s, r in ((1, d), (2, d), (3, np.frexp(d.astype(float))[1]))]
        rows.append((cls[heads[k]], n[k], t.tobytes(), pick[0].view(np.int64), np.sort(pick[1]).tobytes(),
                     np.sort(pick[2]).tobytes()))
    return pd.DataFrame(rows, columns=names)


def _sharing(lists: list[np.ndarray]) -> np.ndarray:
    """Which pairs of lists hold a common token, as a square of booleans."""
    out = np.zeros((len(lists), len(lists)), bool)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    token = np.concatenate([np.zeros(0, _U), *lists])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    cuts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, int)
    for a, e in zip(cuts, np.append(cuts[1:], len(token))):
        if e - a > 1:
            m = owner[a:e]
            out[m[:, None], m] = True
    return out


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def join_block(pdf: pd.DataFrame, left: np.ndarray | None = None) -> pd.DataFrame:
    """Links that connect a bounded set of classes: rows (a, b).

    Classes with one ``root`` are connected already. With ``left`` (booleans),
    only pairs of a marked and an unmarked class are looked at.
    """
    cls, n = pdf["cls"].to_numpy(), pdf["n"].to_numpy()
    sets = [np.frombuffer(x, "<u8") for x in pdf["tokens"]]
    size = np.array([len(s) for s in sets])
    maybe = _sharing([np.asarray(x, np.int64).view(_U) for x in pdf["first"]])
    for col in ("second", "third"):
        maybe &= _sharing([np.frombuffer(x, "<u8") for x in pdf[col]])
    forest, out = Forest(), []
    if "root" in pdf:
        first: dict = {}
        for i, r in enumerate(pdf["root"]):
            forest.join(i, first.setdefault(r, i))
    for i in range(len(cls)):
        js = np.flatnonzero(maybe[i, :i])
        if left is not None:
            js = js[left[js] != left[i]]
        js = js[meets(np.minimum(size[js], size[i]), n[js], n[i])]  # shared tokens at most
        for j in js.tolist():
            if forest.root(i) != forest.root(j) and meets(_shared(sets[i], sets[j]), n[i], n[j]):
                forest.join(i, j)
                out.append((cls[i], cls[j]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _join_known(pdf: pd.DataFrame) -> pd.DataFrame:
    return join_block(pdf)


def _join_left(pdf: pd.DataFrame) -> pd.DataFrame:
    return join_block(pdf, pdf["outside"].to_numpy(dtype=bool))


def _rooted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (cls, ...) with ``root`` of their component."""
    cc = connected_components(edges)
    return (nodes.join(cc, nodes["cls"] == cc["node"], "left").drop("node")
            .withColumn("root", F.coalesce("root", "cls")))


def links(cand: DataFrame) -> DataFrame:
    """Edges (a, b) between classes whose components are those of all links."""
    postings = cand.select("cls", F.explode("first").alias("token"))
    least = (postings.groupBy("token").agg(F.min("cls").alias("m"), F.count(F.lit(1)).alias("c")).filter("c > 1")
             .select("token", "m"))
    near = postings.join(least, "token").filter("cls != m").select(F.col("cls").alias("a"), F.col("m").alias("b"))
    groups = materialise(_members(connected_components(near)), "jaccard-groups")  # cls, grp
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    total, largest = groups.count(), sizes.agg(F.max("size")).first()[0] or 0
    bins = max(1, -(-2 * total // BLOCK))
    large = F.col("size") > BLOCK
    placed = groups.join(sizes, "grp").select(
        "cls", F.when(large, F.col("grp")).alias("grp"),
        F.when(large, F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / F.lit(BLOCK // 2)))).otherwise(
            F.pmod(F.xxhash64("grp"), F.lit(bins))).alias("blk"))
    dealt = materialise(cand.join(placed, "cls"), "jaccard-dealt")
    edges = materialise(dealt.groupBy("grp", "blk").applyInPandas(tidy_group(_join_known), "a long, b long"), "jaccard-edges")
    if largest <= BLOCK:
        return edges
    cand = dealt.filter("grp is not null").drop("grp", "blk")  # from here on, of large groups only
    big = dealt.filter("grp is not null").select("cls", "grp", "blk")
    big_edges = edges.join(big.select(F.col("cls").alias("a")), "a", "left_semi").select("a", "b")
    parts, span = -(-largest // (BLOCK // 2)), 1
    while span < parts:  # stand-ins of each component meet, block by block up a tree
        rooted = materialise(_rooted(big, big_edges), "jaccard-rooted")
        # Classes linked with nothing so far stay behind: the last phase looks at them.
        many = rooted.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many")
        # One of each block and component, then a few of each subtree and component.
        rank = "row_number() over (partition by grp, {}, root order by xxhash64(cls))"
        stand = rooted.join(many, ["grp", "root"]).withColumn("at", F.floor(F.col("blk") / F.lit(span)))
        if span > 1:
            stand = stand.withColumn("k", F.expr(rank.format("blk"))).filter("k = 1")
        stand = stand.withColumn("k", F.expr(rank.format("at"))).filter(F.col("k") <= STAND_INS)
        span *= MEET
        stand = materialise(stand.select("cls", "grp", "root", F.floor(F.col("blk") / F.lit(span)).alias("up")), "jaccard-stand")
        full = stand.groupBy("grp", "up").agg(F.count(F.lit(1)).alias("rows"))
        salt = F.when(F.col("rows") > BLOCK, F.pmod(F.xxhash64("cls", F.lit(span)), F.ceil(F.col("rows") / F.lit(BLOCK // 2))))
        met = stand.join(full, ["grp", "up"]).select("cls", "grp", "root", "up", F.coalesce(salt, F.lit(0)).alias("salt"))
        up = cand.join(met, "cls").groupBy("grp", "up", "salt").applyInPandas(tidy_group(_join_known), "a long, b long")
        new = materialise(up, "jaccard-up")
        edges, big_edges = edges.unionByName(new), big_edges.unionByName(new)
    rooted = materialise(_rooted(big, big_edges), "jaccard-rooted")
    per = rooted.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("many"))
    main = per.groupBy("grp").agg(F.max_by("root", F.struct("many", "root")).alias("main"))
    outside = materialise(rooted.join(main, "grp").filter("root != main").drop("main"), "jaccard-outside")
    tokens = cand.select("cls", F.explode("first").alias("token"))
    there = rooted.join(tokens, "cls").select("grp", "token", F.col("blk").alias("to")).distinct()
    ask = (outside.join(tokens, "cls").join(there, ["grp", "token"]).filter("to != blk")
           .select("cls", "grp", "root", F.col("to").alias("blk")).distinct())
    ask = materialise(ask.withColumn("turn", F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(max(1, -(-outside.count() // BLOCK))))),
                      "jaccard-ask")
    turns = ask.select("grp", "blk", "turn").distinct()
    rows = ask.withColumn("outside", F.lit(True)).unionByName(
        rooted.join(turns, ["grp", "blk"]).withColumn("outside", F.lit(False)))
    last = (cand.join(rows, "cls").groupBy("grp", "blk", "turn").applyInPandas(tidy_group(_join_left), "a long, b long"))
    return edges.unionByName(materialise(last, "jaccard-last"))


def _members(cc: DataFrame) -> DataFrame:
    """(cls, grp) of all nodes of stars, centers included."""
    return (cc.select(F.col("node").alias("cls"), F.col("root").alias("grp"))
            .unionByName(cc.select(F.col("root").alias("cls"), F.col("root").alias("grp")).distinct()))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for cls, cnt in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield pa.record_batch([pa.array(np.frombuffer(cls, np.int64)), pa.array(np.frombuffer(cnt, "<i8"))],
                                  names=["cls", "n"])


def _class_of(text) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, cls, n_shingles, component_id of every row."""
    docs = id_and_text(docs)
    named = docs.select("doc_id", _class_of(F.col("text")).alias("cls"), "text")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (TOKEN_BYTES * BUCKET_TOKENS)))
    packed = named.select("cls", "text").mapInArrow(tidy(_blocks(buckets)), BLOCK_SCHEMA)
    counted = materialise(packed.groupBy("bucket").applyInPandas(tidy_group(_count(buckets)), COUNTED_SCHEMA), "jaccard-counted")
    hot = (counted.filter(F.col("kind") == HOT_COUNTS).groupBy("chunk")
           .cogroup(counted.filter(F.col("kind") == HOT_MEMBERS).groupBy("chunk"))
           .applyInPandas(_hot_pieces(buckets), COUNTED_SCHEMA))
    cand = materialise(counted.filter(F.col("kind").isin(PIECES, SIZES)).unionByName(hot)
                       .groupBy("part").applyInPandas(tidy_group(_prefixes), CANDIDATES), "jaccard-candidates")
    cc = connected_components(links(cand))
    sizes = (counted.filter(F.col("kind") == SIZES).select("cls", "cnt").mapInArrow(_unpacked, "cls long, n long")
             .groupBy("cls").agg(F.max("n").alias("n")))
    of_class = materialise(sizes.join(cc, sizes["cls"] == cc["node"], "left")
                           .select("cls", "n", F.coalesce("root", "cls").alias("root")), "jaccard-classes")
    ids = named.select("doc_id", "cls")
    first = (ids.groupBy("cls").agg(F.min("doc_id").alias("least")).join(of_class, "cls")
             .groupBy("root").agg(F.min("least").alias("least")))
    named_class = materialise(of_class.join(first, "root").select("cls", "n", "least"), "jaccard-named")
    return (ids.join(named_class, "cls")
            .select("doc_id", "cls", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return _found(docs).drop("cls")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the rows of the smallest id of each component, all columns kept.

    Rows that repeat an id are told apart by their texts.
    """
    found = materialise(_found(docs), "jaccard-components")
    gone = (found.filter("not (doc_id <=> component_id)")
            .select(F.col("doc_id").alias("gone"), F.col("cls").alias("gone_cls")).distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone"]) & (_class_of(docs["text"]) == gone["gone_cls"]),
                     "left_anti")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: set size and component of every document."""
    return near_components(table(spark, sf_dir, "documents"))
