"""Operator 7: embedding near-duplicates by NN-descent.

Vectors are compared only within a label. Equal vectors are one node with a
multiplicity. Every node starts with neighbours from several orders of random
hyperplane signatures (near vectors share long prefixes). A round then joins
neighbours of neighbours: each node's neighbours in either direction meet at
it, and every one keeps the best of those it met. Rounds end when a round
changes few lists. Lists whose last place still meets the threshold are
saturated: they are enlarged, and a list that is full again is refined no more,
as what no list can hold is found exactly: blocks of saturated nodes of different components meet where their centers and radii
allow a link, and one link joins the components; within a component with
saturated nodes, blocks of vectors are compared with blocks, and only counts
leave a task. Recall of the other nodes' lists is audited against brute force
for a fixed number of nodes; short of the target, rounds go on with more orders,
and if that does not reach it, every node is treated as saturated.

Links found have a cosine of at least the threshold, in double precision.

Defined cases: null, empty or zero vectors, vectors with null or non-finite
components or another length than their label's peers compare with nothing,
nor do vectors with a null label: no links, own component. Rows that repeat an
id and vector are equal vectors. A null id has its own row and is never a
component's name while another id is in it. Columns other than id, embedding
and label are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import materialise, table, tidy_group
from tally.llm.components import connected_components

THRESHOLD = 0.98
#: Neighbours of a list at first and at most; what a full list cannot hold is found in blocks.
NEIGHBOURS, LONGEST = 8, 32
#: Signature orders at the start, bits of a signature, neighbours taken on each side.
ORDERS, BITS, SIDE = 8, 48, 3
ROUNDS, QUIET_SHARE = 4, 0.002
#: Nodes whose meetings one task works off together.
BIN_NODES = 2000
#: Lists are kept in single precision; links within this margin are decided in double precision.
MARGIN = 1e-5
#: Nodes audited against brute force (fixed, so the audit's queries may be sent to all tasks), and recall aimed at.
AUDIT_NODES, TARGET = 256, 0.98
#: Bytes of a block's vectors in exact counting (two blocks meet in a task), vectors of one product,
#: and block centers of a part.
BLOCK_BYTES, STEP, CENTERS = 4 << 20, 1024, 1024
#: Parts of one component's rows in joins by component.
SALTS = 32


def _usable(v: Column) -> Column:
    v = v.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def _matrix(col, kind: str = "<f8") -> np.ndarray:
    return np.stack([np.frombuffer(x, kind) for x in col]) if len(col) else np.zeros((0, 1))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """node (long), label, exact and unit (length one, packed in double and single precision), copies.

    From (vec_id, embedding, label) rows.

    A node stands for the rows with one label and vector; its number is a hash
    of both.
    """
    rows = (vectors.filter(F.col("label").isNotNull() & _usable(F.col("embedding")))
            .select(F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v")))
    groups = (rows.withColumn("node", F.xxhash64("label", "v")).groupBy("node")
              .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = []
            for v in b.column(2).to_pylist():
                x = np.array(v)
                x = x / np.abs(x).max()
                units.append((x / np.linalg.norm(x)).tobytes())
            yield pa.record_batch([b.column(0), b.column(1), pa.array([f"{len(u)}" for u in units]),
                                   pa.array(units, pa.binary()),
                                   pa.array([np.frombuffer(u).astype("<f4").tobytes() for u in units], pa.binary()),
                                   b.column(3)], names=["node", "label", "width", "exact", "unit", "copies"])
    out = groups.mapInArrow(run, "node long, label string, width string, exact binary, unit binary, copies long")
    return out.select("node", F.concat_ws("/", "label", "width").alias("label"), "exact", "unit", "copies")


def _signed(orders: range):
    """(node, label, unit) to one row per order of signatures: (ord, label, sig, node, unit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = b.column(2).to_pylist()
            widths = np.array([len(u) // 4 for u in units])
            for order in orders:
                keys = np.zeros(len(units), np.int64)
                for w in np.unique(widths):
                    at = np.flatnonzero(widths == w)
                    planes = np.random.default_rng([order, int(w)]).standard_normal((w, BITS))
                    bits = _matrix([units[k] for k in at], "<f4") @ planes > 0
                    keys[at] = bits @ (1 << np.arange(BITS, dtype=np.int64))
                yield pa.record_batch([pa.array([order] * len(units), pa.int32()), b.column(1), pa.array(keys),
                                       b.column(0), b.column(2)], names=["ord", "label", "sig", "node", "unit"])
    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to pairs up to SIDE rows apart in one order and label, in both directions, with similarity."""
    rest: list[tuple] = []
    for batch in batches:
        rows = rest + list(zip(*(batch.column(k).to_pylist() for k in range(4))))
        old = len(rest)
        group = [r[:2] for r in rows]
        a, b, sims = [], [], []
        for d in range(1, SIDE + 1):
            at = [k for k in range(max(d, old), len(rows)) if group[k] == group[k - d] and rows[k][2] != rows[k - d][2]]
            for part in range(0, len(at), 10_000):
                ks = at[part:part + 10_000]
                x = _matrix([rows[k][3] for k in ks], "<f4")
                y = _matrix([rows[k - d][3] for k in ks], "<f4")
                a += [rows[k][2] for k in ks]
                b += [rows[k - d][2] for k in ks]
                sims += np.einsum("ij,ij->i", x, y).tolist()
        rest = rows[-SIDE:]
        yield pa.record_batch([pa.array(a + b, pa.int64()), pa.array(b + a, pa.int64()),
                               pa.array(sims + sims, pa.float64())], names=["a", "b", "sim"])


PAIRS = "a long, b long, sim double"


def first_pairs(nodes: DataFrame, orders: range) -> DataFrame:
    """Pairs (a, b, sim) near each other under signature orders, all sorted in one range shuffle."""
    signed = materialise(nodes.select("node", "label", "unit").mapInArrow(
        _signed(orders), "ord int, label string, sig long, node long, unit binary"), "knn-signed")
    keys = ["ord", "label", "sig", "node"]
    return (signed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("ord", "label", "node", "unit")
            .mapInArrow(_windows, PAIRS))


def _meetings(keep: int):
    """Rows (at, node, unit) of many places: at each, every node keeps the best of those it met."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["at"].to_numpy(), kind="stable")
        at, ids, units = pdf["at"].to_numpy()[order], pdf["node"].to_numpy()[order], pdf["unit"].to_numpy()[order]
        cuts = np.flatnonzero(np.diff(at)) + 1
        a, b, sim = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            k = min(keep, e - s - 1)
            if k < 1:
                continue
            x = _matrix(units[s:e], "<f4")
            sims = x @ x.T
            np.fill_diagonal(sims, -2.0)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            a.append(np.repeat(ids[s:e], k))
            b.append(ids[s:e][best].ravel())
            sim.append(np.take_along_axis(sims, best, 1).ravel().astype(float))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "sim": np.concatenate(sim)})
    return run


def _top(pairs: DataFrame, keep: int, *flags: str) -> DataFrame:
    """The ``keep`` most similar of each node's pairs; of ``flags`` the largest."""
    ranked = F.expr("row_number() over (partition by a order by sim desc, b)")
    return (pairs.groupBy("a", "b").agg(*(F.max(c).alias(c) for c in ("sim", *flags))).withColumn("k", ranked)
            .filter(F.col("k") <= keep).drop("k"))


def _meet(lists: DataFrame, nodes: DataFrame, keep: int, bins: int) -> DataFrame:
    """One round: (a, b, sim) rows of nodes that met at a common neighbour.

    Neighbours in the other direction are as many as the list's length, chosen
    by hash: a node that many point at would else gather them all.
    """
    back = (lists.select(F.col("b").alias("at"), F.col("a").alias("node"))
            .withColumn("k", F.expr("row_number() over (partition by at order by xxhash64(node, at))"))
            .filter(F.col("k") <= keep).drop("k"))
    there = (lists.select(F.col("a").alias("at"), F.col("b").alias("node")).unionByName(back)
             .unionByName(lists.select(F.col("a").alias("at"), F.col("a").alias("node"))).distinct())
    return (there.join(nodes.select("node", "unit"), "node").withColumn("bin", F.pmod(F.xxhash64("at"), F.lit(bins)))
            .groupBy("bin").applyInPandas(tidy_group(_meetings(keep)), PAIRS))


def _exact(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b), a < b, of lists, by cosine in double precision."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = pa.array([float(np.frombuffer(u) @ np.frombuffer(v)) >= threshold for u, v in
                             zip(b.column(2).to_pylist(), b.column(3).to_pylist())], pa.bool_())
            yield pa.record_batch([b.column(0).filter(good), b.column(1).filter(good)], names=["a", "b"])
    near = (lists.filter(F.col("sim") >= threshold - MARGIN)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    u = nodes.select(F.col("node").alias("a"), F.col("exact").alias("u"))
    v = nodes.select(F.col("node").alias("b"), F.col("exact").alias("v"))
    return near.join(u, "a").join(v, "b").select("a", "b", "u", "v").mapInArrow(run, "a long, b long")


def descend(nodes: DataFrame, keep: int, start: DataFrame, count: int, threshold: float) -> DataFrame:
    """Neighbour lists (a, b, sim) refined from ``start`` until a round finds hardly a new link.

    New links of full lists do not count: a full list is enlarged or found in
    blocks, whichever of its node's links it holds.
    """
    bins = max(1, -(-count // BIN_NODES))
    lists = materialise(_top(start, keep), "knn-lists")
    near = F.col("sim") >= threshold - MARGIN
    held = F.expr(f"count_if(sim >= {threshold - MARGIN!r}) over (partition by a)")
    for _ in range(ROUNDS):
        met = _meet(lists, nodes, keep, bins).withColumn("old", F.lit(0))
        fresh = materialise(_top(lists.withColumn("old", F.lit(1)).unionByName(met), keep, "old")
                            .withColumn("held", held), "knn-lists")
        links = near & (F.col("held") < keep)
        got = fresh.agg(F.count_if(links & (F.col("old") == 0)).alias("new"), F.count_if(links).alias("all")).first()
        lists = fresh.select("a", "b", "sim")
        if got["new"] <= QUIET_SHARE * got["all"]:
            break
    return lists


def audit(nodes: DataFrame, lists: DataFrame, threshold: float, count: int = AUDIT_NODES,
          full: DataFrame | None = None) -> tuple[int, int]:
    """(links found, links there) of a fixed number of nodes, by brute force over all nodes.

    Nodes with the smallest hashes that have a listed neighbour over the
    threshold are audited with as many others, so that links are seen at all.
    Nodes (a) of ``full`` are not asked: links between them are found in blocks,
    and their other links are in the lists of nodes that are asked.
    """
    linked = lists.filter(F.col("sim") >= threshold).groupBy("a").agg(F.count(F.lit(1)).alias("got"))
    mixed = nodes.join(linked, nodes["node"] == linked["a"], "left").select("node", "label", "unit",
                                                                           F.coalesce("got", F.lit(0)).alias("got"))
    if full is not None:
        mixed = mixed.join(full, mixed["node"] == full["a"], "left_anti")
    order = [F.xxhash64("node", F.lit(11)), F.col("node")]
    asked = (mixed.filter("got > 0").orderBy(*order).limit(count // 2)
             .unionByName(mixed.filter("got = 0").orderBy(*order).limit(count // 2))).collect()
    if not asked:
        return 0, 0
    by_label: dict = {}
    for r in asked:
        by_label.setdefault(r["label"], []).append(r)
    packed = {k: (np.array([r["node"] for r in rs]), _matrix([r["unit"] for r in rs], "<f4")) for k, rs in by_label.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits: dict[int, int] = {}
            labels = np.array(b.column(1).to_pylist(), dtype=object)
            ids, units = np.asarray(b.column(0)), b.column(2).to_pylist()
            for label, (own, x) in packed.items():
                at = np.flatnonzero(labels == label)
                if len(at):
                    near = x @ _matrix([units[k] for k in at], "<f4").T >= threshold
                    near &= own[:, None] != ids[at]
                    for node, c in zip(own.tolist(), near.sum(1).tolist()):
                        hits[node] = hits.get(node, 0) + c
            yield pa.record_batch([pa.array(list(hits), pa.int64()), pa.array(list(hits.values()), pa.int64())],
                                  names=["node", "n"])
    there = {r["node"]: r["n"] for r in nodes.select("node", "label", "unit").mapInArrow(run, "node long, n long")
             .groupBy("node").agg(F.sum("n").alias("n")).collect()}
    return sum(r["got"] for r in asked), sum(there.get(r["node"], 0) for r in asked)


def _full(lists: DataFrame, keep: int, threshold: float) -> DataFrame:
    """Nodes (a) whose list's last place still meets the threshold."""
    return (lists.filter(F.col("sim") >= threshold - MARGIN).groupBy("a").agg(F.count(F.lit(1)).alias("near"))
            .filter(F.col("near") >= keep).select("a"))


def neighbour_graph(nodes: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, float]:
    """(lists (a, b, sim), nodes (a) whose longest list is full, recall audited).

    If the recall stays short of the target, all nodes count as full, and
    blocks find every link (recall 1).
    """
    count = nodes.count()
    orders, start = ORDERS, first_pairs(nodes, range(ORDERS))
    while True:
        lists = descend(nodes, NEIGHBOURS, start, count, threshold)
        full = materialise(_full(lists, NEIGHBOURS, threshold), "knn-full")
        if many := full.count():  # enlarge saturated lists, with their neighbours
            near = lists.filter(F.col("sim") >= threshold - MARGIN)
            about = materialise(near.join(full, "a", "left_semi").select(F.col("b").alias("a")).unionByName(full).distinct(),
                                "knn-about")
            longer = descend(nodes, LONGEST, near.join(about, "a", "left_semi"), many, threshold)
            lists = materialise(_top(lists.unionByName(longer), LONGEST), "knn-merged")
            full = materialise(_full(lists, LONGEST, threshold), "knn-full")
        got, want = audit(nodes, lists, threshold, full=full)
        recall = got / want if want else 1.0
        if recall >= TARGET:
            return lists, full, recall
        if orders >= 4 * ORDERS:
            return lists, nodes.select(F.col("node").alias("a")), 1.0
        start = lists.unionByName(first_pairs(nodes, range(orders, orders + ORDERS)))
        orders += ORDERS


def _by_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (node, root, ...) joined with one row a root; a root's rows are spread over several tasks."""
    salt = lambda c: F.pmod(F.xxhash64(c, F.lit(3)), F.lit(SALTS)).cast("int")
    return (rows.withColumn("salt", salt("node"))
            .join(roots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["root", "salt"]).drop("salt"))


def _blocks() -> Column:
    """Blocks of a group of rows with vectors (unit), by their bytes."""
    return F.ceil(F.sum(F.length("unit").cast("long")) / F.lit(BLOCK_BYTES)).alias("blocks")


def _center(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block's center and the largest angle of its vectors to it."""
    x = _matrix(pdf["unit"])
    c = x.sum(0)
    c = c / np.linalg.norm(c) if np.linalg.norm(c) > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ c, -1.0, 1.0)).max())
    return pd.DataFrame({"label": pdf["label"].iloc[:1], "root": pdf["root"].iloc[:1], "blk": pdf["blk"].iloc[:1],
                         "center": [c.tobytes()], "radius": [radius]})


def _reachable(threshold: float):
    """Two parts of a label's blocks (or one with itself): pairs of blocks of two components that may hold a link."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left = pdf[pdf["part"] == one]
        right = left if one == two else pdf[pdf["part"] == two]
        names = ["ir", "ib", "jr", "jb"]
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=names).astype("int64")
        reach = np.arccos(threshold) + 1e-6 + left["radius"].to_numpy()[:, None] + right["radius"].to_numpy()
        near = _matrix(left["center"]) @ _matrix(right["center"]).T >= np.cos(np.minimum(reach, np.pi)) - 1e-9
        near &= left["root"].to_numpy()[:, None] != right["root"].to_numpy()
        i, j = np.nonzero(np.triu(near) if one == two else near)
        return pd.DataFrame(dict(zip(names, (left["root"].to_numpy()[i], left["blk"].to_numpy()[i],
                                             right["root"].to_numpy()[j], right["blk"].to_numpy()[j]))))
    return run


def _closest(threshold: float):
    """Two blocks of two components: their closest pair, if it is a link."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        x, y, best = _matrix(left["unit"]), _matrix(right["unit"]), (threshold, None)
        for s in range(0, len(x), STEP):
            for t in range(0, len(y), STEP):
                sims = x[s:s + STEP] @ y[t:t + STEP].T
                i, j = np.unravel_index(sims.argmax(), sims.shape)
                if sims[i, j] >= best[0]:
                    best = (sims[i, j], (left["node"].iloc[s + i], right["node"].iloc[t + j]))
        return pd.DataFrame([best[1]] if best[1] else [], columns=["a", "b"]).astype("int64")
    return run


def cross_links(nodes: DataFrame, full: DataFrame, members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) that join the components of all links between nodes (a) of ``full``.

    A link that no list holds is one between two full lists. Blocks of such
    nodes are of one component each; one link of two blocks is enough.
    """
    rooted = (nodes.join(full, nodes["node"] == full["a"], "left_semi").join(members, "node", "left")
              .select("node", "label", F.coalesce("root", "node").alias("root"), F.col("exact").alias("unit")))
    sizes = rooted.groupBy("label", "root").agg(_blocks())
    several = sizes.groupBy("label").agg(F.count(F.lit(1)).alias("roots"), F.sum("blocks").alias("all")).filter("roots > 1")
    inside = materialise(_by_root(rooted.drop("label"), sizes.join(several, "label"))
                         .withColumn("blk", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")))
                         .select("node", "label", "root", "unit", "blk", F.ceil(F.col("all") / F.lit(CENTERS)).alias("parts")),
                         "knn-full-blocks")
    centers = materialise(inside.groupBy("root", "blk").applyInPandas(
        tidy_group(_center), "label string, root long, blk long, center binary, radius double"), "knn-centers")
    parts = inside.select("label", "parts").distinct()
    placed = (centers.join(parts, "label").withColumn("part", F.pmod(F.xxhash64("root", "blk"), F.col("parts")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    pairs = materialise(placed.groupBy("label", "i", "j").applyInPandas(
        tidy_group(_reachable(threshold)), "ir long, ib long, jr long, jb long"), "knn-reachable")
    sides = [pairs.join(inside.select(F.col("root").alias(f"{s}r"), F.col("blk").alias(f"{s}b"), "node", "unit"), [f"{s}r", f"{s}b"])
             .select("ir", "ib", "jr", "jb", "node", "unit", F.lit(k).alias("side")) for k, s in enumerate("ij")]
    return (sides[0].unionByName(sides[1]).groupBy("ir", "ib", "jr", "jb")
            .applyInPandas(tidy_group(_closest(threshold)), "a long, b long"))


def _count_blocks(threshold: float):
    """Two blocks of one component (or one with itself): links of each vector to the other block's."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = pdf[pdf["blk"] == one], pdf[pdf["blk"] == two]
        x, y = _matrix(left["unit"]), _matrix(right["unit"])
        mine, theirs = left["copies"].to_numpy(), right["copies"].to_numpy()
        n, m = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        for s in range(0, len(n), STEP):
            for t in range(0, len(m), STEP):
                near = x[s:s + STEP] @ y[t:t + STEP].T >= threshold
                if one == two and s == t:
                    np.fill_diagonal(near, False)
                n[s:s + STEP] += near @ theirs[t:t + STEP]
                if one != two:
                    m[t:t + STEP] += near.T @ mine[s:s + STEP]
        if one == two:
            return pd.DataFrame({"node": left["node"], "n": n})
        return pd.DataFrame({"node": np.concatenate([left["node"], right["node"]]), "n": np.concatenate([n, m])})
    return run


def link_counts(nodes: DataFrame, edges: DataFrame, full: DataFrame, members: DataFrame,
                threshold: float = THRESHOLD) -> DataFrame:
    """node, n (links to other nodes' rows) of every node with links.

    Components with a full list are counted exactly, block by block; others
    from the links (a, b), in both directions.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    dense = full.join(members, full["a"] == members["node"]).select("root").distinct()
    units = materialise(_by_root(members, dense).join(nodes.select("node", F.col("exact").alias("unit"), "copies"), "node"),
                        "knn-units")
    inside = materialise(_by_root(units, units.groupBy("root").agg(_blocks()))
                         .withColumn("blk", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks"))), "knn-dense")
    met = (inside.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")))
    exact = (met.groupBy("root", "i", "j").applyInPandas(tidy_group(_count_blocks(threshold)), "node long, n long")
             .groupBy("node").agg(F.sum("n").alias("n")))
    rest = (both.join(inside.select(F.col("node").alias("a")), "a", "left_anti")
            .join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.sum("copies").alias("n")))
    return exact.unionByName(rest)


def _members(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of links, roots included."""
    cc = connected_components(edges)
    return materialise(cc.unionByName(cc.select(F.col("root").alias("node"), "root").distinct()), "knn-members")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id of every row of (vec_id, embedding, label), and the recall audited, on each row."""
    vectors = vectors.select("vec_id", "embedding", "label")
    nodes = materialise(nodes_of(vectors), "knn-nodes")
    lists, full, recall = neighbour_graph(nodes, threshold)
    edges = materialise(_exact(lists, nodes, threshold), "knn-links")
    members = _members(edges)
    if not full.isEmpty():
        cross = materialise(cross_links(nodes, full, members, threshold), "knn-cross")
        if not cross.isEmpty():
            edges = edges.unionByName(cross)
            members = _members(edges)
    counts = link_counts(nodes, edges, full, members, threshold)
    usable = F.col("label").isNotNull() & _usable(F.col("embedding"))
    rows = vectors.select("vec_id", F.when(usable, F.xxhash64(F.col("label").cast("string"),
                                                              F.col("embedding").cast("array<double>"))).alias("node"))
    known = (nodes.select("node", "copies").join(counts, "node", "left").join(members, "node", "left")
             .select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "node").alias("root")))
    known = materialise(known, "knn-known")
    least = (rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("m")).join(known, "node")
             .groupBy("root").agg(F.min("m").alias("component_id")))
    named = materialise(_by_root(known, least).select("node", "n_links", "component_id"), "knn-named")
    return (rows.join(named, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"), F.lit(recall).alias("recall")))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: links and component of every embedding."""
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
