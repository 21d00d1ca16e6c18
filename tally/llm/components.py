"""Connected components of an edge table, by alternating star contractions.

Every round points each node's larger neighbours at its smallest one and then
its smaller neighbours likewise; the edges end as one star per component.
Minima are pre-aggregated before each shuffle, and joins on a hot node's edges
may be split (they are joins, not groups). Before the rounds each task
contracts its own edges, so cliques shrink to stars without a shuffle; if the
contracted edges of all tasks are few enough for one task's bound
(``CONTRACT_EDGES``, counted first), one more contraction ends the work.
Rounds are cut by tables in the shared folder; only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import materialise

#: Edges that a task contracts at a time.
CONTRACT_EDGES = 1_000_000


class Forest:
    """Union-find over any hashable nodes; roots are smallest nodes."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x] = r
            x = p
        return r

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars (center smaller than node), a bounded number at a time."""
    def stars(f: Forest) -> pa.RecordBatch:
        rows = [(n, r) for n in f.up if (r := f.root(n)) != n]
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                               names=["a", "b"])
    f, seen = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f.join(a, b)
        seen += batch.num_rows
        if seen >= CONTRACT_EDGES:
            yield stars(f)
            f, seen = Forest(), 0
    if f.up:
        yield stars(f)


def _large_star(e: DataFrame) -> DataFrame:
    """Larger neighbours of each node, pointed at its smallest neighbour (or itself)."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").filter("b > a and b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """e has a > b: smaller neighbours of each node, and the node, pointed at the smallest."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, bound: int = CONTRACT_EDGES) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``edges`` has long columns ``a`` and ``b``; their order does not matter,
    and loops and repeats are harmless.
    """
    stars = "a long, b long"
    e = materialise(edges.filter("a != b").select("a", "b").mapInArrow(_contract, stars), "cc-0")
    if e.count() < bound:
        done = materialise(e.coalesce(1).mapInArrow(_contract, stars), "cc")
        return done.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        e = materialise(_small_star(_large_star(e)), "cc")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)
