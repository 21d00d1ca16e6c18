import numpy as np
import pytest

from tally.llm import embedding_links as el
from tally.llm.components import Forest


def brute(rows, threshold=0.98):
    f, links = Forest(), [0] * len(rows)
    usable = []
    for k, (_, v, label) in enumerate(rows):
        good = v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, float) / np.linalg.norm(v) if good else None)
    for i in range(len(rows)):
        for j in range(i):
            a, b = usable[i], usable[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                f.join(i, j)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        r = f.root(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, links[k], least.get(f.root(k), i)) for k, (i, _, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in el.near_vectors(df).collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, node int, sim int, root int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, 1, 2) for r in rows], SCHEMA).repartition(4)


def clusters(seed, sizes, dims=16, spread=0.02, alone=100):
    rng = np.random.default_rng(seed)
    rows = []
    for c, size in enumerate(sizes):
        center = rng.standard_normal(dims)
        center /= np.linalg.norm(center)
        for _ in range(size):
            v = center + spread * rng.standard_normal(dims)
            rows.append((v * rng.uniform(0.5, 3), c % 3))
    rows += [(rng.standard_normal(dims), int(rng.integers(3))) for _ in range(alone)]
    rows += rows[:20]  # equal vectors
    order = rng.permutation(len(rows))
    return [(k, [float(np.float32(x)) for x in rows[o][0]], rows[o][1]) for k, o in enumerate(order)]


def test_clusters_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(el, "BLOCK_BYTES", 30 * 16 * 8)
    monkeypatch.setattr(el, "STEP", 7)
    rows = clusters(3, (2, 2, 3, 5, 9, 20, 90))
    assert result(frame(spark, rows)) == brute(rows)


def near_clusters(seed, size, dims=16, spread=0.01, cos=0.982):
    """Two tight clusters of one label: links across are weaker than ``size`` links inside."""
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((dims, 2)))
    centers = (q[:, 0], cos * q[:, 0] + np.sqrt(1 - cos * cos) * q[:, 1])
    return [(k, [float(np.float32(x)) for x in centers[k % 2] + spread * rng.standard_normal(dims)], 0) for k in range(2 * size)]


@pytest.mark.parametrize("block", [8192, 25])
def test_links_between_full_lists(spark, monkeypatch, block):
    monkeypatch.setattr(el, "BLOCK_BYTES", block * 16 * 8)
    monkeypatch.setattr(el, "CENTERS", 2)
    rows = near_clusters(1, 75)
    want = brute(rows)
    assert {c for _, _, c in want} == {0}
    assert result(frame(spark, rows)) == want


def test_component_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(el, "BLOCK_BYTES", 25 * 16 * 8)
    monkeypatch.setattr(el, "STEP", 10)
    rows = clusters(9, (600, 12), spread=0.01)
    assert result(frame(spark, rows)) == brute(rows)
    assert {r.recall for r in el.near_vectors(frame(spark, rows)).select("recall").distinct().collect()} == {1.0}


def test_short_recall_is_made_up_for(spark, monkeypatch):
    monkeypatch.setattr(el, "audit", lambda *a, **k: (0, 1))
    monkeypatch.setattr(el, "descend", lambda nodes, keep, start, count, threshold: el._top(start, keep).limit(3))
    monkeypatch.setattr(el, "ORDERS", 1)
    rows = clusters(5, (3, 9), alone=30)
    assert result(frame(spark, rows)) == brute(rows)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0),
            (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0),
            (11, [1.0, float("inf"), 3.0], 0), (12, [1.0, 2.0], 0), (13, [1.0, 2.0], 0), (14, v, 0), (14, v, 0),
            (None, v, 0), (None, [3.0, -1.0, 0.0], 2), (15, [-1.0, -2.0, -3.0], 0)]
    assert result(frame(spark, rows)) == brute(rows)
    assert result(frame(spark, [])) == []


@pytest.mark.parametrize("seed", [7])
def test_audit_asks_brute_force(spark, seed):
    rows = clusters(seed, (4, 6), alone=40)
    nodes = el.materialise(el.nodes_of(frame(spark, rows)), "test-nodes")
    lists, _, recall = el.neighbour_graph(nodes)
    assert recall == 1.0
    found, there = el.audit(nodes, lists.limit(0), el.THRESHOLD)
    assert found == 0 and there > 0


def test_whole_small_table(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in el.op7_nn_descent(spark, small).collect()), key=str)
    assert got == brute(rows)
