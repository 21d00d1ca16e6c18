import collections
import hashlib

import numpy as np
import pytest

from tally.llm import exact_dedup, fuse


def brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        out.append((i, max(ids) if ids else None, len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 5000, 60_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2**63, 2**63 - 1, n)
    f = fuse.build(np.concatenate([keys, keys[:10]]))
    assert fuse.contains(keys, *f).all()
    others = np.setdiff1d(rng.integers(-2**63, 2**63 - 1, 20_000), keys)
    if n >= 50:
        assert fuse.contains(others, *f).mean() < 0.01
        assert len(f[3]) < 2.2 * n + 200


def test_groups_on_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex())
                  for r in exact_dedup.exact_groups(odd_docs).collect()), key=str)
    assert got == brute(rows)


def test_drop_copies(odd_docs, no_docs):
    out = exact_dedup.drop_copies(odd_docs)
    assert out.columns == odd_docs.columns
    kept = [(r.doc_id, r.text or "") for r in out.collect()]
    assert len(kept) == len(set(kept)) == len({t for _, t in kept})
    assert {t for _, t in kept} == {r.text or "" for r in odd_docs.collect()}
    assert exact_dedup.drop_copies(no_docs).count() == 0
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_hot_group(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) as text")
    got = exact_dedup.exact_groups(df).groupBy("group_size").count().collect()
    assert {(r["group_size"], r["count"]) for r in got} == {(1000, 1000), (1, 2000)}


def test_every_split_gives_the_same(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, "abcde"[i % 5] * (i % 3)) for i in range(40)], "doc_id long, text string")
    want = sorted(exact_dedup.exact_groups(df).collect())
    for cond in (F.lit(True), F.lit(False), F.col("doc_id") < 7):
        assert sorted(exact_dedup.exact_groups(df, cond).collect()) == want
