import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from tally.llm.filter_audit import OP11_SQL, audit

DOC = "doc_id long, text string, lang string, source string, mask int, hash string"
LABEL = "doc_id long, quality int, toxic int, part string"
LONG = " ".join(f"w{k}" for k in range(60))


def brute(docs, labels):
    """(part, order, step) -> the seven counts, document by document."""
    good = {i for i, q, t, *_ in labels if i is not None and q == 1}
    toxic = {i for i, q, t, *_ in labels if i is not None and t == 1}
    failing = []
    for i, text, _, part, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = ""
        if len(words) < 50:
            bad += "A"
        if 100 * len(set(words)) < 65 * len(words):
            bad += "B"
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            bad += "C"
        if re.search(r"[#$%&*|]", text):
            bad += "D"
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs):
            bad += "E"
        failing.append((part or "", bad, i in good, i in toxic))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        left = failing
        for step, f in enumerate(order, 1):
            gone = [d for d in left if f in d[1]]
            left = [d for d in left if f not in d[1]]
            kept, removed = Counter(d[0] for d in left), Counter(d[0] for d in gone)
            failed = Counter(d[0] for d in failing if f in d[1])
            alone = Counter(d[0] for d in failing if d[1] == f)
            g, t = Counter(d[0] for d in gone if d[2]), Counter(d[0] for d in gone if d[3])
            for p in {d[0] for d in failing}:
                out[p, order, step] = [kept[p], removed[p], failed[p] - removed[p], alone[p], g[p], t[p]]
    shapley = Counter()
    for (p, order, step), row in out.items():
        shapley[p, order[step - 1]] += row[1]
    return {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def found(spark, docs, labels):
    rows = audit(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)).collect()
    return {tuple(r[:3]): list(r[3:]) for r in rows}


DOCS = [
    (1, LONG, "en", "a", 0, "x"),
    (2, LONG, "en", "a", 0, "x"),                       # a copy in its own part
    (3, LONG + " #", None, "b", 0, "x"),
    (4, LONG + " #", None, None, 0, "x"),                # null source, copy of another part's text
    (5, "same " * 60, "en", "a", 0, "x"),
    (6, "SHOUT " * 60, "en", "a", 0, "x"),
    (7, None, "en", "b", 0, "x"),
    (8, "", "en", "b", 0, "x"),                          # null and empty text are equal
    (8, LONG.upper(), "en", "b", 0, "x"),                # an id twice, other text
    (9, LONG, "en", "", 0, "x"), (9, LONG, "en", "", 0, "x"),   # a whole row twice
    (None, LONG, "en", "a", 0, "x"),                     # without id: never a copy
    (None, "no id & short", "en", "a", 0, "x"),
    (10, "é" * 40 + " AB", "en", "a", 0, "x"),           # code points, not bytes
    (11, " ".join(["x"] * 35 + [f"v{k}" for k in range(64)] + ["y"]), "en", "a", 0, "x"),
    (12, "line break kept " + LONG + "\x0b\x0c\x1c", "en", "a", 0, "x"),
    (13, "many words in one very long text " * 20_000, "en", "a", 0, "x"),
]
LABELS = [(1, 1, 0, "p"), (2, 1, 1, "p"), (4, 0, 1, "p"), (8, None, 1, "p"), (9, 1, None, "p"), (9, 0, 0, "p"),
          (None, 1, 1, "p"), (99, 1, 1, "p")]


def test_against_brute_force(spark):
    assert found(spark, DOCS, LABELS) == brute(DOCS, LABELS)


def test_large_group_of_copies(spark):
    docs = [(k, LONG, "en", "hot" if k % 3 else "cold", 0, "x") for k in range(400)]
    assert found(spark, docs, LABELS) == brute(docs, LABELS)


def test_empty_tables(spark):
    assert found(spark, [], LABELS) == {}
    assert found(spark, DOCS[:3], []) == brute(DOCS[:3], [])


def test_equals_sql(spark):
    rows = [d for d in DOCS if d[0] is not None]
    docs, labels = spark.createDataFrame(rows, DOC), spark.createDataFrame(LABELS, LABEL)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    want = {tuple(r[:3]): list(r[3:]) for r in con.sql(OP11_SQL).fetchall()}
    assert {tuple(r[:3]): list(r[3:]) for r in audit(docs, labels).collect()} == want


@pytest.mark.parametrize("part", ["a", "b", ""])
def test_shares_add_up(spark, part):
    """A filter's shares over all orders are all removals, whatever the order."""
    rows = {k: v for k, v in found(spark, DOCS, LABELS).items() if k[0] == part}
    removed = sum(v[1] for v in rows.values())
    assert removed == sum({k[1][k[2] - 1]: v[6] for k, v in rows.items()}.values())
