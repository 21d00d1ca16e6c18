from pyspark.sql import functions as F

from tally.llm import toxicity as tox


def test_folding():
    assert tox.fold("ІDІОТ") == "idiot"  # Cyrillic letters
    assert tox.fold("1d10t m0r0n $tup!d") == "idiot moron stupid"
    assert tox.fold("ｉｄｉｏｔ") == "idiot"
    assert tox.fold("8548923 0.5 a$$$ 10!!") == "8548923 0.5 a$$$ 10!!"


def test_matching():
    lex = tox.Lexicon((("idiot", 2.0, True), ("clown", 1.0, False), ("trash", 1.5, True)))
    m = tox.Matcher(lex)
    assert m("an 1diot, IDIOTS!!") == (3, 2, 4.0)
    assert m("clowns clown aclown") == (3, 1, 1.0)
    assert m("put it in the trash can now") == (7, 0, 0.0)
    assert m("the clown fish") == (3, 0, 0.0)
    assert m("trash") == (1, 1, 1.5)
    assert m("") == (0, 0, 0.0)
    assert m("idiot " * 40_000)[1] == 40_000


def test_learning_and_edges(spark, odd_docs, no_docs):
    name = lambda k, i: k + "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(i, ("nice words here " * 5 + f"zorgle{'abcde'[i % 5]} {name('w', i)} {name('v', i)}") if i % 4 == 0 else f"nice words here and there {name('w', i)} {name('u', i)}")
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (3, None), (5, 7)],
                                   "doc_id long, label int")
    model = tox.fit(docs, labels, tox.training_row)
    assert any(t.startswith("zorg") for t, _, _ in model.lexicon.terms)
    got = {r.doc_id: r.score for r in tox.score(docs, model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    odd = tox.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert tox.score(no_docs, model).count() == 0
    none = tox.fit(odd_docs, labels.limit(0), tox.training_row)  # no labels at all
    scores = {r.text: r.score for r in tox.score(spark.createDataFrame([(1, "you idiot"), (2, "hello there")],
                                                                       "doc_id long, text string"), none)
              .join(spark.createDataFrame([(1, "bad"), (2, "good")], "doc_id long, text string"), "doc_id").collect()}
    assert scores["bad"] > 0.3 > scores["good"]
    kept = tox.drop_toxic(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = tox.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n = out.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("acc"),
                F.sum(((F.col("toxic") == 0) & (F.col("predicted") == 1)).cast("int")).alias("fp")).first()
    assert n.acc > 0.93 and n.fp == 0
