import math
import random
import re

from tally.llm import licenses as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_places(w):
    return sorted((i, label) for p, label in lic.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def held(template, run):
    """Containment of a template in a run of words; 0 without its required words."""
    need = set(words(template[1]))
    return len(need & set(run)) / len(need) if set(words(" ".join(template[2:]))) <= set(run) else 0.0


def labels_of_runs(w, factor, templates, threshold=0.8):
    """Labels that some run of words meets, whatever word it starts at: runs of ``factor`` times a template's words."""
    out = set()
    for t in templates:
        n = math.ceil(factor * len(words(t[1])))
        if any(held(t, w[a:a + n]) >= threshold - 1e-9 for a in range(max(1, len(w) - n + 1))):
            out.add(t[0])
    return out


def verify(w, blocks, templates):
    """Labels found lie between those of runs as long as the template and of runs four times as long; each block holds."""
    got = {b.label for b in blocks}
    assert labels_of_runs(w, 1, templates) <= got <= labels_of_runs(w, 4, templates)
    for b in blocks:
        run = w[b.start:b.start + b.words]
        assert len(run) == b.words
        assert any(t[0] == b.label and abs(held(t, run) - b.containment) < 1e-9 and held(t, run) >= 0.8 - 1e-9 for t in templates)


BSD = "Redistribution and use in source and binary forms,\n with or without modification, are permitted provided\n" \
      " * that the following conditions are met"
TEXTS = [None, "", "Released under the MIT License.", "x\nMIT license apache license MIT LICENSE\ny",
         "general public license " * 3, "Licensed under CC BY-NC 4.0.", "licensed under cc by nc 4 and 0",
         "word " * 100 + "Licensed under the Apache License, Version 2.0." + " word" * 100,
         "été license mit\x00license mit.license", "This work is licensed under the GNU General Public License, version 3.",
         "the of and to software copy any person\nfree of charge to any person obtaining a copy of this software and associated documentation files",
         "mit license" + " pad" * 50_000 + " apache license", "x " * 61 + BSD, "Released under the Apache License.",
         "Licensed under CC BY 4.0.", "Licensed under the Mozilla Public License, Version 2.0", "Released under\nthe\n\nMIT Licence"]


def test_against_brute_force(spark, small):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in lic.scan_licenses(df).collect():
        w = words(texts[r.doc_id])
        assert r.n_words == len(w)
        assert [(p.start, p.label) for p in r.places] == brute_places(w)
        if len(w) < 20_000:
            verify(w, r.blocks, lic.TEMPLATES)


def test_wrapped_notices_and_other_licenses(spark):
    texts = [BSD, "pad " * 63 + BSD + " pad" * 70, "Released under the Apache License.", "Licensed under CC BY 4.0.",
             "Licensed under the Mozilla Public License, Version 2.0", "Released under\nthe\n\nMIT Licence",
             "released " + "pad " * 40 + "under the mit"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {b.label for b in r.blocks} for r in lic.scan_licenses(df).collect()}
    assert got == {0: {"bsd"}, 1: {"bsd"}, 2: set(), 3: set(), 4: set(), 5: {"mit"}, 6: set()}


def test_long_templates(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(120)}" for _ in range(n)) for n in (150, 90, 7)]
    templates = [(f"t{k}", t) for k, t in enumerate(texts)] + [("many", " ".join(f"v{k}" for k in range(120_000)))]
    rows = ["pad " * rng.randrange(300) + " ".join(w for w in texts[k % 3].split() if rng.random() < keep) + " pad" * 50
            for k in range(30) for keep in (1.0, 0.85)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    seen = lic.scan_licenses(df, templates).collect()
    for r in seen:
        verify(words(rows[r.doc_id]), r.blocks, templates[:3])
    assert all(f"t{r.doc_id // 2 % 3}" in {b.label for b in r.blocks} for r in seen if r.doc_id % 2 == 0)


def test_contract_columns(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in lic.op3_license_scan(spark, str(tmp_path)).collect()}
    assert got[0].n_words == 0 and got[0].first_word is None and got[0].labels == "" and got[0].score == 0
    assert got[3].n_base == 3 and (got[3].first_word, got[3].last_word) == (1, 5)
    assert got[3].base_labels == "apache,mit" and got[4].n_base == 3
    assert got[5].base_labels == "" and got[5].labels == "cc-by-nc" and got[5].score == 1
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got.values())


def test_edges(odd_docs, no_docs):
    assert lic.scan_licenses(odd_docs).count() == odd_docs.count()
    assert lic.scan_licenses(no_docs).count() == 0
