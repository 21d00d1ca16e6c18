import collections
import itertools
import random

from tally.llm import url_rules as ur

URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.net", "http://example.net/en/1", "http://a.example.net/de/2",
        "http://x.net?q=/en/", "https://sub.example.com/de/x#f", "http://example.com/en/x", "http://notexample.com/de/",
        "ftp://a.b.org/fr/", "http://org/fr/x", "http://a.org/FR/x", "x://y://z.net/", "http://h.net#/en/", "http://ÄÖ.net/",
        "http://q.com/?a=1&b=2&a=3", "http://" + "a." * 3000 + "net/" + "p/" * 3000]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    best = (None, None)
    for rule, verdict in ur.RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_base_rules(spark):
    df = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in ur.filter_urls(df).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    assert all(got[i].verdict == "allow" for i in (0, 1, 2))


def brute_rules(rows, min_support, min_confidence):
    """All subsets of all rows, counted."""
    n, count = len(rows), collections.Counter()
    for tokens, label in rows:
        for k in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), k):
                count[c] += 1
                count[c, label] += 1
    rules = {}
    for key, c in count.items():
        if len(key) == 2 and isinstance(key[0], tuple) and c >= min_support * n - 1e-9 and c / count[key[0]] >= min_confidence:
            rules[key] = (c / count[key[0]], c / n)
    return {k: v for k, v in rules.items()
            if not any(s != k[0] and set(s) < set(k[0]) and label == k[1] and v2[0] >= v[0]
                       for (s, label), v2 in rules.items())}


def test_mining_and_matching_against_brute_force(spark):
    rows = [(["a", "b"], "block")] * 6 + [(["a", "c"], "allow")] * 5 + [(["b", "c"], "block")] * 4 + \
           [(["a", "b", "c"], "block")] * 3 + [(["d"], "allow")] * 2 + [(["a"], "allow")] * 2
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    mined = ur.mine(df, 0.09, 0.7)
    got = {(tuple(r.antecedent), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in mined.collect()}
    want = {k: (round(a, 9), round(b, 9)) for k, (a, b) in brute_rules(rows, 0.09, 0.7).items()}
    assert got == want and got
    sets = [["a"], ["b"], ["c"], ["d"], ["a", "c"], ["a", "b", "c"], ["b", "d"], ["e"]]
    frame = spark.createDataFrame([(" ".join(s), s) for s in sets], "key string, tokens array<string>")
    found = {r.key: (r.mined, r.mined_verdict) for r in ur.match(frame, mined).collect()}
    for s in sets:
        fits = [((c, p, len(t), " ".join(t), v), (" ".join(t), v)) for (t, v), (c, p) in brute_rules(rows, 0.09, 0.7).items()
                if set(t) <= set(s)]
        assert found.get(" ".join(s)) == (max(fits)[1] if fits else None)


def brute_best(rules, tokens):
    fits = [((c, p, len(t), " ".join(t), v), (" ".join(t), v)) for (t, v), (c, p) in rules.items() if set(t) <= set(tokens)]
    return max(fits)[1] if fits else None


def test_tokens_that_occur_together(spark):
    rng = random.Random(8)
    groups = [["a", "b", "c"], ["d"], ["e", "f"], ["g"], ["h", "i"]]
    rows = []
    for _ in range(120):
        tokens = sorted(t for g in groups if rng.random() < 0.5 for t in g)
        blocked = "a" in tokens and "d" in tokens or "h" in tokens or rng.random() < 0.15 and "g" not in tokens
        rows.append((tokens, "block" if blocked else "allow"))
    rules, classes = ur.mine_classes(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.6)
    want = brute_rules(rows, 0.05, 0.6)
    alike = {}
    for r in classes.collect():
        alike.setdefault(r["item"], []).append(r.token)
    assert sorted(map(sorted, alike.values())) == sorted(groups)
    got = {(tuple(sorted(c)), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in rules.collect()
           for c in itertools.product(*(alike[i] for i in r.antecedent))}
    assert got == {k: (round(c, 9), round(p, 9)) for k, (c, p) in want.items()}
    sets = [sorted(rng.sample("abcdefghij", rng.randrange(1, 7))) for _ in range(60)]
    sets = [list(s) for s in sorted({tuple(s) for s in sets})]
    found = {r.key: (r.mined, r.mined_verdict) for r in ur.match(
        spark.createDataFrame([(" ".join(s), s) for s in sets], "key string, tokens array<string>"), rules, classes).collect()}
    for s in sets:
        assert found.get(" ".join(s)) == brute_best(want, s)


def test_repeated_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ur, "PART", 4)
    items = spark.createDataFrame([(["a"], 11), (["b", "c"], 4), ([], 1)], "items array<string>, n long")
    got = collections.Counter(tuple(r["items"]) for r in ur.repeated(items, 16).collect())
    assert got == {("a",): 11, ("b", "c"): 4, (): 1}


def test_long_urls_of_one_template(spark):
    deep = "/".join(f"s{k}" for k in range(40))
    urls = [f"http://www.a.net/{deep}/{k}" for k in range(30)] + [f"http://www.a.com/{deep}/{k}" for k in range(10)] + \
           [f"http://b.example.com/de/{deep}/{k}" for k in range(3)] + [f"http://c.example.net/en/{deep}" for k in range(9)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in ur.filter_urls(df).collect()}
    assert all(got[k].verdict == "block" and got[k].rule == "net/" for k in range(30))
    assert all(got[k].rule is None and got[k].mined for k in range(30, 40))


def test_edges(spark, small):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert ur.filter_urls(empty).count() == 0
    unruled = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x")], "page_id long, url string")
    assert [r.verdict for r in ur.filter_urls(unruled).collect()] == ["allow", "allow"]
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: r for r in ur.op2_url_rules(spark, small).collect()}
    for r in pages.collect():
        host, path, rule, verdict = plain(r.url)
        assert (got[r.page_id].host, got[r.page_id].path, got[r.page_id].rule) == (host, path, rule)
        assert rule is None or got[r.page_id].verdict == verdict
