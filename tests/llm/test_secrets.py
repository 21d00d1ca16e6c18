import base64
import gzip
import re
import urllib.parse
import zlib

import pytest

from tally.llm import secrets

SECRET = 'token = "abcdef123456"'


def plain_base(text):
    """The base spans by the patterns as they are worded."""
    out = []
    a = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", *m.span()) for m in re.finditer(a, text, re.I | re.A) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0]), s[2]))


WRAPS = {
    "url": lambda s: urllib.parse.quote(s, safe=""),
    "url twice": lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "base64 twice": lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
    "url-safe base64": lambda s: base64.urlsafe_b64encode(("~~~???" + s).encode()).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib in base64 in zlib": lambda s: base64.b64encode(zlib.compress(base64.b64encode(zlib.compress(s.encode())))).decode(),
    "base64 in url": lambda s: urllib.parse.quote(base64.b64encode((s + "~~").encode()).decode(), safe=""),
}


@pytest.mark.parametrize("name", WRAPS)
def test_layers_are_unwrapped_and_mapped(name):
    inner = WRAPS[name](SECRET)
    text = "näive words " + inner + " and more"
    base, spans = secrets.find(text)
    assert base == plain_base(text)
    assert any(k == "assign" and 12 <= a < b <= 12 + len(inner) for k, a, b in spans)


BYTES = {
    "no-break space": f"a\u00a0b {SECRET}".encode(), "soft hyphen": f"so\u00adft {SECRET}".encode(),
    "byte order mark": f"\ufeff{SECRET}".encode(), "zero-width": f"\u200b\u200d{SECRET}".encode(),
    "nul": b"\0" + SECRET.encode() + b"\0", "latin-1": b"\xe9t\xe9 " + SECRET.encode(),
    "binary": bytes(range(256)) + SECRET.encode() + b"\xff\x00", "utf-16": SECRET.encode("utf-16"),
    "utf-16-le": SECRET.encode("utf-16-le"), "utf-16-be": SECRET.encode("utf-16-be"),
    "second gzip member": gzip.compress(b"first words\n") + gzip.compress(SECRET.encode()),
    "padded zlib": zlib.compress(b"first\n") + b"\0\0" + zlib.compress(SECRET.encode()),
}


@pytest.mark.parametrize("name", BYTES)
def test_layers_with_other_bytes(name):
    inner = base64.b64encode(BYTES[name]).decode()
    _, spans = secrets.find("x " + inner + " y")
    assert ("assign", 2, 2 + len(inner)) in spans


LONG = "".join(f"line {k * 7919} of the file\n" for k in range(12)) + SECRET + "\nand the rest of it"
PACKED = {"plain": LONG.encode(), "gzip": gzip.compress(LONG.encode()), "zlib": zlib.compress(LONG.encode())}


@pytest.mark.parametrize("name", PACKED)
@pytest.mark.parametrize("before,after", [("a\n\n", "\n\nb"), ("see\n", "\nnext words"), ("key: ", " b")])
@pytest.mark.parametrize("width,end", [(64, "\n"), (76, "\r\n"), (6, "\n"), (40, "\n    ")])
def test_wrapped_runs(name, before, after, width, end):
    whole = base64.b64encode(PACKED[name]).decode()
    inner = end.join(whole[k:k + width] for k in range(0, len(whole), width))
    spans = [s for s in secrets.find(before + inner + after)[1] if s[0] == "assign"]
    assert any(a < len(before) + len(inner) and b > len(before) for _, a, b in spans)


@pytest.mark.parametrize("name", PACKED)
@pytest.mark.parametrize("before", ["https://h.example/", "https://h.example/a/bc/", "key_", "id-", "a_b-cd/", "xyz"])
def test_runs_behind_other_characters(name, before):
    if before == "xyz" and name == "zlib":
        before = "wxyz"
    text = before + base64.b64encode(PACKED[name]).decode() + " b"
    assert any(k == "assign" and b == len(text) - 2 for k, _, b in secrets.find(text)[1])


def test_members_together_are_bounded():
    two = base64.b64encode(zlib.compress(b"0" * 700) + zlib.compress(b"0" * 700)).decode()
    assert secrets.find("x " + two, limit=1000)[1][0][0] == "oversize"


def test_character_spans():
    text = "a %74oken%3dabcdefgh z"
    assert secrets.find(text)[1] == [("assign", 2, 20)]
    text = "x \\u0074oken=secret99 \\ud83d\\ude00"
    assert ("assign", 2, 21) in secrets.find(text)[1]


def test_cycles_and_bounds():
    assert secrets.find("%25" * 50 + "41")[1] == []
    bomb = base64.b64encode(zlib.compress(b"0" * 100_000)).decode()
    assert secrets.find("x " + bomb, limit=1000)[1][0][0] == "oversize"
    both = "%5Cu0025" * 12 + "\\u0025" * 12  # escapes of either kind inside each other
    assert secrets.find(both)[1] == []


@pytest.mark.parametrize("text", [
    "", "token=abc password: token = abcdefg", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAshort AKIA" + "9Z" * 10,
    "ab" * 11 + "a", "ab" * 12, "API_KEY: 'x-y_z.1234'", "Passwd='aaaaaa'token:bbbbbb", "apikey = = abcdef",
    "ſecret=abcdef toKen=abcdef"])
def test_base_patterns(text):
    assert secrets.find(text)[0] == plain_base(text)


def test_frames(odd_docs, no_docs, spark):
    assert secrets.scan_secrets(odd_docs).count() == odd_docs.count()
    assert secrets.scan_secrets(no_docs).count() == 0
    df = spark.createDataFrame([(1, f"a {SECRET} b", 9, None), (2, None, None, 3)],
                               "doc_id long, text string, n_chars long, spans int")
    out = {r.doc_id: r for r in secrets.redact(df).collect()}
    assert out[1].text == "a [SECRET]\" b" and out[1].n_chars == 13 and out[2].text is None and out[2].spans == 3


def test_whole_small_table(spark, small):
    rows = {r.doc_id: r for r in secrets.op8_secret_scan(spark, small).collect()}
    import hashlib
    for d in spark.read.parquet(f"{small}/documents.parquet").collect():
        base = plain_base(d.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = rows[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert not base or set(text.split(",")) <= set(r.spans.split(","))


NESTS = {
    "url": lambda n, c: "%" + "25" * n + f"{ord(c):02x}",
    "unicode": lambda n, c: "\\" + "u005c" * n + f"u{ord(c):04x}",
    "byte": lambda n, c: "\\" + "x5c" * n + f"x{ord(c):02x}",
    "both": lambda n, c: "%" + "5cx25" * n + f"{ord(c):02x}",
}


@pytest.mark.parametrize("name", NESTS)
@pytest.mark.parametrize("depth", [1, 7, 9, 40, 3_000])
def test_deeply_nested_escapes(name, depth):
    """Every depth is resolved to its end, in time that follows the text's length."""
    import time
    nest = NESTS[name]
    text = "é pass" + nest(depth, "w") + "ord" + nest(depth, "=") + "abc" + nest(depth, "d") + "ef? " + nest(depth, "%") + "zz"
    began = time.process_time()
    base, spans = secrets.find(text)
    assert time.process_time() - began < 3
    assert base == plain_base(text)
    assert ("assign", 2, text.index("ef?") + 2) in spans


def test_long_runs_take_time_in_proportion():
    import time
    for text in ("%" + "25" * 10_000 + "41", "a" * 200_000, "ab\n" * 50_000, "%2525" * 20_000, "\\u005c" * 20_000):
        began = time.process_time()
        base, _ = secrets.find(text)
        assert time.process_time() - began < 5 and base == plain_base(text)


def test_escapes_of_other_characters_inside_nests():
    text = "caf%25C3%25A9 " + urllib.parse.quote(urllib.parse.quote("ö " + SECRET)) + " %" + "25" * 20 + "C3%" + "25" * 20 + "A9"
    _, spans = secrets.find(text)
    start = text.index("token")
    assert any(k == "assign" and a == start for k, a, b in spans)
