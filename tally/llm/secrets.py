"""Operator 8: secret scan with a recursive decoding worklist.

Each text is the first layer of a worklist. A layer is scanned, and every
encoded part of it becomes another layer: the whole layer with its URL
escapes resolved, the whole layer with its Unicode escapes resolved, and each
base64 run that holds ASCII text (as such, among other bytes, or in UTF-16) or
gzip/zlib streams, also behind other characters of the run or wrapped over
lines. New layers are scanned
and unwrapped in turn until none is left. A layer whose content already stands
among its own ancestors is a cycle and is not entered again. Escapes of escapes
(``%2525...41``) are peeled one by one for ``PEELS`` layers, each of them
scanned; what is nested deeper is resolved to its end in one more layer, so
that the work stays in proportion to the text. Spans found in a
layer are mapped back, step by step, to code points of the original text:
escapes map character by character, a base64 run as a whole, a wrapped one
by whole lines.

Base spans (the original text's own matches) always stay; layers add spans.

Defined cases: null and empty texts have no spans, an empty table no rows. Texts of any length are
scanned whole. A compressed layer that would inflate beyond ``MAX_LAYER``
bytes is not unpacked; its run is reported as a span of kind ``oversize``
instead. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import chunks, id_and_text, table, tidy

# The kinds of secrets in their order, and their patterns.
KINDS = ("assign", "access", "hex", "oversize")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs [0-9a-f]+ of 24 or more characters

URL_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

#: A run wrapped at line breaks (which may be indented), its lines, and what may stand before a payload.
# It begins where a run begins, and nothing in it is tried twice: a long run without a break costs one pass.
WRAPPED_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
SEPARATOR = re.compile(r"[/_-]")
STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
# The shortest secret has 12 characters, all of them ASCII: token=abcdef.
ASCII_RUN = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
WIDE_RUNS = (re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}"), re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){12,}"))

#: Layers of escapes inside escapes that are peeled one at a time.
PEELS = 8
#: An escape of an ASCII character, and what makes its result an escape again.
ONE_ESCAPE = re.compile(r"%[0-7][0-9A-Fa-f]|\\u00[0-7][0-9A-Fa-f]|\\x[0-7][0-9A-Fa-f]")
GOES_ON = {"%": re.compile(r"[0-7][0-9A-Fa-f]"), "\\": re.compile(r"(?:u00|x)[0-7][0-9A-Fa-f]")}

#: Bytes that one compressed layer may inflate to.
MAX_LAYER = 64 << 20

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """(kind, start, end) of each match in one layer."""
    out: list[Span] = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class _Escaped:
    """A layer with escapes resolved, and the way back to the outer layer."""

    def __init__(self, outer: str, resolved: Iterable[tuple[list[tuple[str, int, int]], int, int]]) -> None:
        """``resolved``: (characters with their place and width, start, end) of each part with escapes."""
        parts, self.inner_at, self.outer_at, self.size = [], [], [], []
        at = done = 0
        for characters, begin, end in resolved:
            pieces = [(outer[done:begin], done, 0)] + characters
            done = end
            for piece, start, width in pieces:
                if piece:
                    parts.append(piece)
                    self.inner_at.append(at)
                    self.outer_at.append(start)
                    self.size.append(width)  # 0: copied character by character
                    at += len(piece)
        if done < len(outer):
            parts.append(outer[done:])
            self.inner_at.append(at)
            self.outer_at.append(done)
            self.size.append(0)
        self.text = "".join(parts)

    def back(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.inner_at, start) - 1, bisect_right(self.inner_at, end - 1) - 1
        first = self.outer_at[i] + (0 if self.size[i] else start - self.inner_at[i])
        last = self.outer_at[j] + (self.size[j] or end - self.inner_at[j])
        return first, last


class _Run:
    """A decoded run; all of it maps to the run's place."""

    def __init__(self, text: str, start: int, end: int) -> None:
        self.text, self.place = text, (start, end)

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self.place


def _url(escapes: str, at: int) -> list[tuple[str, int, int]]:
    """Characters of a run of %XX, each with its place and width."""
    data, out, i = bytes.fromhex(escapes.replace("%", "")), [], 0
    while i < len(data):
        width = 1 if data[i] < 0xC0 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
        try:
            piece = data[i:i + width].decode("utf-8")
        except UnicodeDecodeError:
            width, piece = 1, "�"
        width = min(width, len(data) - i)
        out.append((piece, at + 3 * i, 3 * width))
        i += width
    return out


def _unicode(escapes: str, at: int) -> list[tuple[str, int, int]]:
    """Characters of a run of backslash escapes; surrogate pairs are joined."""
    out: list[tuple[str, int, int]] = []
    for m in re.finditer(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})", escapes):
        code, start, width = int(m[1] or m[2], 16), at + m.start(), m.end() - m.start()
        if 0xDC00 <= code < 0xE000 and out and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, first, before = out.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00
            start, width = first, before + width
        out.append((chr(code), start, width))
    return [("�" if 0xD800 <= ord(c) < 0xE000 else c, s, w) for c, s, w in out]


def _once(text: str, pattern: re.Pattern, decode) -> _Escaped:
    """The layer with every escape resolved once."""
    return _Escaped(text, ((decode(m[0], m.start()), m.start(), m.end()) for m in pattern.finditer(text)))


def _chains(text: str) -> Iterator[tuple[list[tuple[str, int, int]], int, int]]:
    """Escapes of ASCII characters, each followed as far as its result makes an escape with what comes next."""
    at = 0
    while (m := ONE_ESCAPE.search(text, at)) is not None:
        at, char = m.end(), chr(int(m[0][-2:], 16))
        while char in GOES_ON and (more := GOES_ON[char].match(text, at)) is not None:
            at, char = more.end(), chr(int(more[0][-2:], 16))
        yield [(char, m.start(), at - m.start())], m.start(), at


def _readable(data: bytes) -> list[str]:
    """The texts of a decoded layer that can hold a secret.

    Secrets and encoded parts are ASCII, so whatever else stands in the layer
    does not matter: a layer with a long enough ASCII run is read whole, and
    ASCII in UTF-16 of either byte order is read from its runs.
    """
    out = []
    if ASCII_RUN.search(data):
        out.append(data.decode("utf-8", "replace"))
    for wide in WIDE_RUNS:
        if found := wide.findall(data):
            out.append("\n".join(x.replace(b"\0", b"").decode("ascii") for x in found))
    return out


def _inflate(data: bytes, limit: int) -> tuple[bytes, int] | None:
    """The content of gzip or zlib streams, one behind the other, and the bytes read; None if there is none; OverflowError beyond ``limit``."""
    out, size = [], len(data)
    while _starts(data):
        try:
            d = zlib.decompressobj(wbits=47)
            part = d.decompress(data, limit + 1)
        except zlib.error:
            break
        limit -= len(part)
        if limit < 0 or d.unconsumed_tail:
            raise OverflowError
        if not d.eof:
            break
        out.append(part)
        data = d.unused_data.lstrip(b"\0")
    return (b"".join(out), size - len(data)) if out else None


def _starts(data: bytes, k: int = 0) -> bool:
    """Whether a gzip or zlib stream may start at a place."""
    return data[k:k + 2] == b"\x1f\x8b" or (len(data) > k + 2 and data[k] & 15 == 8 and (data[k] << 8 | data[k + 1]) % 31 == 0)


def _unpack(run: str, limit: int, starts: list[int]) -> list[tuple[str, int, int]]:
    """Texts inside a base64 run, compressed or not, each with the part of the run that holds it.

    The run is decoded at all four alignments, so a payload may stand behind
    other characters of the run. Compressed streams are looked for by their
    first bytes, and at ``starts`` and behind each separator.
    """
    body = run.rstrip("=")
    starts = sorted({0, *starts, *(m.end() for m in SEPARATOR.finditer(body))})
    body = body.replace("-", "+").replace("_", "/")
    out: list[tuple[str, int, int]] = []
    for shift in range(min(4, len(body))):
        part = body[shift:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        for m in ASCII_RUN.finditer(data):
            out.append((m[0].decode("ascii"), shift + m.start() * 4 // 3, shift - (-m.end() * 4 // 3)))
        if any(wide.search(data) for wide in WIDE_RUNS):
            out += [(x, shift, len(run)) for x in _readable(data)]
        places = {(k - shift) // 4 * 3 for k in starts if k >= shift and (k - shift) % 4 == 0}
        places.update(m.start() for m in STREAM.finditer(data))
        done = 0
        for k in sorted(places):
            if k < done or not _starts(data, k) or (inner := _inflate(data[k:], limit)) is None:
                continue
            content, done = inner
            done += k
            while (inner := _inflate(content, limit)) is not None:  # streams inside streams
                content = inner[0]
            out += [(x, shift + k * 4 // 3, min(len(run), shift - (-done * 4 // 3))) for x in _readable(content)]
    return out


def layers_of(text: str, limit: int, peeled: int = 0) -> tuple[list[_Escaped | _Run], list[Span]]:
    """The layers directly inside a layer, and runs too large to unpack; ``peeled`` layers of escapes are around it."""
    out: list[_Escaped | _Run] = []
    large: list[Span] = []
    if peeled >= PEELS and ONE_ESCAPE.search(text):
        out.append(_Escaped(text, _chains(text)))
    else:
        if "%" in text and URL_ESCAPES.search(text):
            out.append(_once(text, URL_ESCAPES, _url))
        if "\\" in text and UNICODE_ESCAPES.search(text):
            out.append(_once(text, UNICODE_ESCAPES, _unicode))
    for m in BASE64_RUN.finditer(text):
        try:
            out += [_Run(x, m.start(), m.end()) for x, _, _ in _unpack(m[0], limit, [])]
        except OverflowError:
            large.append(("oversize", m.start(), m.end()))
    for m in WRAPPED_RUN.finditer(text):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in BASE64_LINE.finditer(m[0])]
        run = "".join(text[a:b] for a, b in lines)
        if len(run) < 16:
            continue
        heads = [0]
        for a, b in lines:
            heads.append(heads[-1] + b - a)
        line_of = lambda k: bisect_right(heads, k, 0, len(lines)) - 1
        try:
            inner = _unpack(run, limit, heads[:-1])
        except OverflowError:
            large.append(("oversize", m.start(), m.end()))
            continue
        out += [_Run(x, lines[line_of(a)][0], lines[line_of(b - 1)][1]) for x, a, b in inner]
    return out, large


def find(text: str, limit: int = MAX_LAYER) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of one text, each sorted by start and kind."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = scan(text)
    spans = set(base)
    # A layer, the layers from the outermost to it, and how many of the last were escapes.
    work: list[tuple[str, tuple, int]] = [(text, (), 0)]
    seen: set[tuple[str, tuple[int, int]]] = set()
    while work:
        layer, way, peeled = work.pop()
        inner, large = layers_of(layer, limit, peeled)
        found = [(large, way)]
        for x in inner:
            if x.text == text or any(x.text == w.text for w in way):
                continue  # a cycle
            place = x.back(0, len(x.text))
            for step in reversed(way):
                place = step.back(*place)
            if (key := (x.text, place)) in seen:
                continue  # reached before on another way
            seen.add(key)
            found.append((scan(x.text), (*way, x)))
            work.append((x.text, (*way, x), peeled + 1 if isinstance(x, _Escaped) else 0))
        for hits, path in found:
            for kind, start, end in hits:
                for step in reversed(path):
                    start, end = step.back(start, end)
                spans.add((kind, start, end))
    return sorted(base, key=order), sorted(spans, key=order)



SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, limit: int = MAX_LAYER) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end) for every row."""
    span = "array<struct<kind:string,start:long,end:long>>"
    ids = id_and_text(docs)
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole):
                found = [find(t or "", limit) for t in b.column(1).to_pylist()]
                cols = [[[{"kind": k, "start": s, "end": e} for k, s, e in f[i]] for f in found] for i in (0, 1)]
                yield pa.record_batch([b.column(0), *(pa.array(c, SPAN_TYPE) for c in cols)],
                                      names=["doc_id", "base", "spans"])
    return ids.mapInArrow(tidy(run), f"doc_id {kind}, base {span}, spans {span}")


def redact(docs: DataFrame, marker: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found replaced by ``marker`` in its text.

    All rows and columns stay; ``n_chars``, where there is one, is the new
    text's length. Null texts stay null.
    """
    def clean(text: str) -> str:
        _, spans = find(text)
        out, at = [], 0
        for _, start, end in spans:
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], marker]
            at = end
        return "".join([*out, text[at:]]) if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole):
                i = b.schema.get_field_index("text")
                new = pa.array([None if t is None else clean(t) for t in b.column(i).to_pylist()], b.schema.field(i).type)
                yield pa.record_batch([new if k == i else b.column(k) for k in range(b.num_columns)], schema=b.schema)
    out = docs.mapInArrow(tidy(run), docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: counts and digest of the base spans, and all spans, of every document."""
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(line("base").cast("binary"), 256).alias("base_sha256"), line("spans").alias("spans"))
