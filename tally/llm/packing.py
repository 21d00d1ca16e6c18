"""Operator 1: packing along a space-filling curve.

Every document becomes ids; its ids are hashed to a count vector, logged and
normalised, and projected by a fixed random matrix to three dimensions. The
Hilbert key of that point orders all documents: texts alike lie close on the
curve. Documents are range-partitioned and sorted by (key, id), and each
partition's stream of ids is cut into sequences of 4096 ids. What is left at a
partition's end is cut into sequences whose lengths are powers of two, so no
sequence needs padding.

Ids are made once and written once (two bytes each); one range shuffle moves
them. A key or source with many rows is no group here: ranges also split by
id. No task holds more than a batch and the current sequence.

Defined cases: null and empty texts are the end id alone. Texts of any length
are cut where sequences end. Repeated rows are packed each. Equal ids and keys
are ordered by the ids' checksum. Columns other than id and text are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tally.llm.common import chunks, id_and_text, materialise, table, tidy
from tally.llm.wordmemo import WordMemo

SEQUENCE = 4096
END_ID = 2
BUCKETS, DIMENSIONS, BITS = 1024, 3, 16

# Lower-case Latin letters and then ASCII signs other than the apostrophe:
# the tokenizer's own rules split such a word exactly there.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# Byte-level vocabularies write a byte without a printable Latin-1 sign as the next sign from U+0100 on.
_SIGNLESS = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_SIGN = {b: 0x100 + i for i, b in enumerate(_SIGNLESS)}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def word_encoder(path: str):
    """encode(words) for a word-level BPE of the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    model = t.model
    known: dict[str, list[int]] = {}  # runs of signs

    def encode(words: Sequence[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        rest = []
        plain, tokens = _PLAIN.fullmatch, model.tokenize
        for k, w in enumerate(words):
            if not (m := plain(w)):
                rest.append(k)
                continue
            letters, signs = m.groups()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(_BYTE_SIGN)
            ids = [x.id for x in tokens(letters)]
            if signs:
                if signs not in known:
                    known[signs] = [x.id for x in tokens(signs)]
                ids += known[signs]
            out[k] = ids
        for k, e in zip(rest, t.encode_batch([words[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        if len(known) > 10_000:
            known.clear()
        return out
    return encode


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points, one row each (dimensions * bits < 63)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work, from the highest bit
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray encode
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)


def curve_keys(ids: np.ndarray, lengths: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Hilbert key of each document of a ragged array of ids."""
    bucket = (ids.astype(np.int64) * 0x9E3779B1 >> 7) % BUCKETS
    doc = np.repeat(np.arange(len(lengths)), lengths)
    out = np.empty((len(lengths), DIMENSIONS), np.float32)
    ends = np.cumsum(lengths)
    for a in range(0, len(lengths), 512):  # count vectors of so many documents at a time
        b = min(a + 512, len(lengths))
        part = slice(ends[a] - lengths[a], ends[b - 1])
        counts = np.bincount((doc[part] - a) * BUCKETS + bucket[part], minlength=(b - a) * BUCKETS)
        v = np.log1p(counts.astype(np.float32)).reshape(b - a, BUCKETS)
        norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        out[a:b] = v @ projection / np.maximum(norm, 1e-9)[:, None]
    cells = (0.5 + 0.5 * np.tanh(out / 2.0)) * (1 << BITS)
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1).astype(np.int64))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, key, n, ids (unsigned 16-bit little-endian, with the end id), crc of every row."""
    path = path or default_tokenizer()
    docs = id_and_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordMemo(word_encoder(path), lower=True)
        projection = _projection()
        for whole in batches:
            for b in chunks(whole):
                ids, lengths = memo.texts(b.column(1))
                keys = curve_keys(ids, lengths, projection)
                ends = np.cumsum(lengths)
                full = np.insert(ids.astype("<u2"), ends, END_ID).tobytes()  # the end id after each document
                ends = 2 * (ends + np.arange(1, len(ends) + 1))
                cells = [full[a:e] for a, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.record_batch([b.column(0), pa.array(keys), pa.array(lengths + 1),
                                       pa.array([zlib.crc32(c) for c in cells], pa.int64()), pa.array(cells, pa.binary())],
                                      names=["doc_id", "key", "n", "crc", "ids"])
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, key long, n long, crc long, ids binary")


PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _pieces(size: int, with_ids: bool):
    """Cuts a partition's stream of documents into sequences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        sequence, room = 0, size
        open_: list[tuple] = []  # (id, start, ids, doc tokens) of the sequence under way
        types = None

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], types), *(pa.array(c, pa.int64()) for c in cols[1:7])]
            names = list(PIECE_COLUMNS)
            if with_ids:
                flat = np.concatenate(cols[7]).astype(np.int32)
                offs = np.concatenate([[0], np.cumsum([len(x) for x in cols[7]])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(flat)))
                names.append("ids")
            return pa.record_batch(arrays, names=names)

        def close(parts: list[tuple], k: int) -> list[tuple]:
            out, at = [], 0
            for doc, start, ids, n in parts:
                out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, first + k, at, ids))
                at += len(ids)
            return out

        def cut(parts: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
            head, left = [], n
            for i, (doc, start, ids, total) in enumerate(parts):
                if len(ids) > left:
                    if left:
                        head.append((doc, start, ids[:left], total))
                    return head, [(doc, start + left, ids[left:], total), *parts[i + 1:]]
                head.append((doc, start, ids, total))
                left -= len(ids)
            return head, []

        for b in batches:
            types = b.column(0).type
            done: list[tuple] = []
            for doc, cell in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(cell, "<u2")
                start, n = 0, len(ids)
                while n - start >= room:
                    open_.append((doc, start, ids[start:start + room], n))
                    start += room
                    done += close(open_, sequence)
                    open_, room, sequence = [], size, sequence + 1
                if start < n:
                    open_.append((doc, start, ids[start:], n))
                    room -= n - start
                if len(done) >= 2000:
                    yield emit(done)
                    done = []
            if done:
                yield emit(done)
        rows: list[tuple] = []
        while open_:  # the rest: lengths that are powers of two
            left = sum(len(p[2]) for p in open_)
            head, open_ = cut(open_, 1 << (left.bit_length() - 1))
            rows += close(head, sequence)
            sequence += 1
        if rows:
            yield emit(rows)
    return run


def pack(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """One row per piece: place in its document and in its sequence, checksum, and the ids."""
    encoded = materialise(encode(docs, path), "pack-ids")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids array<int>" if with_ids else ""))
    ordered = (encoded.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "crc")
               .select("doc_id", "ids"))
    return ordered.mapInArrow(tidy(_pieces(size, with_ids)), schema)


def op1_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every piece of every document."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
