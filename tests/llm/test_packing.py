import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tally.llm import packing


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def verify(pieces, rows, plain, size=4096):
    docs = collections.Counter()
    by_seq = collections.defaultdict(list)
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    want = collections.defaultdict(list)
    for i, t in rows:
        want[i].append(plain(t))
    for i, lists in want.items():
        have = sorted(by_doc.pop(i), key=lambda p: (p.start, p.length))
        # Every id of every text in exactly one piece (texts that share an id are told apart by size).
        cells = collections.Counter()
        for p in have:
            fits = [x for x in lists if len(x) == p.doc_tokens and
                    zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32]
            assert fits
            cells[p.doc_tokens] += p.length
            if "ids" in p:
                assert p.ids == fits[0][p.start:p.start + p.length]
        assert cells == collections.Counter({n: n * c for n, c in collections.Counter(map(len, lists)).items()})
        docs[i] += 1
    assert not by_doc
    padding = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0


def test_pack(spark, small, plain, odd_docs, no_docs):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    verify(packing.op1_hilbert_pack(spark, small).collect(), rows, plain)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    verify(packing.pack(odd_docs).collect(), odd, plain)
    verify(packing.pack(odd_docs, size=64).collect(), odd, plain, 64)
    assert packing.pack(no_docs).count() == 0


def test_words_as_the_tokenizer_splits_them(plain):
    import pyarrow as pa

    from tally.llm.wordmemo import WordMemo
    texts = ["", "  ", "a\tb c\r\nd", "<|endoftext|> it's I'm CAN'T x<|endoftext|>y", "e\u0301 x\u0301 \u017ftop \u03a3\u0391\u03a3",
             "\x85 a\u2003b \x1c z", "12ab3c!?4'", "'s's 'S don't!!", "a" * 300, "\u00dcber na\u00efve \u00f7 a\u00f7b \u00ff.", None,
             "!!! ### a### %%%b \u65e5\u672c\u8a9e \U0001f600x", "\xad soft\xadhyphen caf\u00c9."]
    memo = WordMemo(packing.word_encoder(packing.default_tokenizer()), limit=3, lower=True)
    for _ in range(2):  # the second time with a memo that started anew
        ids, lengths = memo.texts(pa.array(texts))
        cuts = np.split(ids, np.cumsum(lengths)[:-1])
        assert [c.tolist() for c in cuts] == [plain(t)[:-1] for t in texts]


def test_hilbert_curve():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert(grid, 3)
    assert sorted(keys) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()  # neighbours on the curve touch


def test_like_documents_are_near(spark):
    texts = [("alpha beta gamma delta " * 30 + f"x{k}") if k % 2 else ("uno dos tres cuatro " * 30 + f"y{k}") for k in range(40)]
    keys = {r.doc_id: r.key for r in packing.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    order = sorted(keys, key=keys.get)
    changes = sum((a % 2) != (b % 2) for a, b in zip(order, order[1:]))
    assert changes <= 3
