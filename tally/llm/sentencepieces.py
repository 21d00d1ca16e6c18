"""Operator 9: SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed and rebuilt: its normaliser (the compiled
character map, the leading marker and the white-space marker), its unigram
scores or, for a BPE model, its merges in the order of the scores, and byte
fallback. Texts are cut at single blanks and line breaks, which no piece of
the model crosses; each distinct word is encoded once, in multithreaded
batches, and compared with SentencePiece itself: where the two differ,
SentencePiece's ids are taken and counted in ``mismatches``. Texts that
cannot be cut so (runs of blanks, a leading blank, a model whose normaliser or
pieces cross blanks) are encoded whole by SentencePiece's own rules.

Decoding turns ids to bytes by the pieces' table; ids whose bytes are no valid
UTF-8 go through the backend's decoder.

Defined cases: null and empty texts have no ids and decode to the empty text.
Texts of any length are taken whole. Repeated rows give repeated results, and
columns other than id and text are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tally.llm.common import chunks, id_and_text, ragged_take, table, tidy
from tally.llm.wordmemo import WordMemo

MARK = "▁"
THREADS = 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """A SentencePiece model on the tokenizers backend."""

    def __init__(self, path: str, threads: int = THREADS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers
        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        self.peer = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = np.array([p.type for p in proto.pieces])
        spec, rules = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type == 1:
            model = models.Unigram([(p.piece, p.score) for p in proto.pieces], spec.unk_id, spec.byte_fallback)
        elif spec.model_type == 2:
            model = models.BPE({p: i for i, p in enumerate(self.pieces)}, self._merges(proto.pieces),
                               unk_token=spec.unk_piece, fuse_unk=True, byte_fallback=spec.byte_fallback)
        else:
            raise ValueError("only unigram and BPE models are rebuilt")
        self.backend = Tokenizer(model)
        self.words = Tokenizer(model)  # for words that carry their markers already
        own = [AddedToken(p.piece, normalized=False) for p in proto.pieces if p.type == USER_DEFINED]
        if own:
            self.backend.add_tokens(own)
        steps = [normalizers.Precompiled(rules.precompiled_charsmap)] if rules.precompiled_charsmap else []
        if rules.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace("  ", " ")]
        if rules.add_dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        if rules.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        self.backend.normalizer = normalizers.Sequence(steps)
        self.prefix = bool(rules.add_dummy_prefix)
        self.backend.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                                  *([decoders.Strip(" ", 1, 0)] if self.prefix else [])])
        crossing = any(MARK in p[1:] and p.strip(MARK) or "\n" in p[1:] or "\n" in p[:1] and len(p) > 1
                       for p in self.pieces)
        # Word by word only where nothing can cross a blank or change outside a word.
        self.by_word = bool(self.prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
                            and not rules.precompiled_charsmap and not own and not crossing)
        self.mismatches = 0
        cells = [b"" if k in (CONTROL, UNUSED) else bytes([int(p[3:5], 16)]) if k == BYTE
                 else p.replace(MARK, " ").encode() if k != UNKNOWN else " ⁇ ".encode()
                 for p, k in zip(self.pieces, self.kinds)]
        self.cells = np.frombuffer(b"".join(cells), np.uint8)
        self.cell_sizes = np.array([len(c) for c in cells], np.int64)
        self.cell_starts = np.cumsum(self.cell_sizes) - self.cell_sizes

    @staticmethod
    def _merges(pieces) -> list[tuple[str, str]]:
        """Pairs that make a piece, best-scored piece first."""
        ranks = {p.piece: i for i, p in enumerate(pieces)}
        out = []
        for p in pieces:
            if p.type in (NORMAL, USER_DEFINED, UNUSED):
                pairs = [(p.piece[:k], p.piece[k:]) for k in range(1, len(p.piece))]
                pairs = [x for x in pairs if x[0] in ranks and x[1] in ranks]
                pairs.sort(key=lambda x: (ranks[x[0]], ranks[x[1]]))
                out += [(-p.score, x) for x in pairs]
        out.sort(key=lambda x: x[0])
        return [x for _, x in out]

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of words; one that starts with a line break carries no marker."""
        marked = [w if w[:1] == "\n" else MARK + w for w in words]
        ids = [e.ids for e in self.words.encode_batch_fast(marked, add_special_tokens=False)]
        check = [k for k, w in enumerate(words) if w and w[0] != "\n"]
        for k, theirs in zip(check, self.peer.encode([words[k] for k in check], num_threads=1)):
            if theirs != ids[k]:
                ids[k] = theirs
                self.mismatches += 1
        return ids

    def encode_whole(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of texts that cannot be cut into words; checked like words."""
        ids = [e.ids for e in self.backend.encode_batch(list(texts), add_special_tokens=False)]
        for k, theirs in enumerate(self.peer.encode(list(texts), num_threads=1)):
            if theirs != ids[k]:
                ids[k] = theirs
                self.mismatches += 1
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """Text of one list of ids."""
        data = ragged_take(self.cells, self.cell_starts[ids], self.cell_sizes[ids]).tobytes()
        try:
            text = data.decode()
        except UnicodeDecodeError:
            return self.backend.decode(ids.tolist(), skip_special_tokens=True)
        return text[1:] if self.prefix and text[:1] == " " else text


class Encoder:
    """Ids of a column of texts."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.memo = WordMemo(model.encode_words, breaks=True)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = pc.fill_null(column, "")
        odd = pc.or_(pc.or_(pc.equal(column, ""), pc.starts_with(column, " ")), pc.match_substring(column, "  "))
        odd = np.asarray(odd.cast(pa.int8())).astype(bool) | (not self.model.by_word)
        if not odd.any():
            return self.memo.texts(column)
        ids, lengths = self.memo.texts(column.filter(pa.array(~odd)))
        ends = np.cumsum(lengths)
        plain = iter(zip(ends - lengths, ends))
        whole = iter(self.model.encode_whole(column.filter(pa.array(odd)).to_pylist()))
        parts = [np.asarray(next(whole), np.int32) if o else ids[slice(*next(plain))] for o in odd]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def encode(docs: DataFrame, path: str | None = None, threads: int = THREADS) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    path, docs = path or default_model(), id_and_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(path, threads))
        for whole in batches:
            for b in chunks(whole):
                ids, lengths = encoder(b.column(1))
                at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))],
                                      names=["doc_id", "ids"])
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with ids; null ids are the empty text."""
    path = path or default_model()
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(path)
        for b in batches:
            texts = [model.decode(np.asarray(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return rows.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row, in one pass: ids and their decoding, as counts and checksums."""
    path, docs = path or default_model(), id_and_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(path)
        encoder = Encoder(model)
        for whole in batches:
            for b in chunks(whole):
                ids, lengths = encoder(b.column(1))
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4")
                out = []
                for a, e, text in zip(ends - lengths, ends, b.column(1).to_pylist()):
                    back = model.decode(ids[a:e])
                    out.append((zlib.crc32(raw[a:e].tobytes()), zlib.crc32(back.encode()), back == (text or "")))
                crc, back, same = zip(*out)
                yield pa.record_batch([b.column(0), pa.array(lengths), pa.array(crc, pa.int64()),
                                       pa.array(back, pa.int64()), pa.array(same)],
                                      names=["doc_id", "n_ids", "ids_crc32", "text_crc32", "round_trip"])
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, n_ids long, ids_crc32 long, text_crc32 long, round_trip boolean")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: ids' count and checksum, the decoded text's checksum, round trip."""
    return round_trip(table(spark, sf_dir, "documents"))
