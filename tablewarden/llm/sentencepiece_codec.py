"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed and rebuilt part by part: normaliser, space marker, merges (BPE) or
scores (unigram), byte fallback and the decoder. Where no piece crosses the start of a word, texts
are put together from their words, so each worker encodes a word once: new words of a batch go to
the library in one multithreaded call and are compared there and then with SentencePiece itself.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Regex, Tokenizer, decoders, normalizers, pre_tokenizers
from tokenizers.models import BPE, Unigram

from tablewarden.llm.common import pick, prepare, table, trim
from tablewarden.llm.token_counts import MODEL, SPACE_MARK, splits_at_spaces

# Words whose ids a worker remembers from task to task.
REMEMBERED = 250_000
# New words that are encoded as one line.
LINE = 50
THREADS = 2
# Kinds of pieces in the model protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NEVER = -1e6  # a unigram score no path takes


def _normalizer(spec) -> normalizers.Normalizer:
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(SPACE_MARK))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", SPACE_MARK))
    return normalizers.Sequence(steps)


def _merges(pieces: list[tuple[str, float]]) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, best score first."""
    score = dict(pieces)
    found = []
    for piece, s in pieces:
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in score and right in score:
                found.append((-s, -score[left], -score[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: bytes) -> Tokenizer:
    """The model as a ``Tokenizer`` that adds no special tokens."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    trainer = proto.trainer_spec
    if any(p.type == USER_DEFINED for p in proto.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    usable = [(p.piece, p.score) for p in proto.pieces if p.type == NORMAL]
    if trainer.model_type == trainer.BPE:
        vocab = {p.piece: i for i, p in enumerate(proto.pieces)}
        unknown = proto.pieces[trainer.unk_id].piece
        core = BPE(vocab, _merges(usable), unk_token=unknown, fuse_unk=True, byte_fallback=trainer.byte_fallback)
    elif trainer.model_type == trainer.UNIGRAM:
        scores = [(p.piece, p.score if p.type == NORMAL else NEVER) for p in proto.pieces]
        core = Unigram(scores, trainer.unk_id, trainer.byte_fallback)
    else:
        raise ValueError("only BPE and unigram models are supported")
    built = Tokenizer(core)
    built.normalizer = _normalizer(proto.normalizer_spec)
    if splits_at_spaces(model):
        words = Regex(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+")
        built.pre_tokenizer = pre_tokenizers.Split(words, "isolated")
    steps = [decoders.Replace(SPACE_MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if proto.normalizer_spec.add_dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    built.decoder = decoders.Sequence(steps)
    return built


class Codec:
    """Encodes whole texts; says of each whether the two libraries agree and decoding gives it back."""

    def __init__(self, model: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.tokenizer = build_tokenizer(model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = splits_at_spaces(model)
        pieces = sentencepiece_model_pb2.ModelProto.FromString(model).pieces
        self.opens = np.array([p.piece.startswith(SPACE_MARK) for p in pieces])
        # ids of each word as the bytes of 32-bit integers, which join without a list of numbers
        self.known: dict[str, bytes] = {}
        self.differ: set[str] = set()  # words on which the libraries disagree
        self.lost: set[str] = set()  # words that decoding does not give back

    def _each(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text by itself; texts on which something is amiss are marked."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        wanted = self.reference.encode(texts, num_threads=1)
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        for t, i, w, b in zip(texts, ids, wanted, back, strict=True):
            if i != w:
                self.differ.add(t)
            # the marker itself is written as a space by the model, so that is what comes back
            if b != t and b != t.replace(SPACE_MARK, " "):
                self.lost.add(t)
            yield array("i", i).tobytes()

    def _new(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words, many of them in one line, which is compared and decoded as a whole.

        A word's ids begin at the one piece that has the space marker. Where a line shows any
        difference its words are looked at one by one.
        """
        groups = [words[i : i + LINE] for i in range(0, len(words), LINE)]
        lines = [" ".join(g) for g in groups]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        wanted = self.reference.encode(lines, num_threads=1)
        ids = [e.ids for e in found]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        for group, line, i, w, b in zip(groups, lines, ids, wanted, back, strict=True):
            packed = np.array(i, np.int32)
            starts = (4 * np.flatnonzero(self.opens[packed])).tolist()
            if i != w or b != line or len(starts) != len(group):
                yield from self._each(group)
                continue
            raw = packed.tobytes()
            yield from map(raw.__getitem__, map(slice, starts, [*starts[1:], len(raw)]))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, bool, bool]]:
        """(ids, parity, round trip) of each text; a null is an empty text."""
        texts = ["" if t is None else t for t in texts]
        split = [t.replace(SPACE_MARK, " ").split(" ") if self.by_word else [""] for t in texts]
        # spaces side by side, first or last form pieces together: such a text is encoded whole
        odd = list({t for t, words in zip(texts, split, strict=True) if "" in words})
        whole = set(odd)
        split = [words if "" not in words else [t] for t, words in zip(texts, split, strict=True)]
        missing = list(set(chain.from_iterable(split)).difference(self.known, whole))
        self.known.update(zip(missing, self._new(missing), strict=True))
        self.known.update(zip(odd, self._each(odd), strict=True))
        for words in split:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)
            yield ids, not self.differ or self.differ.isdisjoint(words), not self.lost or self.lost.isdisjoint(words)
        # whole texts and words that need a mark are looked at anew each time
        for t in chain(odd, self.differ, self.lost):
            self.known.pop(t, None)
        if len(self.known) > REMEMBERED:  # the older half goes; a frequent word is soon back
            for t in list(islice(self.known, len(self.known) - REMEMBERED // 2)):
                del self.known[t]
        self.differ.clear()
        self.lost.clear()


ENCODED = "n_tokens bigint, ids array<int>, ids_sha256 string, parity boolean, round_trip boolean"
AT_ONCE = 512


_codecs: dict[str, Codec] = {}  # one per worker process, which runs many tasks


def _encoder(model: bytes, with_ids: bool):
    version = hashlib.sha256(model).hexdigest()

    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if version not in _codecs:
            _codecs.clear()
            _codecs[version] = Codec(model)
        codec = _codecs[version]
        for texts in parts:
            rows = []
            for at in range(0, len(texts), AT_ONCE):
                for ids, parity, back in codec.encode(texts.slice(at, AT_ONCE).to_pylist()):
                    digest = hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
                    rows.append((len(ids), ids if with_ids else None, digest, parity, back))
            n, ids, digest, parity, back = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(digest, pa.string()),
                    pa.array(parity, pa.bool_()),
                    pa.array(back, pa.bool_()),
                ],
                ["n_tokens", "ids", "ids_sha256", "parity", "round_trip"],
            )
            del rows, ids
            trim()

    encode.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, ENCODED)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids, their digest, parity with SentencePiece and whether decoding gives the text.

    Null texts count as empty: no tokens. Long texts are encoded whole; repeated rows alike.
    """
    prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        encode = _encoder(f.read(), with_ids)
    rows = pick(docs, id_col, text_col).select(F.col("id").alias(id_col), encode(F.col("text")).alias("e"))
    return rows.select(id_col, "e.*")


def decode_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of arrays of ids; a null array gives a null text."""
    prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()

    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        built = build_tokenizer(model)
        for part in parts:
            lists = part.to_pylist()
            texts = built.decode_batch([x or [] for x in lists], skip_special_tokens=False)
            yield pa.array([None if x is None else t for x, t in zip(lists, texts, strict=True)], pa.string())

    decode.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    back = F.arrow_udf(decode, "string")
    return docs.select(docs[id_col].alias(id_col), back(docs[ids_col].cast("array<int>")).alias("text"))


def op5_sentencepiece(spark, sf_dir):
    done = encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL), with_ids=False)
    return done.drop("ids")
