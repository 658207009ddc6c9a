"""Byte-level BPE encoding and decoding on a sentencepiece model made from a rank file (operator 6).

The rank vocabulary becomes a sentencepiece BPE model without any training: each token is a piece whose bytes are mapped
to 256 printable characters, its score is the negative rank, and normalisation is the identity. Sentencepiece merges the
neighbouring pair with the highest score, the leftmost first, which is the rank file's merge order, and a piece's
place in the model is its rank, so that its ids are the ids of the rank file. Text is split by the tokenizer's pattern
first; each distinct pre-token of a batch is encoded once. A pre-token that is itself in the vocabulary is one token,
merged or not. Decoding maps ids back to the bytes of their pieces.

The vocabulary file is read on the driver from a path parameter and its bytes (bounded: a tokenizer's vocabulary, under
``MAX_VOCABULARY_BYTES``) travel with the task; nothing is shuffled.

Edge cases: a null text counts as empty and has no ids. Any text is encoded whole. Repeated ids are encoded row by
row. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tenura.llm.arrow import map_batches, text_column

MAX_VOCABULARY_BYTES = 16 << 20
# Distinct pre-tokens remembered by a worker.
REMEMBERED = 250_000
# Texts whose ids are held as Python lists at a time.
TEXTS = 256


def _byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


_CHARACTERS = _byte_characters()
_MAPPED = "".join(_CHARACTERS)


def mapped(raw: bytes) -> str:
    return raw.decode("latin-1").translate(dict(enumerate(_CHARACTERS)))


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a file of ``base64 rank`` lines."""
    with open(path, "rb") as file:
        held = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(held) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, held.splitlines())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"the ranks in {path} are not 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ``i`` is token ``i``; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=mapped(token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


_ID = np.int32


class Codec:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str, model: bytes | None = None):
        import regex
        import sentencepiece

        self.tokens, self.split = tokens, regex.compile(pattern)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model or model_bytes(tokens))
        self.whole = {token: _ID(rank).tobytes() for rank, token in enumerate(tokens)}
        self.table = dict(enumerate(_CHARACTERS))
        self.names = [str(i) for i in range(len(tokens))]
        # Ids as bytes: a pre-token costs little memory, and those of a text are joined without a loop.
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encode pre-tokens not met before."""
        new = []
        for piece in pieces:
            if piece in self.known:
                continue
            raw = piece.encode("utf-8")
            if raw in self.whole:
                self.known[piece] = self.whole[raw]
            else:
                new.append((piece, raw.decode("latin-1").translate(self.table)))
        ids = self.processor.encode([text for _, text in new], num_threads=1) if new else []
        self.known.update((piece, np.array(found, dtype=_ID).tobytes()) for (piece, _), found in zip(new, ids))

    def ids(self, text: str | None) -> np.ndarray:
        found = self.split.findall if not self.split.groups else lambda t: [m.group() for m in self.split.finditer(t)]
        pieces = found(text or "")
        if len(self.known) > REMEMBERED:
            # Frequent pre-tokens are met early: the first half stays.
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
        self.learn(set(pieces))
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype=_ID)

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(model: bytes, pattern: str) -> Codec:
    """The codec of a task for a vocabulary, made once and dropped when the task ends: workers outlive their tasks."""
    key = (hashlib.sha256(model).hexdigest(), pattern)
    if key not in _CODECS:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto.FromString(model)
        back = {ord(c): b for b, c in enumerate(_CHARACTERS)}
        tokens = [bytes(back[ord(c)] for c in piece.piece) for piece in proto.pieces[:-1]]
        del proto
        _CODECS[key] = Codec(tokens, pattern, model)
    return _CODECS[key]


def _held(df: DataFrame, path: str, pattern: str):
    """The serialised model, sent to every worker once."""
    return df.sparkSession.sparkContext.broadcast((model_bytes(read_ranks(path)), pattern))


def encode_texts(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Id, the columns of ``keep``, ``n_tokens`` and ``ids`` of every text.

    With ``digests``, instead of ``ids``: ``ids_sha256`` of the decimal ids joined by commas and ``decoded_sha256`` of
    the bytes that the ids decode to.
    """
    kept = {f"_keep_{i}": name for i, name in enumerate(keep)}
    source = df.select(
        df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"), *[df[c].alias(k) for k, c in kept.items()]
    )
    held = _held(df, path, pattern)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch):
        codec = _codec(*held.value)
        texts = text_column(batch, "_text")
        out = {c: text_column(batch, k) for k, c in kept.items()}
        out |= {id_col: text_column(batch, "_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        parts = []
        names = codec.names
        for text in texts:
            found = codec.ids(text.as_py())
            out["n_tokens"].append(len(found))
            if digests:
                ids = found.tolist()
                joined = ",".join(map(names.__getitem__, ids))
                out["ids_sha256"].append(hashlib.sha256(joined.encode("ascii")).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            else:
                parts.append(found)
        if not digests:
            ends = np.concatenate(([0], np.cumsum(out["n_tokens"]))).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(parts) if parts else np.zeros(0, _ID))
        return out

    last = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    more = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{id_col} {kind}{more}, n_tokens long, {last}"
    return map_batches(source, run, schema, close=_CODECS.clear, rows=TEXTS)


def decode_ids(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """Id and ``decoded`` bytes of every list of ids; null for a null list or one with an id outside the vocabulary."""
    source = df.select(df[id_col].alias("_id"), df[ids_col].cast("array<int>").alias("_ids"))
    held = _held(df, path, pattern)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch):
        codec = _codec(*held.value)

        def decoded(ids):
            if ids is None or any(i is None or not 0 <= i < len(codec.tokens) for i in ids):
                return None
            return codec.decode(ids)

        return {id_col: text_column(batch, "_id"), "decoded": [decoded(v.as_py()) for v in text_column(batch, "_ids")]}

    return map_batches(source, run, f"{id_col} {kind}, decoded binary", close=_CODECS.clear)
