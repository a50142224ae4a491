"""Byte-level BPE through a sentencepiece model made directly from a rank vocabulary.

Nothing is trained. Each token of the vocabulary becomes a piece, its bytes
mapped to printable characters one by one; the score is the negative rank, so
the best-scored merge is the merge of lowest rank. Normalisation is the
identity, without dummy prefix or white-space handling. A pre-token that is a
token of its own takes that id; any other is merged by the model. Decoding
maps the pieces' characters back to bytes.

Null and empty texts have no ids. Rows are encoded one by one: ties, repeated
rows, empty tables and other columns need no special case. Very long texts
and pre-tokens are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import buffers as B
from .chunks import ChunkEncoder

# Byte -> character of byte-level vocabularies. Printable bytes
# stand for themselves, the others follow from U+0100 on in byte order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHAR = {b: chr(b) for b in _PLAIN} | {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}
CHAR_BYTE = {c: b for b, c in BYTE_CHAR.items()}
#: Maps Latin-1 text (one character a byte) to piece characters.
TO_PIECE = {b: c for b, c in BYTE_CHAR.items()}

# Field numbers and enum values of the model's protobuf schema.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE, _UNKNOWN = 1, 2, 3, 2
_MODEL_TYPE, _BPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID, _UNK_PIECE = 3, 2, 4, 40, 41, 42, 43, 45
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes to rank from lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def piece_of(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_PIECE)


def bytes_of(piece: str) -> bytes:
    return bytes(map(CHAR_BYTE.__getitem__, piece))


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model; piece i is the token of i-th lowest rank, the unknown piece comes last."""
    out = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out += _bytes(_PIECES, _bytes(_PIECE, piece_of(token).encode()) + _varint(_SCORE << 3 | 5) + struct.pack("<f", -float(rank)))
    unknown = b"no piece"  # holds a space, which no mapped text has
    out += _bytes(_PIECES, _bytes(_PIECE, unknown) + _varint(_SCORE << 3 | 5) + struct.pack("<f", 0.0) + _number(_TYPE, _UNKNOWN))
    n = len(ranks)
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, n + 1) + _number(_UNK_ID, n)
    trainer += b"".join(_number(f, -1) for f in (_BOS_ID, _EOS_ID, _PAD_ID)) + _bytes(_UNK_PIECE, unknown)
    normal = _bytes(_NAME, b"identity") + b"".join(_number(f, 0) for f in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return bytes(out + _bytes(_TRAINER, trainer) + _bytes(_NORMALIZER, normal))


class Codec:
    """Encodes and decodes blocks of texts with one vocabulary and one pre-token pattern."""

    def __init__(self, lines: Sequence[bytes], pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(lines)
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        self.id_of_piece = [r for _, r in by_rank]
        self.gaps = self.id_of_piece != list(range(len(by_rank)))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.ranks))
        self.find = regex.compile(pattern).findall
        size = np.zeros(self.id_of_piece[-1] + 1, np.int64)
        size[self.id_of_piece] = [len(t) for t, _ in by_rank]
        self.blocks = ChunkEncoder(self.encode_texts, size)
        self.size, self.start = size, np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(bytes_of(self.model.id_to_piece(i)) for i in range(len(by_rank))), np.uint8)

    def encode_texts(self, texts: Sequence[str]) -> np.ndarray:
        """Ids of all texts, one after the other: pre-tokens one by one."""
        tokens = list(chain.from_iterable(map(self.find, texts)))
        each = dict.fromkeys(tokens)
        own = self.ranks
        merged = []
        for t in each:
            raw = t.encode()
            if raw in own:
                each[t] = (own[raw],)
            else:
                merged.append((t, raw.decode("latin-1").translate(TO_PIECE)))
        if merged:
            piece = self.id_of_piece
            for (t, _), ids in zip(merged, self.model.encode([m for _, m in merged], num_threads=1), strict=True):
                each[t] = [piece[p] for p in ids] if self.gaps else ids
        return np.array(list(chain.from_iterable(map(each.__getitem__, tokens))), np.uint32)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.blocks(data, offs)

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows of ids and the offsets of each row in them."""
        size = self.size[ids]
        return self.bytes[B.ragged(self.start[ids], size)], np.concatenate([[0], np.cumsum(size)])[offs]


@functools.lru_cache(maxsize=2)
def _codec(lines: tuple[bytes, ...], pattern: str) -> Codec:
    return Codec(lines, pattern)


def vocabulary(spark: SparkSession, path: str) -> list[bytes]:
    """The lines of a rank file: from a local path of the driver, else through Spark's own file systems."""
    import os

    if os.path.isfile(path):
        with open(path, "rb") as f:
            return f.read().splitlines()
    return [r[0].encode() for r in spark.read.text(path).collect()]


def _codes(shared, pattern: str, carried: list[str], keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for b in B.blocks(batches, "__text"):
            ids, offs = codec.encode(*B.flat(b.column("__text")))
            back, bytes_at = codec.decode(ids, offs)
            raw, text = memoryview(ids.astype("<u4")).cast("B"), memoryview(back)
            rows = range(b.num_rows)
            made = {
                "n_tokens": lambda: pa.array(np.diff(offs), pa.int64()),
                "ids": lambda: pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.astype(np.int32))),
                "ids_sha256": lambda: pa.array([hashlib.sha256(raw[4 * offs[i] : 4 * offs[i + 1]]).hexdigest() for i in rows], pa.string()),
                "decoded": lambda: B.binary_rows(back, bytes_at),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(text[bytes_at[i] : bytes_at[i + 1]]).hexdigest() for i in rows], pa.string()),
            }
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carried), *(made[k]() for k in keep)], names=[*carried, *keep])

    return run


_KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}


def encode(docs: DataFrame, lines: Sequence[bytes], pattern: str, columns: Sequence[str] = ("n_tokens", "ids", "decoded"), key: str = "doc_id", text: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """Per document: key, the columns ``also``, and the asked of ``n_tokens``, ``ids``, ``ids_sha256``, ``decoded`` (bytes), ``decoded_sha256``.

    The vocabulary is the only thing broadcast (its size does not depend on
    the documents). One pass, no shuffle. Texts are cut into chunks before a
    space or line break that a visible character follows; ``pattern`` must
    never match across such a place, as the patterns of byte-level
    vocabularies do not. Asked and carried columns must have different names.
    """
    if len({key, *also, *columns}) < 1 + len(also) + len(columns):
        raise ValueError(f"columns of one name: {[key, *also, *columns]}")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(lines))
    narrow = docs.select(F.col(key).cast("long").alias(key), *also, F.col(text).cast("string").alias("__text"))
    keep = list(columns)
    kinds = [(f.name, f.dataType.simpleString()) for f in narrow.schema][:-1]
    schema = ", ".join([*(f"`{c}` {k}" for c, k in kinds), *(f"{c} {_KINDS[c]}" for c in keep)])
    return narrow.mapInArrow(_codes(shared, pattern, [c for c, _ in kinds], keep), schema)
