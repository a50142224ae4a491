"""Token ids as patched frame-of-reference blocks in files, in document order.

A file image holds documents one after the other: ids are cut into blocks of
``BLOCK`` ids; a block stores its minimum, the differences to it packed at
the width that ``PERCENTILE`` of them need, and the wider ones in an
exception list (place, value). An index of block starts and the documents'
first ids allow reading any document alone. Images are rows of a Parquet
table (one row a file image), so Spark's commit protocol decides which
attempt of a task counts.

Texts are dealt by ranges of the document key and sorted, so images in
(part, seq) order hold the documents in ascending key order. Null and empty
texts have the end id alone; equal keys stay together, ordered by their text;
null keys come first, have a bit in each image, and read as null; an empty
table has no image and no row. Strings of the tokenizer's added tokens inside
a text become those tokens, as the tokenizer itself has it; texts that hold
one are encoded whole, past the chunk cache.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.session import checkpoint_dir

from . import buffers as B
from .bpe import bytes_of
from .chunks import ChunkEncoder

BLOCK = 1024
PERCENTILE = 0.9
#: Ids of a file image at which it is closed (with the document that reaches it).
IMAGE_IDS = 1 << 20
#: Bytes of text of a part, and parts at most (beyond 320 GB of text parts grow; images do not).
PART_BYTES = 32 << 20
PARTS = 10_000
_MAGIC = b"PFOR\x00\x02\x00\x00"
_HEAD = struct.Struct("<8sQQQ")  # magic, documents, ids, blocks


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values of ``width`` bits as rows of 64-bit words."""
    v = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64))
    out = np.zeros((width, v.shape[1]), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[word] |= v[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= v[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((64, w.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[j] = w[word] >> np.uint64(shift)
        if shift + width > 64:
            out[j] |= w[word + 1] << np.uint64(64 - shift)
    out &= mask
    return np.ascontiguousarray(out.T).reshape(len(words), BLOCK)


def _widths(v: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(v.astype(np.float64))[1]


def write_image(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE, null: np.ndarray | None = None) -> bytes:
    """A file image of documents with ``counts[i]`` ids each; ``null`` marks documents without a key."""
    null = np.zeros(len(keys), bool) if null is None else null
    n = -(-len(ids) // BLOCK)
    padded = np.full(n * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    v = padded.reshape(n, BLOCK)
    low = v.min(axis=1) if n else np.zeros(0, np.uint32)
    v = v - low[:, None]
    need = _widths(v)
    width = np.partition(need, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))] if n else np.zeros(0, int)
    out_row, out_at = np.nonzero(need > width[:, None]) if n else (np.zeros(0, int), np.zeros(0, int))
    extra = np.bincount(out_row, minlength=n)
    body: list[bytes] = [b""] * n
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        kept = np.where(need[rows] > w, 0, v[rows])
        words = _pack(kept, w).astype("<u8") if w else np.zeros((len(rows), 0), "<u8")
        for i, r in enumerate(rows.tolist()):
            body[r] = words[i].tobytes()
    first = np.cumsum(extra) - extra
    blocks = []
    for r in range(n):
        own = slice(first[r], first[r] + extra[r])
        blocks.append(struct.pack("<IBxH", low[r], width[r], extra[r]) + body[r] + out_at[own].astype("<u2").tobytes() + v[r][out_at[own]].astype("<u4").tobytes())
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = _HEAD.pack(_MAGIC, len(keys), len(ids), n)
    return b"".join([head, keys.astype("<i8").tobytes(), np.packbits(null, bitorder="little").tobytes(), np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes(), starts.tobytes(), *blocks])


class Image:
    """Reads a file image; ``ids(a, b)`` unpacks only the blocks that hold ids a to b - 1."""

    def __init__(self, raw: bytes):
        magic, self.n_docs, self.n_ids, self.n_blocks = _HEAD.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        self.keys = np.frombuffer(raw, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.null = np.unpackbits(np.frombuffer(raw, np.uint8, -(-self.n_docs // 8), at), count=self.n_docs, bitorder="little").astype(bool)
        at += -(-self.n_docs // 8)
        self.offs = np.frombuffer(raw, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.starts = np.frombuffer(raw, "<u8", self.n_blocks + 1, at).astype(np.int64)
        self.raw, self.body = raw, at + 8 * (self.n_blocks + 1)

    def ids(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.zeros(0, np.uint32)
        r0, r1 = a // BLOCK, -(-b // BLOCK)
        head = [struct.unpack_from("<IBxH", self.raw, self.body + int(self.starts[r])) for r in range(r0, r1)]
        low = np.array([h[0] for h in head], np.uint64)
        width = np.array([h[1] for h in head])
        out = np.zeros((r1 - r0, BLOCK), np.uint64)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            if w:
                size = 8 * w * BLOCK // 64
                words = b"".join(self.raw[(p := self.body + int(self.starts[r0 + r]) + 8) : p + size] for r in rows.tolist())
                out[rows] = _unpack(np.frombuffer(words, "<u8").reshape(len(rows), -1), w)
        for i, (_, w, n) in enumerate(head):
            if n:
                at = self.body + int(self.starts[r0 + i]) + 8 + 8 * w * BLOCK // 64
                out[i, np.frombuffer(self.raw, "<u2", n, at)] = np.frombuffer(self.raw, "<u4", n, at + 2 * n)
        return (out + low[:, None]).astype(np.uint32).reshape(-1)[a - r0 * BLOCK : b - r0 * BLOCK]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.offs[i]), int(self.offs[i + 1]))


class TextEncoder:
    """Ids of blocks of texts as the tokenizer gives them without special tokens around a text."""

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        added = {x.content for x in self.tokenizer.get_added_tokens_decoder().values()}
        size = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            size[i] = len(token) if token in added else len(bytes_of(token))
        # their strings are matched before the text is cut into words, so chunks would tear them apart
        self.added = sorted(x.encode() for x in added)
        self.chunks = ChunkEncoder(self.encode_texts, size)

    def encode_texts(self, texts: list[str]) -> np.ndarray:
        return np.array(list(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))), np.uint32)

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        whole = np.zeros(len(offs) - 1, bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offs, at, "right")) - 1
                if at + len(token) <= offs[row + 1]:
                    whole[row] = True
                    at = raw.find(token, int(offs[row + 1]))
                else:
                    at = raw.find(token, at + 1)
        if not whole.any():
            return self.chunks(data, offs)
        size = np.diff(offs)
        plain = np.where(whole, 0, size)
        ids, at = self.chunks(data[B.ragged(offs[:-1], plain)], np.concatenate([[0], np.cumsum(plain)]))
        rows = [self.encode_texts([raw[offs[i] : offs[i + 1]].decode()]) if w else ids[at[i] : at[i + 1]] for i, w in enumerate(whole.tolist())]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> TextEncoder:
    return TextEncoder(vocabulary)


def _images(shared, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def close() -> pa.RecordBatch:
            keys, null, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [part, seq, before, len(keys), len(ids), write_image(keys, counts, ids, null=null)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=_IMAGE)

        for b in B.blocks(batches, "text"):
            ids, offs = encode(*B.flat(b.column("text")))
            count = np.diff(offs) + 1
            whole = np.full(len(ids) + len(count), end_id, np.uint32)
            inside = np.ones(len(whole), bool)
            inside[np.cumsum(count) - 1] = False
            whole[inside] = ids
            key = b.column("key")
            held.append((np.asarray(pc.fill_null(key, 0)), np.asarray(pc.is_null(key)), count, whole))
            size += len(whole)
            if size >= IMAGE_IDS:
                yield close()
                before, seq, held, size = before + size, seq + 1, [], 0
        if held:
            yield close()

    return run


_IMAGE = ["part", "seq", "before", "n_docs", "n_ids", "image"]


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Writes the token files of ``docs`` under ``path`` and returns the table of images read back from there.

    ``vocabulary``: the tokenizer's JSON. Documents are dealt by key ranges
    of about ``part_bytes`` of text, at most ``PARTS``; a part is one task's
    sorted stream, and its images are closed at ``IMAGE_IDS`` whatever its size.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(1, -(-total // part_bytes)), PARTS)
    shared = spark.sparkContext.broadcast(vocabulary)
    ordered = narrow.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    rows = ordered.mapInArrow(_images(shared, end_id), "part int, seq int, before long, n_docs long, n_ids long, image binary")
    rows.write.option("compression", "none").parquet(path)
    return images(spark, path)


def images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, seq int, before long, n_docs long, n_ids long, image binary").parquet(path)


def fresh_path(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder that all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, raw in zip(b.column("start").to_pylist(), b.column("image"), strict=True):
            image = Image(raw.as_py())
            ids = memoryview(image.ids(0, image.n_ids).astype("<u4")).cast("B")
            offs = image.offs
            crc = [zlib.crc32(ids[4 * a : 4 * e]) for a, e in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(image.keys, pa.int64(), mask=image.null), pa.array(start + offs[:-1], pa.int64()), pa.array(np.diff(offs), pa.int64()), pa.array(crc, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])


def read_documents(table: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of the images: key, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    The ids before each part come from one row a part, at most ``PARTS`` of
    them, joined by broadcast.
    """
    from pyspark.sql import Window

    parts = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    placed = table.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("before")).alias("start"), "image")
    return placed.mapInArrow(_documents, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)
