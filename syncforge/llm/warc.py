"""WARC archives: written as records of a text table, read back by verifying the chain of record borders.

Writing. Of records with equal payloads (SHA-1 and length) of at least
``least_bytes``, that with the smallest page id is a response, the others
revisit it and store no payload. Which is which is decided on narrow rows;
payloads cross the network once, compressed, keyed by the row itself, so
neither a payload that very many pages share nor a repeated row is a hot key.
Spark's text writer, with the blank lines that end a record as its line
separator, writes the files: plain WARC 1.1, on any storage Spark writes to.

Reading. Every place of the version line may be a record's start, also inside
a payload. Tasks read splits of the files, cut there, and emit each
candidate's place and the place where its header says that it ends. Pointer
jumping, doubling the jumps, first inside a split and then from split to
split, starts at the file's first byte and keeps the candidates that it
reaches: the records. Whatever else looks like a record is payload. A record
whose payload holds the version line is put together from its pieces (if
there are any such records, in a second scan).

A record that is cut off, or whose end meets neither a record nor the file's
end, is dropped with all that follows it in its file. Null payloads are
empty. Null page ids come after all others; of rows with one id the smallest
url comes first (null last), of equal rows any; so exactly one response has a
payload. Control characters, spaces and other than ASCII in urls are written
percent-encoded; a null url has no header and reads as null. An empty table
makes an archive without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syncforge.session import checkpoint_dir

from . import buffers as B
from .staging import settled, written

# The version line and the profile of the WARC 1.1 standard.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
RESPONSE, REVISIT = "response", "revisit"
DATE = "2020-01-01T00:00:00Z"
#: Pages, and characters of each, whose text is the dictionary of the packed payloads (it changes their size alone).
SAMPLE_PAGES, SAMPLE_CHARS = 64, 4096
_UNSAFE = re.compile(r"[^\x21-\x7e]+")
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


# writing


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if raw else None


def _packed(shared: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=5, dict_data=_dictionary(shared)).compress
        for b in B.blocks(batches, "html"):
            raw = [x or b"" for x in b.column("html").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("page_id"),
                    b.column("url"),
                    pa.array([hashlib.sha1(x).digest() for x in raw], pa.binary()),
                    pa.array([len(x) for x in raw], pa.int64()),
                    pa.array([squeeze(x) for x in raw], pa.binary()),
                ],
                names=["page_id", "url", "digest", "bytes", "packed"],
            )

    return run


def _keyed(rows: DataFrame) -> DataFrame:
    """Null-free columns that name a row: k, no_k, u, no_u."""
    return rows.withColumns({"no_k": F.col("page_id").isNull(), "k": F.coalesce("page_id", F.lit(0)), "no_u": F.col("url").isNull(), "u": F.coalesce("url", F.lit(""))}).drop("page_id", "url")


_ROW = ["digest", "bytes", "no_k", "k", "no_u", "u"]


def _record_id(page: int | None, url: str | None, digest: bytes, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest.hex()} {copy} {url}')}>"


def _field(page: int | None) -> str:
    return "none" if page is None else str(page)


def record(kind: str, page: int | None, url: str | None, digest: bytes, payload: bytes | None, size: int, copy: int = 0, refers: tuple[int | None, str | None] | None = None, date: str = DATE) -> bytes:
    """A record without the two blank lines at its end."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}{END}".encode() + (payload or b"")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page, url, digest, copy)}", f"WARC-Date: {date}", f"WARC-Page-ID: {_field(page)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: "".join(f"%{c:02X}" for c in m[0].encode()), url))
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(*refers, digest, 0)}", f"WARC-Refers-To-Page-ID: {_field(refers[0])}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + END.encode() + block


def _records(shared: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        opened = zstandard.ZstdDecompressor(dict_data=_dictionary(shared))
        for b in batches:
            out = []
            for r in b.to_pylist():
                page, url = None if r["no_k"] else r["k"], None if r["no_u"] else r["u"]
                first = (None if r["no_fk"] else r["fk"], None if r["no_fu"] else r["fu"])
                payload = None if r["packed"] is None else opened.decompress(r["packed"], max_output_size=r["bytes"]) if r["bytes"] else b""
                out.append(record(r["kind"], page, url, r["digest"], payload, r["bytes"], r["copy"], first if r["kind"] == REVISIT else None))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])

    return run


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """Writes the archive files of ``pages`` under ``path``."""
    base = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    text = F.coalesce("html", F.lit(""))
    narrow = written(_keyed(base.select("page_id", "url", F.unhex(F.sha1(text)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))).groupBy(*_ROW).agg(F.count("*").alias("copies")))
    small = F.col("bytes") < least_bytes
    own = F.struct("no_k", "k", "no_u", "u")
    grouped = narrow.where(~small).groupBy("digest", "bytes").agg(F.min(own).alias("f"), F.sum("copies").alias("total"))
    firsts = written(grouped.select("digest", "bytes", "total", "f.*"))
    named = [F.col("no_k").alias("no_fk"), F.col("k").alias("fk"), F.col("no_u").alias("no_fu"), F.col("u").alias("fu")]
    # pages have much markup in common: a bounded sample of it is what the packed payloads refer to
    sample = base.where(F.octet_length("html") > 0).select(F.substring("html", 1, SAMPLE_CHARS)).limit(SAMPLE_PAGES).collect()
    shared = "".join(r[0] for r in sample).encode()
    # equal rows meet in their task first; the aggregate and the join share one exchange
    schema = "page_id long, url string, digest binary, bytes long, packed binary"
    unique = _keyed(base.mapInArrow(_packed(shared), schema)).groupBy(*_ROW).agg(F.first("packed").alias("packed"), F.count("*").alias("copies"))
    wanted = firsts.select(*_ROW).unionByName(narrow.where(small).select(*_ROW)) if least_bytes > 0 else firsts.select(*_ROW)
    copies = F.when(small, F.col("copies")).otherwise(1) if least_bytes > 0 else F.lit(1)
    responses = unique.join(wanted, _ROW).withColumn("copy", F.explode(F.sequence(F.lit(0), copies.cast("int") - 1)))
    responses = responses.select(F.lit(RESPONSE).alias("kind"), *_ROW, "copy", *named, "packed")
    again = narrow.where(~small).join(firsts.where("total > 1").select("digest", "bytes", *named), ["digest", "bytes"])
    is_first = (F.col("no_k") == F.col("no_fk")) & (F.col("k") == F.col("fk")) & (F.col("no_u") == F.col("no_fu")) & (F.col("u") == F.col("fu"))
    from_ = F.when(is_first, 1).otherwise(0)
    again = again.where(F.col("copies") > from_).withColumn("copy", F.explode(F.sequence(from_, F.col("copies").cast("int") - 1)))
    revisits = again.select(F.lit(REVISIT).alias("kind"), *_ROW, "copy", "no_fk", "fk", "no_fu", "fu", F.lit(None).cast("binary").alias("packed"))
    rows = responses.unionByName(revisits).mapInArrow(_records(shared), "value string")
    rows.write.option("lineSep", END).option("compression", "none").text(path)


def fresh_path(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder that all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


# reading


def _header(raw: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of the header (with the blank line) and its fields; None if this is no record's header."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {m[1].strip().lower(): m[2] for m in _FIELD.finditer(raw, 0, end)}
    if b"warc-type" not in fields or not fields.get(b"content-length", b"").isdigit():
        return None
    return end + 4, fields


def _number(raw: bytes | None) -> int | None:
    return None if raw is None or raw == b"none" else int(raw)


def _parsed(fields: dict[bytes, bytes], block: bytes) -> tuple:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, intact; and the payload."""
    kind = fields[b"warc-type"].decode("latin-1")
    told = fields.get(b"warc-payload-digest", b"").decode("latin-1").rpartition(":")[2]
    head, _, payload = block.partition(b"\r\n\r\n")
    url = fields.get(b"warc-target-uri")
    page, refers = _number(fields.get(b"warc-page-id")), _number(fields.get(b"warc-refers-to-page-id"))
    size, digest = len(payload), told
    if kind == REVISIT:
        http = {m[1].strip().lower(): m[2] for m in _FIELD.finditer(head)}
        size, payload = int(http.get(b"content-length", b"0")), None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return page, None if url is None else url.decode("latin-1"), kind, size, digest, refers, digest == told, payload


_PARSED = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact"]
_PARSED_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
_PARSED_DDL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between one version line and the next, in the order of the file inside each split."""
    rows = spark.read.option("lineSep", VERSION.decode()).text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, block, rel, size, value) of each piece: its place from the split's first piece on, with its version line."""
    now, rel = None, 0
    for b in batches:
        for file, block, value in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("value").cast(pa.binary()).to_pylist(), strict=True):
            size = len(value) + len(VERSION)
            if (file, block) != now:
                now, rel = (file, block), 0
                if block == 0:  # what stands before the file's first version line: nothing, in a good file
                    size = len(value)
                    if not size:
                        continue
            yield file, block, rel, size, value
            rel += size


def _jump(rel: np.ndarray, to: np.ndarray, total: int) -> np.ndarray:
    """Where the chain that starts at each candidate leaves the split (at or beyond ``total``); -1 if it breaks inside."""
    n = len(rel)
    place = np.minimum(np.searchsorted(rel, to), n - 1)
    inside = (to >= 0) & (to < total) & (rel[place] == to)
    step = np.where(inside, place, np.arange(n))
    leaves = np.where(to >= total, to, -1)
    while True:
        further = step[step]
        if (further == step).all():
            return leaves[step]
        step = further


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    now = None

    def close() -> pa.RecordBatch:
        rel, size, to = (np.array([h[i] for h in held], np.int64) for i in range(3))
        leaves = _jump(rel, to, int(rel[-1] + size[-1]))
        n = len(held)
        arrays = [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), *(pa.array(x) for x in (rel, size, to, leaves))]
        arrays += [pa.array([h[3 + i] for h in held], t) for i, t in enumerate(_PARSED_TYPES)]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "rel", "size", "to", "leaves", *_PARSED])

    none = (None,) * len(_PARSED)
    for file, block, rel, size, value in _splits(batches):
        if (file, block) != now:
            if held:
                yield close()
            now, held = (file, block), []
        got = _header(value) if size > len(value) else None
        if got is None:
            held.append((rel, size, -1, *none))
            continue
        length = int(got[1][b"content-length"])
        to = rel + len(VERSION) + got[0] + length + 4
        if to == rel + size and value.endswith(b"\r\n\r\n"):  # nothing in it looks like a record
            held.append((rel, size, to, *_parsed(got[1], value[got[0] : got[0] + length])[:-1]))
        else:
            held.append((rel, size, to, *none))
    if held:
        yield close()


_LINKS_DDL = f"file string, block long, rel long, size long, to long, leaves long, {_PARSED_DDL}"


def _mark(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one split: the records on the chain from its entry; the last of them counts only if its end was verified."""
    rows = rows.sort_values("rel", ignore_index=True)
    rel, to = rows["rel"].to_numpy(), rows["to"].to_numpy()
    at, total = int(rows["entry"].iloc[0]), int(rel[-1] + rows["size"].iloc[-1])
    place = np.minimum(np.searchsorted(rel, to), len(rel) - 1)
    inside = (to >= 0) & (to < total) & (rel[place] == to)
    i = int(np.searchsorted(rel, at))
    on = np.zeros(len(rel), bool)
    while True:
        if inside[i]:
            on[i] = True
            i = int(place[i])
            continue
        on[i] = bool(to[i] >= total and rows["verified"].iloc[0])
        break
    return rows[on].drop(columns=["entry", "verified", "leaves"])


def _entries(links: DataFrame, bases: DataFrame, most: int) -> DataFrame:
    """Of each split that a file's chain reaches: ``file``, ``block``, ``entry``, ``verified`` (the chain goes on, or ends with the file)."""
    ends = bases.groupBy("file").agg(F.max(F.col("base") + F.col("total")).alias("end"))
    nodes = links.where("to >= 0").join(bases.select("file", "block", "base"), ["file", "block"])
    nodes = nodes.select("file", "block", "rel", (F.col("base") + F.col("rel")).alias("at"), F.when(F.col("leaves") >= 0, F.col("base") + F.col("leaves")).alias("next"))
    # only starts of files and places where some chain enters a split
    targets = nodes.where("next IS NOT NULL").select("file", F.col("next").alias("at")).unionByName(nodes.select("file").distinct().select("file", F.lit(0).cast("long").alias("at"))).distinct()
    nodes = written(nodes.join(targets, ["file", "at"], "left_semi"))
    reached = nodes.where("at = 0").select("file", "at")
    jumps = nodes.where("next IS NOT NULL").select("file", "at", "next")
    hop = 1
    while hop < most:  # after k rounds the first 2^k splits of each file are known
        further = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = settled(reached.unionByName(further.join(nodes.select("file", "at"), ["file", "at"], "left_semi")).distinct())
        jumps = settled(jumps.alias("a").join(jumps.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.at"))).select("a.file", "a.at", "b.next"))
        hop *= 2
    known = reached.select("file", F.col("at").alias("next"), F.lit(True).alias("goes_on"))
    out = nodes.join(reached, ["file", "at"], "left_semi").join(known, ["file", "next"], "left").join(ends, "file")
    return out.select("file", "block", F.col("rel").alias("entry"), (F.coalesce("goes_on", F.lit(False)) | F.coalesce(F.col("next") == F.col("end"), F.lit(False))).alias("verified"))


def _assembled(payload: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        raw = VERSION.join(bytes(v) for v in rows["value"])
        start, fields = _header(raw)
        got = _parsed(fields, raw[start : start + int(fields[b"content-length"])])
        out = pd.DataFrame([[rows["file"].iloc[0], int(rows["offset"].iloc[0]), *got]], columns=["file", "offset", *_PARSED, "payload"])
        out[["page_id", "refers_to"]] = out[["page_id", "refers_to"]].astype("Int64")
        return out if payload else out.drop(columns="payload")

    return run


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=["file", "block", "rel", "value"])

    for file, block, rel, _, value in _splits(batches):
        held.append((file, block, rel, value))
        size += len(value) + 64
        if size > B.BLOCK_BYTES:
            yield close()
            held, size = [], 0
    if held:
        yield close()


def _payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for raw in b.column("value").to_pylist():
            start, fields = _header(raw)
            out.append(_parsed(fields, raw[start : start + int(fields[b"content-length"])])[-1])
        kept = [i for i, c in enumerate(b.schema.names) if c != "value"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(out, pa.binary())], names=[*(b.schema.names[i] for i in kept), "payload"])


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of the archive files under ``path``: ``file``, ``offset``, ``page_id``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to``, ``intact`` (the payload has the digest its header tells).

    With ``payload`` also the bytes (null for revisits), which then cross the network once.
    """
    links = written(_pieces(spark, path).mapInArrow(_links, _LINKS_DDL))
    totals = links.groupBy("file", "block").agg(F.max(F.col("rel") + F.col("size")).alias("total"))
    by_file = Window.partitionBy("file").orderBy("block")  # a row a split
    bases = settled(totals.select("file", "block", "total", (F.sum("total").over(by_file) - F.col("total")).alias("base"), F.count("*").over(Window.partitionBy("file")).alias("splits")))
    most = bases.agg(F.max("splits")).first()[0] or 0
    entries = _entries(links, bases, most)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in links.schema if f.name != "leaves"]
    marked = links.join(entries, ["file", "block"]).groupBy("file", "block").applyInPandas(_mark, ", ".join(kinds))
    marked = written(marked.join(bases.select("file", "block", "base"), ["file", "block"]).withColumn("offset", F.col("base") + F.col("rel")))
    whole = F.col("record_type").isNotNull()
    done = marked.where(whole).select("file", "offset", *_PARSED, "block", "rel")
    n_broken = marked.where(~whole).count()
    scan = _pieces(spark, path).mapInArrow(_placed, "file string, block long, rel long, value binary") if payload or n_broken else None
    if payload:
        done = done.join(scan, ["file", "block", "rel"]).mapInArrow(_payloads, f"file string, block long, rel long, offset long, {_PARSED_DDL}, payload binary")
    done = done.drop("block", "rel")
    if not n_broken:
        return done
    broken = marked.where(~whole).select("file", "offset", (F.col("base") + F.col("to")).alias("end"))
    pieces = _between(links.join(bases.select("file", "block", "base"), ["file", "block"]).select("file", "block", "rel", (F.col("base") + F.col("rel")).alias("at")), broken)
    out = f"file string, offset long, {_PARSED_DDL}" + (", payload binary" if payload else "")
    built = scan.join(pieces, ["file", "block", "rel"]).groupBy("file", "offset").applyInPandas(_assembled(payload), out)
    return done.unionByName(built)


def _between(pieces: DataFrame, broken: DataFrame) -> DataFrame:
    """The pieces that lie in one of the (disjoint) stretches, with its ``offset``."""
    stretch: Column = F.struct("offset", "end")
    both = pieces.withColumn("s", F.lit(None).cast("struct<offset:long,end:long>")).unionByName(
        broken.select("file", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("rel"), F.col("offset").alias("at"), stretch.alias("s"))
    )
    last = F.last("s", ignorenulls=True).over(Window.partitionBy("file").orderBy("at", F.col("s").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("in", last).where("block IS NOT NULL AND in IS NOT NULL AND at < in.end")
    return found.select("file", "block", "rel", "at", F.col("in.offset").alias("offset"))
