"""WARC archives: one gzip member per record, written by the tasks that hold
the pages and read back sequentially.

Writer. A narrow pass groups payload digests; of the records with equal
payloads of at least ``min_bytes`` bytes the one with the smallest id is a
``response`` and the others become ``revisit`` records, which keep the digest
and length of the full payload and name the response they refer to, but
carry no payload. The pages then meet the digests that occur more than once
(broadcast while they are counted few, so that pages are not shuffled) and every
task streams its records into one file of the shared folder. The
manifest (one row per file) names the files of committed attempts only.

Reader. A file is read front to back in blocks of ``BLOCK`` bytes. Each gzip
member is inflated incrementally; the record header ends at the first empty
line, ``Content-Length`` frames the block, and the block and payload digests
are computed while it passes by, so neither a file nor a record's compressed
form is ever held whole. A wrong digest, length or frame raises.

Nulls and ties: a null html is the empty payload; a null url leaves the target
address out; blanks and control characters in a url are percent-encoded. A null
id is larger than any other; if a group has no id at all, all its rows are
responses. Rows that repeat the smallest id of a group cannot be told apart
and are all responses. An empty table gives no files and no rows. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import small_batches
from delaylens.llm.files import create, open_stream
from delaylens.session import materialize, scratch_path

BLOCK = 1 << 16
ROWS_OUT = 1000
BATCH_ROWS = 500
#: repeated digests up to which their table (20 bytes and an id each) is broadcast
SHARED_ROWS = 200_000
DATE = "2024-01-01T00:00:00Z"      # fixed, so that reruns write the same bytes
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, uncompressed. With ``refers_to`` a revisit without payload."""
    revisit = refers_to is not None
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = {"WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": _record_id(page_id if page_id is not None else uuid.uuid4()), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = _safe(url)
    if page_id is not None:
        head["X-Page-Id"] = page_id
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page-Id": refers_to}
    head |= {"X-Payload-Length": len(payload), "WARC-Payload-Digest": "sha1:" + sha1_base32(payload),
             "WARC-Block-Digest": "sha1:" + sha1_base32(block),
             "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def members(stream) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator over inflated parts;
    a member must be used up before the next."""
    rest = stream.read(BLOCK)
    while rest:
        inflate, ended = zlib.decompressobj(31), False

        def parts():
            nonlocal rest, ended
            while not inflate.eof:
                if not rest:
                    raise ValueError("the archive ends inside a gzip member")
                out = inflate.decompress(rest, BLOCK)
                # at the end of a member only unused_data holds what follows
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail or stream.read(BLOCK)
                if out:
                    yield out
            rest, ended = rest or stream.read(BLOCK), True

        yield parts()
        if not ended:
            raise ValueError("a member was left unread")


def read_record(parts: Iterator[bytes], keep: bool = False) -> dict:
    """Header fields, computed digests and, if ``keep``, the payload of one record."""
    buffer = b""
    for part in parts:
        buffer += part
        if b"\r\n\r\n" in buffer:
            break
    head, found, body = buffer.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no record header")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    left = int(fields["Content-Length"])
    block, payload, http, kept, size, tail = hashlib.sha1(), hashlib.sha1(), b"", [], 0, b""
    in_payload = False
    while True:
        now, over = body[:left], body[left:]
        left -= len(now)
        block.update(now)
        if not in_payload:
            http += now
            http, in_payload, now = http.partition(b"\r\n\r\n")[0] if b"\r\n\r\n" in http else http, b"\r\n\r\n" in http, \
                http.partition(b"\r\n\r\n")[2]
        if in_payload:
            payload.update(now)
            size += len(now)
            if keep:
                kept.append(now)
        tail += over
        body = next(parts, None)
        if body is None:
            break
    digest = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
    if left or tail != b"\r\n\r\n":
        raise ValueError(f"{fields.get('WARC-Record-ID')}: the block does not end where its header says")
    if digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"{fields.get('WARC-Record-ID')}: block digest differs")
    if fields["WARC-Type"] == "response" and (digest(payload), size) != (fields["WARC-Payload-Digest"],
                                                                         int(fields["X-Payload-Length"])):
        raise ValueError(f"{fields.get('WARC-Record-ID')}: payload digest or length differs")
    return fields | {"payload": b"".join(kept)} if keep else fields


def _with_first(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` with the ``first_id`` of their digest. ``shared`` (a written table: digest,
    first_id, n) is broadcast if a count shows it small; then no page is shuffled. Else
    digests that hold over one in ``SHARED_ROWS`` of the repeated pages are broadcast, as there
    can be no more than that of them, and only the others are joined by a shuffle, in
    which a page whose digest is already met goes by a key of its own."""
    if shared.limit(SHARED_ROWS + 1).count() <= SHARED_ROWS:
        return rows.join(F.broadcast(shared.drop("n")), "digest", "left")
    floor = shared.agg(F.sum("n")).first()[0] / SHARED_ROWS
    hot = shared.where(F.col("n") > floor).select(F.col("digest").alias("hot_digest"), F.col("first_id").alias("hot_id"))
    cold = shared.where(F.col("n") <= floor).select(F.col("digest").alias("met"), F.col("first_id").alias("cold_id"))
    own = F.encode(F.concat(F.lit("own "), F.xxhash64("page_id", "url").cast("string")), "utf-8")
    met = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    # no key of its own equals a digest: those are 20 bytes without the leading word
    met = met.withColumn("met", F.when(F.col("hot_digest").isNull(), F.col("digest")).otherwise(own))
    return (met.join(cold, "met", "left").withColumn("first_id", F.coalesce("hot_id", "cold_id"))
            .drop("met", "hot_digest", "hot_id", "cold_id"))


def write_warc(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Write the archives; returns the manifest (path, n_records), a written table."""
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    digest = F.unhex(F.sha1(F.col("html").cast("binary")))
    shared = (rows.where(F.octet_length("html") >= min_bytes).groupBy(digest.alias("digest"))
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    found = _with_first(rows.withColumn("digest", digest), materialize(shared, "warc-shared"))
    marked = found.select("page_id", "url", "html",
                          F.when((F.octet_length("html") >= min_bytes) & (F.coalesce("page_id", F.col("first_id") - 1)
                                                                          != F.col("first_id")),
                                 F.col("first_id")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                out = out or create(name)
                page_id, url, html, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                out.write(gzip_member(record(page_id, url, html.encode("utf-8"), refers_to)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]})

    with small_batches(pages.sparkSession, BATCH_ROWS):
        return materialize(marked.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """Per record, from the archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        rows = []
        for batch in batches:
            for path, n_records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = 0
                with open_stream(path) as stream:
                    for parts in members(stream):
                        f = read_record(parts)
                        n += 1
                        rows.append((number(f.get("X-Page-Id")), int(f["X-Payload-Length"]),
                                     f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"],
                                     number(f.get("X-Refers-To-Page-Id"))))
                        if len(rows) >= ROWS_OUT:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows = []
                if n != n_records:
                    raise ValueError(f"{path} holds {n} of {n_records} records")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return (manifest.repartition(max(1, manifest.count()), "path")
            .mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex),
digits AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((((
            (strpos('0123456789abcdef', substr(hex, CAST(i * 5 // 4 + 1 AS INT), 1)) - 1) * 16
            + strpos('0123456789abcdef', substr(hex || '0', CAST(i * 5 // 4 + 2 AS INT), 1)) - 1)
            >> CAST(3 - (i * 5) % 4 AS INT)) & 31)) AS INT), 1), '' ORDER BY i) AS b32
  FROM firsts, range(32) AS r(i) GROUP BY hex)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, digits.b32 AS payload_digest,
       CASE WHEN p.page_id = firsts.first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> firsts.first_id THEN firsts.first_id END AS refers_to
FROM p JOIN firsts USING (hex) JOIN digits USING (hex)
"""
