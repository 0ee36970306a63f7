"""Web archives with revisit records.

Pages become WARC/1.1 records. Of pages with equal payloads one is stored as response; the others
become revisit records that refer to it and hold no payload. To decide this, only headers (digest,
page id) are shuffled, and the originals among them are joined to the pages. Archives are written by the
tasks themselves, each into a new file, every record as a gzip member of its own. The list of files
is a stored table, so files of lost or repeated task attempts are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from lernspur.runtime import materialize, table_root

LEAST_BYTES = 100
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
_CHUNK = 1 << 20


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Add payload_bytes, payload_digest, record_type and refers_to to (page_id, url, html).

    Among pages with equal payloads of ``least_bytes`` or more, the smallest page_id is the
    response. Null html is an empty payload. A null page_id comes after all others and never is an
    original; a group of null ids alone is all responses, as are repeated rows of the smallest id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"))
    headers = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    originals = headers.where((F.col("_n") > 1) & F.col("_first").isNotNull()).drop("_n")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(originals, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record with fresh headers; ``refers_to`` makes it a revisit."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    else:
        head.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(resolved: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of :func:`revisits` below ``folder``; the stored list (file, records, bytes)."""

    def write(batches):
        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        out, count, size = None, 0, 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        fs, path = pafs.FileSystem.from_uri(name)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(path)
                    data = _member(record(
                        row["page_id"], row["url"], (row["html"] or "").encode("utf-8", "surrogatepass"),
                        row["payload_digest"], row["refers_to"], date))
                    out.write(data)
                    count, size = count + 1, size + len(data)
        finally:
            if out is not None:
                out.close()
        if count:
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})

    return materialize(resolved.mapInArrow(write, "file string, records long, bytes long"))


def _records(stream):
    """Header dictionary, block of each record of one archive, one gzip member at a time."""
    held = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            held = held or stream.read(_CHUNK)
            if not held:
                if parts:
                    raise ValueError("archive ends within a record")
                return
            parts.append(z.decompress(held))
            held = z.unused_data if z.eof else b""
        data = b"".join(parts)
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield fields, rest[:int(fields["Content-Length"])]


_READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, html string")


def read_archives(files: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the listed archives; digests and lengths of responses come from their payloads.

    A revisit has the digest and the length that its headers state. ``html`` is null unless asked for.
    """

    def read(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, path = pafs.FileSystem.from_uri(name)
                rows, held = [], 0
                with fs.open_input_stream(path) as stream:
                    for fields, block in _records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        row = {
                            "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
                            "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
                            "refers_to": None, "html": None}
                        if row["record_type"] == "revisit":
                            row["payload_bytes"] = int(http.rpartition(b"Content-Length: ")[2])
                            row["payload_digest"] = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                            row["refers_to"] = int(fields["X-Refers-To-Page-ID"])
                        else:
                            row["payload_bytes"] = len(payload)
                            row["payload_digest"] = hashlib.sha256(payload).hexdigest()
                            if payloads:
                                row["html"] = payload.decode("utf-8", "surrogatepass")
                        rows.append(row)
                        held += len(block) if payloads else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _schema())
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _schema())

    return files.select("file").mapInArrow(read, _READ)


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _READ.split(", "))])


def new_folder(spark: SparkSession, name: str) -> str:
    root = table_root(spark)
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    return f"{root}/lernspur-{name}/{uuid.uuid4().hex}"


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Write deduplicated archives of all pages and return their records as read back."""
    spark = pages.sparkSession
    files = write_archives(revisits(pages, least_bytes), folder or new_folder(spark, "warc"))
    count = files.count()
    return read_archives(files.repartition(max(1, count)))
