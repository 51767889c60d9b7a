"""WARC archives: write records with an index, read selected records by coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.llm.common import column, shared_path, slices

FILE_BYTES = 256 << 20  # an archive file is closed beyond this size
GAP_BYTES = 64 << 10  # records at most this far apart are read together
RANGE_BYTES = 8 << 20  # a joined read stays within this, but for one larger record
SECTION_BYTES = 16 << 20  # of an archive file, read by one task
BROADCAST_GROUPS = 200_000  # more payloads with copies than this are joined by a shuffle
SALT = 16
INDEX = ("file string, offset long, length long, id long, url string, payload_bytes long, "
         "payload_digest string, record_type string, refers_to long")
RECORDS = ("id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")
_URN = "urn:kwpulse:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(s: str) -> str:
    """A URL as header text: bytes outside printable ASCII are percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass"))
                   for c in s)


def record(rec_id, url, payload: bytes, refers_to) -> bytes:
    """One gzip member holding one WARC/1.1 record (a response, or a revisit without its body)."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    urn = f"{_URN}{rec_id}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{urn}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_header_text(url) if url else urn}",
            f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{_URN}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=6, mtime=0)


def parse(member: bytes) -> dict:
    """The record of one gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("WARC record has a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, found = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != found):
        raise ValueError("WARC payload does not match its digest")
    number = lambda v: None if v == "None" else int(v)
    refers = fields.get("WARC-Refers-To")
    return {"id": number(fields["WARC-Record-ID"][1:-1].removeprefix(_URN)), "url": fields["WARC-Target-URI"],
            "payload_bytes": size, "payload_digest": found, "record_type": kind,
            "refers_to": None if refers is None else number(refers[1:-1].removeprefix(_URN)),
            "payload": payload if kind == "response" else None}


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A new name for every attempt: the index names only the files of attempts that succeeded.
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for b in slices(batches, "payload", max_bytes=RANGE_BYTES):
            rows = []
            for r in b.to_pylist():
                if out is None:
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record(r["id"], r["url"], r["payload"], r["refers_to"])
                out.write(member)
                rows.append({"file": name, "offset": at, "length": len(member), "id": r["id"], "url": r["url"],
                             "payload_bytes": len(r["payload"]), "payload_digest": digest(r["payload"]),
                             "record_type": "response" if r["refers_to"] is None else "revisit",
                             "refers_to": r["refers_to"]})
                at += len(member)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_ARROW)
        if out is not None:
            out.close()
    return write


_INDEX_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.int64()),
                          ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64())])
_RECORD_ARROW = pa.schema([("id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64()), ("payload", pa.binary())])


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, id_col: str = "page_id",
               url_col: str = "url", body_col: str = "html") -> None:
    """Write a record per row under ``path``: ``archive/*.warc.gz`` and ``index/`` (Parquet, one row
    per record: file, offset, length, url, digest, type).

    The payload is the body in UTF-8 (null: empty). Of the records with one payload of at least
    ``min_revisit_bytes`` bytes, that with the smallest id is the response and the others are revisits
    of it; shorter payloads are always responses. Rows that repeat both the payload and the smallest id
    are all responses; null ids come after all others. Other columns are not read. An empty table gives
    an empty index.

    The rows are not shuffled: the smallest id of each payload that occurs more than once is found by
    a map-side aggregate over digests and joined back, broadcast while those payloads number at most
    ``BROADCAST_GROUPS`` (counted), else by a shuffle with salted keys. A task streams into its own
    new files, and only the index of a successful attempt names them.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_sha", F.sha1("payload"))
    copies = (rows.where(F.length("payload") >= min_revisit_bytes).groupBy("_sha")
              .agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1 AND _first IS NOT NULL").select("_sha", "_first"))
    spark = pages.sparkSession
    copies.write.parquet(f"{path}/copies")
    copies = spark.read.schema(copies.schema).parquet(f"{path}/copies")
    if copies.count() <= BROADCAST_GROUPS:
        rows = rows.join(F.broadcast(copies), "_sha", "left")
    else:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALT)))
        copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        rows = rows.join(copies, ["_sha", "_salt"], "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") != F.col("_first")), F.col("_first"))
    rows = rows.select("id", "url", "payload", refers.alias("refers_to"))
    rows.mapInArrow(_writer(f"{path}/archive"), INDEX).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        name, handle = None, None
        run: list[tuple[int, int]] = []

        def flush():
            nonlocal run
            first, end = run[0][0], run[-1][0] + run[-1][1]
            data = memoryview(handle.read_at(end - first, first))
            rows = [parse(data[o - first:o - first + n]) for o, n in run]
            run = []
            return pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)

        for b in batches:
            for f, o, n in zip(column(b, "file").to_pylist(), column(b, "offset").to_pylist(),
                               column(b, "length").to_pylist(), strict=True):
                if run and (f != name or o - (run[-1][0] + run[-1][1]) > GAP_BYTES
                            or o + n - run[0][0] > RANGE_BYTES):
                    yield flush()
                if f != name:
                    if handle is not None:
                        handle.close()
                    name, handle = f, store.open_input_file(f"{root}/{f}")
                run.append((o, n))
        if run:
            yield flush()
        if handle is not None:
            handle.close()
    return read


def read_records(selected: DataFrame, path: str) -> DataFrame:
    """The records of the selected index rows (a subset of ``read_index``), parsed and checked.

    Index rows are dealt by file and section of ``SECTION_BYTES`` to as many tasks as the bytes they
    name ask for (the index itself is small), sorted by offset, and neighbouring byte ranges are read in one request of at most ``RANGE_BYTES`` (one larger record is read alone)."""
    section = F.floor(F.col("offset") / SECTION_BYTES)
    total = selected.agg(F.sum("length")).first()[0] or 0
    rows = (selected.select("file", "offset", "length").withColumn("_section", section)
            .repartition(int(total // SECTION_BYTES) + 1, "file", "_section").sortWithinPartitions("file", "offset")
            .select("file", "offset", "length"))
    return rows.mapInArrow(_reader(f"{path}/archive"), RECORDS)


def roundtrip(pages: DataFrame, min_revisit_bytes: int = 0, **cols) -> DataFrame:
    """Write all rows to a new archive in the shared folder and read all its records back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_warc(pages, path, min_revisit_bytes, **cols)
    return read_records(read_index(spark, path), path)
