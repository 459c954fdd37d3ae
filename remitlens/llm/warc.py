"""Content-addressed WARC archive: payload bytes once, exact record headers beside, records rebuilt by joins.

``write_archive`` leaves two Parquet tables in a folder:

* ``payloads`` (sha256, sha1, bytes, packed): each payload once, compressed, under its SHA-256;
* ``headers`` (page_id, sha256, warc_header, http_header): the exact header bytes of every record.

Of records with equal payloads (of at least ``min_bytes``) the one with the smallest page_id is the response and
the others are revisits that name it. ``read_archive`` joins the tables, checks both digests and the length of
every payload that it unpacks against the headers, and gives the records back byte by byte.

The copies of a payload never meet in one task: which page is the response is a map-side minimum over (digest,
page_id), and only the response's bytes are written.

Defined results: a null html is an empty payload; null page_ids come last, and of several rows with one page_id and
payload the others are revisits of it; an empty table gives empty tables; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import table
from remitlens.session import shared_dir

DATE = "2024-01-01T00:00:00Z"  # the tables have no fetch time
CRLF = b"\r\n"
PIECE = 256  # rows whose payloads a task unpacks at once
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, row: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{row}')}>"


def http_header(size: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size


def _clean(value: str | None) -> str:
    """A header value: line ends and other controls would break the record."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def warc_header(page_id: int | None, url: str | None, kind: str, row: str, sha1: str, length: int, refers_to: int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, row)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_clean(url)}", f"WARC-Page-ID: {'' if page_id is None else page_id}",
             f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    return CRLF.join(x.encode("utf-8", "surrogatepass") for x in lines) + CRLF * 2


def parse_header(header: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in header.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of ``PIECE`` rows: the Python objects of one run are alive at a time."""
    for b in batches:
        for k in range(0, b.num_rows, PIECE):
            yield b.slice(k, PIECE)


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.cast("binary").alias("payload"), F.sha2(html.cast("binary"), 256).alias("sha256"),
                        F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("_order"))
    eligible = F.octet_length("payload") >= min_bytes
    light = rows.select("page_id", "url", "sha256", "_order", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"), eligible.alias("shared"))
    # which page is the response of a payload, and how many rows have that page's id
    per_page = light.groupBy("sha256", "_order").agg(F.count(F.lit(1)).alias("n"))
    first = per_page.groupBy("sha256").agg(F.min(F.struct("_order", "n")).alias("m")).select("sha256", F.col("m._order").alias("first"), F.col("m.n").alias("n"))
    f = first.alias("f")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in pieces(batches):
            packed = [z.compress(x) for x in b.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("sha256"), b.column("_order"), pa.array(packed, pa.binary())], names=["sha256", "_order", "packed"])

    packed = rows.select("sha256", "_order", "payload").mapInArrow(pack, "sha256 string, _order long, packed binary").alias("r")
    chosen = packed.join(f, (F.col("r.sha256") == F.col("f.sha256")) & (F.col("r._order") == F.col("f.first"))).select("r.sha256", "r.packed", "f.n")
    # more than one row only where rows repeat both id and payload
    once = chosen.where("n = 1").unionByName(chosen.where("n > 1").groupBy("sha256").agg(F.min("packed").alias("packed"), F.first("n").alias("n")))
    once.select("sha256", "packed").write.parquet(f"{path}/payloads")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            got = b.to_pydict()
            out = {"page_id": [], "sha256": got["sha256"], "warc_header": [], "http_header": []}
            for page, url, sha1, size, kind, row, refers in zip(got["page_id"], got["url"], got["sha1"], got["bytes"], got["kind"], got["row"], got["refers_to"]):
                http = http_header(size)
                out["page_id"].append(page)
                out["http_header"].append(http)
                out["warc_header"].append(warc_header(page, url, kind, row, base64.b32encode(bytes.fromhex(sha1)).decode(), len(http) + (size if kind == "response" else 0), refers))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("page_id", pa.int64()), ("sha256", pa.string()), ("warc_header", pa.binary()), ("http_header", pa.binary())]))

    lt = light.alias("l")
    marked = lt.join(f, F.col("l.sha256") == F.col("f.sha256")).select("l.*", "f.first", "f.n")
    is_first = F.col("_order") == F.col("first")
    # rows that repeat id and payload are told apart by a number among themselves; all but the first are revisits
    alone = marked.where(~F.col("shared") | ~is_first | (F.col("n") == 1)).withColumn("_k", F.lit(1))
    again = marked.where(F.col("shared") & is_first & (F.col("n") > 1)).withColumn("_k", F.row_number().over(W.partitionBy("sha256").orderBy("url")))
    marked = alone.unionByName(again)
    response = ~F.col("shared") | (is_first & (F.col("_k") == 1))
    marked = marked.select("page_id", "url", "sha1", "sha256", "bytes", F.when(response, "response").otherwise("revisit").alias("kind"),
                           F.concat_ws("/", "sha256", "url", F.col("_k").cast("string")).alias("row"),
                           F.when(~response & (F.col("first") < (1 << 63) - 1), F.col("first")).alias("refers_to"))
    marked.mapInArrow(head, "page_id long, sha256 string, warc_header binary, http_header binary").write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str, records: bool = True) -> DataFrame:
    """Every record of the archive: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if ``records``,
    ``record``, the bytes of the whole WARC record. Fails on a payload that does not match its digests or headers."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["record"] * records
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * records

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in pieces(batches):
            out = []
            for sha256, warc, http, packed in zip(*[b.column(c).to_pylist() for c in ("sha256", "warc_header", "http_header", "packed")]):
                h, payload = parse_header(warc), z.decompress(packed)
                digest = sha1_base32(payload)
                kind = h["WARC-Type"]
                body = http + payload if kind == "response" else http
                if hashlib.sha256(payload).hexdigest() != sha256 or h["WARC-Payload-Digest"] != f"sha1:{digest}" or int(h["Content-Length"]) != len(body):
                    raise ValueError(f"record {h['WARC-Record-ID']}: payload and headers disagree")
                page, refers = h["WARC-Page-ID"], h.get("WARC-Refers-To-Page-ID")
                row = (int(page) if page else None, h["WARC-Target-URI"], len(payload), digest, kind, int(refers) if refers else None)
                out.append(row + ((warc + body + CRLF * 2,) if records else ()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(len(names))], names=names)

    joined = headers.join(payloads, "sha256", "left").select("sha256", "warc_header", "http_header", "packed")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", record binary" * records
    return joined.mapInArrow(rebuild, schema)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/remitlens/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path, records=False).drop("url")
