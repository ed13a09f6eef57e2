"""WARC archives: writing with segmentation and revisits, and reassembly on reading.

Writing: of pages with equal payloads of at least ``REVISIT_FROM`` bytes, the one with the
largest id is a response and the others are revisits of it. A payload is framed as chunked
HTTP transfer. A record longer than a segment is cut: its first part keeps the type
``response``, the others are ``continuation`` records that name it as their origin. Each
task writes gzipped archives under names of its own and rolls to the next at a size limit;
what it finished is listed in a manifest, so lost tasks can run again.

Reading: archives are read as streams, record by record. Segments are grouped by origin,
ordered by segment number, and joined if the numbers run from 1 and the lengths add up to
the total the last one states; the chunked framing is then decoded and the payload's
SHA-1 compared with the header. A record that fails any of this is an error. The length
of a revisit's payload comes from its own header.

A null html is an empty payload; a null id is the string ``null`` in the URI and null
again on reading; rows with the same id are records of their own, told apart by the
record id. Of equal payloads under the same largest id one is the response. An empty
table gives no archives and no rows. Equal payloads are those with equal SHA-256 and length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.text import with_row
from touchline.llm.tokens import open_folder
from touchline.session import Scratch

REVISIT_FROM = 1000
SEGMENT = 16 << 10
CHUNK = 4 << 10
ARCHIVE = 32 << 20
_DATE = "2024-01-01T00:00:00Z"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        part = body[end + 2 : end + 2 + n]
        if len(part) != n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("broken chunked framing")
        out.append(part)
        at = end + 4 + n


def _urn(key: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(key.encode()).hexdigest())}>"


def record(kind: str, fields: dict[str, str | int], block: bytes) -> bytes:
    """One gzip member with one record."""
    head = {"WARC-Type": kind, "WARC-Date": _DATE, **fields, "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    pack = zlib.compressobj(1, wbits=31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def records(
    key: str, page_id: int | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool, segment: int
) -> Iterator[bytes]:
    """The records of one page."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    fields = {
        "WARC-Record-ID": _urn(key),
        "WARC-Target-URI": f"urn:page:{'null' if page_id is None else page_id}",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To-Target-URI"] = f"urn:page:{'null' if refers_to is None else refers_to}"
        yield record("revisit", fields, _HEAD)
        return
    block = _HEAD + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(parts) == 1:
        yield record("response", fields, block)
        return
    yield record("response", {**fields, "WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = {
            "WARC-Record-ID": _urn(f"{key}/{n}"),
            "WARC-Target-URI": fields["WARC-Target-URI"],
            "WARC-Segment-Origin-ID": fields["WARC-Record-ID"],
            "WARC-Segment-Number": n,
        }
        if n == len(parts):
            more["WARC-Segment-Total-Length"] = len(block)
        yield record("continuation", more, part)


def _archive_writer(folder: str, segment: int, limit: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        name, out, size = "", None, 0
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                key, page, payload, sha1, refers, revisit = (c[i].as_py() for c in batch.columns)
                for member in records(str(key), page, payload, sha1, refers, revisit, segment):
                    if out is None or size >= limit:
                        if out is not None:
                            out.close()
                            done.append(name)
                        name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{path}/{name}", compression=None)
                    size += out.write(member) or len(member)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["name"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string())], ["name"])

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    html: str = "html",
    segment: int = SEGMENT,
    limit: int = ARCHIVE,
) -> DataFrame:
    """Write a record per row of ``pages`` into a shared folder; return the archives' names."""
    spark = pages.sparkSession
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    with Scratch(spark, "warc") as scratch:
        payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
        rows = scratch.write(with_row(pages, page=F.col(page_id).cast("long"), payload=payload), "rows")
        size = F.octet_length("payload")
        rows = rows.withColumn("same", F.when(size >= REVISIT_FROM, F.concat(F.sha2("payload", 256), size)))
        # Only payloads found more than once travel: pre-aggregated, then joined by key.
        found = rows.where("same IS NOT NULL").groupBy("same")
        found = found.agg(F.max(F.struct("page", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
        found = scratch.write(found.where("n > 1").select("same", "last"), "repeated")
        older = rows.select("row", "same").join(found, "same")
        older = scratch.write(older.where("row <> last.row").select("row", "last.page"), "older")
        marked = rows.drop("same").join(older.withColumnRenamed("page", "refers_to").withColumn("revisit", F.lit(True)), "row", "left")
        ready = marked.select(
            "row",
            "page",
            "payload",
            F.sha1("payload"),
            "refers_to",
            F.coalesce("revisit", F.lit(False)),
        )
        ready.mapInArrow(_archive_writer(folder, segment, limit), "name string").write.parquet(f"{folder}/manifest")
    return spark.read.schema("name string").parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of every record of a stream of gzip members."""
    buffer, unpack = bytearray(), zlib.decompressobj(31)
    left = b""
    while True:
        if not left:
            left = stream.read(1 << 18)
            if not left:
                break
        buffer += unpack.decompress(left)
        left = unpack.unused_data
        if unpack.eof:
            head, _, rest = bytes(buffer).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            n = int(fields["Content-Length"])
            if not version.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
                raise ValueError("broken record")
            yield fields, rest[:n]
            buffer, unpack = bytearray(), zlib.decompressobj(31)
    if buffer:
        raise ValueError("the archive ends within a record")


_SEGMENT = (
    "kind string, origin string, number int, total long, uri string, digest string, "
    "payload_length long, refers_to string, block binary"
)


def _archive_reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        names = [f.split()[0] for f in _SEGMENT.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for f, block in parse(stream):
                        number, total, length = (
                            int(f[k]) if k in f else None
                            for k in ("WARC-Segment-Number", "WARC-Segment-Total-Length", "X-Payload-Length")
                        )
                        rows.append(
                            (
                                f["WARC-Type"],
                                f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]),
                                number,
                                total,
                                f.get("WARC-Target-URI"),
                                f.get("WARC-Payload-Digest"),
                                length,
                                f.get("WARC-Refers-To-Target-URI"),
                                block,
                            )
                        )
                        size += len(block)
                        if size > 8 << 20:
                            yield packed(rows)
                            rows, size = [], 0
                if rows:
                    yield packed(rows)

    return read


_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("urn:page:")
    return int(name) if name not in ("", "null") else None


def _decoder(with_payload: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(first, 64).to_pylist():
                    digest = base64.b32decode(r["digest"].removeprefix("sha1:")).hex()
                    payload, length = None, r["payload_length"]
                    if r["kind"] == "response":
                        head, _, body = r["block"].partition(b"\r\n\r\n")
                        payload = dechunked(body) if b"Transfer-Encoding: chunked" in head else body
                        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != length:
                            raise ValueError(f"payload of {r['uri']} differs from its header")
                    row = [_page(r["uri"]), length, digest, r["kind"], _page(r["refers_to"])]
                    rows.append(row + [payload] * with_payload)
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names, kinds = names + ["payload"] * with_payload, kinds + [pa.binary()] * with_payload
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return decode


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole records of segmented ones: grouped by origin, in order, lengths verified."""
    joined = segments.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max(F.when(F.col("kind") != "continuation", F.struct("kind", "uri", "digest", "payload_length", "refers_to"))).alias("first"),
    )
    hexes = F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), "")
    whole = joined.withColumn("block", F.unhex(hexes))
    right = (
        (F.element_at("parts", -1)["number"] == F.size("parts"))
        & (F.col("parts")[0]["number"] == 1)
        & (F.octet_length("block") == F.col("total"))
        & F.col("first").isNotNull()
    )
    fault = F.concat(F.lit("segments of "), "origin", F.lit(" are missing or of the wrong length"))
    block = F.when(F.coalesce(right, F.lit(False)), F.col("block")).otherwise(F.raise_error(fault).cast("binary"))
    return whole.select("first.kind", "first.uri", "first.digest", "first.payload_length", "first.refers_to", block.alias("block"))


def read_archives(names: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per page of the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and with ``with_payload`` the payload of responses."""
    # With a given number, the few rows that each stand for an archive are not merged into one task.
    spread = names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    read = spread.mapInArrow(_archive_reader(folder), _SEGMENT)
    columns = ["kind", "uri", "digest", "payload_length", "refers_to", "block"]
    single = read.where("number IS NULL").select(*columns)
    whole = reassemble(read.where("number IS NOT NULL"))
    schema = _PAGE + ", payload binary" * with_payload
    return single.union(whole.select(*columns)).mapInArrow(_decoder(with_payload), schema)
