"""WARC archives: the index is written with the archive, and records are read back in coalesced byte ranges."""

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from staypath.llm.frames import staged
from staypath.sources.tables import shared_folder

#: payloads of fewer bytes are always stored
LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: a range is read over gaps of so many bytes, and up to so many bytes at once
GAP, RANGE_BYTES = 64 << 10, 4 << 20
#: a reading task covers about so many bytes of a file
SPLIT_BYTES = 16 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
    ("page_id", pa.int64()), ("record_type", pa.string())])
INDEX_DDL = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the response's HTTP header, whose length is that of the payload left out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The record's fields, with payload bytes (None for a revisit), their full length and bare hex digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload": None if revisit else payload, "payload_bytes": length,
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "refers_to": _page(fields.get("WARC-Refers-To"))}


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _write(folder):
    def run(batches):
        system, path = _place(folder)
        system.create_dir(path, recursive=True)
        name, offset, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            columns = {c: [] for c in INDEX.names}
            for page, url, html, leader in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "leader"))):
                payload = html or b""
                revisit = leader is not None and leader != page
                raw = gzip.compress(record(page, url, payload, leader, revisit), 6, mtime=0)
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                out.write(raw)
                row = (f"{folder}/{name}", offset, len(raw), url, hashlib.sha1(payload).hexdigest(), page, "revisit" if revisit else "response")
                for c, value in zip(INDEX.names, row):
                    columns[c].append(value)
                offset += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in INDEX], schema=INDEX)
        if out:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` and returns the index, itself written: ``file, offset, length, url, digest, page_id, record_type``.

    Of records with equal payloads of ``least_bytes`` or more the one with the largest page_id is the response
    and the others revisit it; rows that share the largest id are all responses, and payloads that no row with
    an id has are stored each time. Null html is an empty payload, a null url is left out.

    A task writes a file of its own under a new name and its rows of the index. Only index rows of tasks that
    succeeded are kept, so files of lost or repeated tasks are never read.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    keyed = rows.withColumns({"sha": F.sha1("html"), "size": F.octet_length("html")})
    leaders = (
        keyed.where(F.col("size") >= least_bytes).groupBy("sha")
        .agg(F.max("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1").select("sha", "leader"))
    led = keyed.join(leaders, "sha", "left").select("page_id", "url", "html", "leader")
    return staged(led.mapInArrow(_write(folder), INDEX_DDL))


RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
RECORD_DDL = "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint"


def ranges(rows):
    """Groups (file, offset, length) rows in order into reads: (file, start, end, rows)."""
    current = None
    for file, offset, length in rows:
        fits = current and current[0] == file and offset <= current[2] + GAP and max(current[2], offset + length) - current[1] <= RANGE_BYTES
        if fits:
            current[2] = max(current[2], offset + length)
            current[3].append((offset, length))
        else:
            if current:
                yield current
            current = [file, offset, offset + length, [(offset, length)]]
    if current:
        yield current


def _read(batches):
    open_name, source = None, None
    triples = ((f, o, n) for b in batches for f, o, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))))
    for file, start, end, rows in ranges(triples):
        if file != open_name:
            if source:
                source.close()
            system, path = _place(file)
            open_name, source = file, system.open_input_file(path)
        data = source.read_at(end - start, start)
        found = [parsed(gzip.decompress(data[o - start:o - start + n])) for o, n in rows]
        for r in found:
            if r["payload"] is not None and (len(r["payload"]) != r["payload_bytes"] or hashlib.sha1(r["payload"]).hexdigest() != r["payload_digest"]):
                raise ValueError(f"{file}: the payload of page {r['page_id']} does not match its digest")
        yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in found], f.type) for f in RECORD], schema=RECORD)
    if source:
        source.close()


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` rows point to: page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to.

    Give it a filtered index to read a selection; only the bytes of selected records, and small gaps, are read.
    """
    place = index.select("file", "offset", "length", F.floor(F.col("offset") / SPLIT_BYTES).alias("split"))
    # by bytes to read, not by the size of the index, which says little; a fixed number is not merged by AQE
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // SPLIT_BYTES))
    ordered = place.repartition(tasks, "file", "split").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(_read, RECORD_DDL)
