"""WARC archives: written with an index, read back by coalesced byte ranges.

Each task writes one archive (a gzip member per record) to the shared folder and returns the index rows: file, offset,
length, URL, digest. The index is stored before anything is read, so a repeated task leaves at most an archive that
no index row names. Reading starts from any selection of index rows, sorts them by place, and fetches neighbours
with one ranged read. Files are opened through pyarrow's file systems, so local and object stores behave alike.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import join_counted
from goldrec.session import scratch_path, stage

#: Ranges with a gap of at most GAP bytes are read together, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
#: Bytes of records that a task reads.
TASK = 16 << 20
#: The archives are a function of their input, so the date is a parameter.
DATE = "2024-01-01T00:00:00Z"
INDEX = "page_id long, record_type string, refers_to long, file string, offset long, length long, url string, digest string"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is a local one."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(text: str) -> str:
    """Header values are one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(1, ("WARC-Target-URI", _header_text(url)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{digest}')}>"),
            ("X-Refers-To-Key", str(refers_to)),
        ]
    if page_id is not None:
        fields.append(("X-Record-Key", str(page_id)))
    record = "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _payload_key() -> tuple:
    """Digest and length of the payload; a page_id may repeat with different ones."""
    body = F.coalesce(F.col("html"), F.lit(""))
    return F.sha1(F.encode(body, "UTF-8")).alias("body_digest"), F.octet_length(body).alias("n")


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, body_digest, n, refers_to) of rows whose payload the row with the largest page_id of that payload repeats.

    Only ids and digests are grouped. Rows that tie for the largest id are all responses; a null id is below all others.
    """
    keyed = stage(pages.select(F.col("page_id").cast("long"), *_payload_key()), "digests")
    last = keyed.groupBy("body_digest", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).where("copies > 1 AND refers_to IS NOT NULL")
    return keyed.join(last, ["body_digest", "n"]).where("page_id < refers_to").select("page_id", "body_digest", "n", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every row (page_id, url, html) as a record; returns the stored index. Null html is an empty payload.

    Repeated rows give repeated records; a null url gives a record without target. A row whose id is null is written
    as a response.
    """
    roles = stage(revisits(pages), "revisits")
    pages = pages.select(F.col("page_id").cast("long"), "url", "html", *_payload_key())
    rows = join_counted(pages, roles, ["page_id", "body_digest", "n"], "left", 80).select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name = f"{base}/{uuid.uuid4().hex}.warc.gz"
        at = 0
        sink = None
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (c[i].as_py() for c in batch.columns)
                payload = (html or "").encode()
                digest = payload_digest(payload)
                member = write_record(page_id, url, payload, digest, refers_to, refers_to is not None)
                sink = sink or store.open_output_stream(name, compression=None)
                sink.write(member)
                row = (page_id, "response" if refers_to is None else "revisit", refers_to, name, at, len(member), url, digest)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                at += len(member)
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["page_id", "record_type", "refers_to", "file", "offset", "length", "url", "digest"])
        if sink:
            sink.close()

    return stage(rows.mapInArrow(write, INDEX), "index")


def coalesce_ranges(ranges: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last + 1) of reads that cover sorted (offset, length) ranges."""
    reads: list[list[int]] = []
    for i, (offset, length) in enumerate(ranges):
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            reads[-1][1] = max(reads[-1][1], offset + length)
            reads[-1][3] = i + 1
        else:
            reads.append([offset, offset + length, i, i + 1])
    return [tuple(r) for r in reads]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, url, payload, payload_digest) of the selected index rows.

    The digest is of the payload as read; a revisit has none and names that of the record it refers to.

    Rows are dealt by stretches of READ bytes of one file and sorted by offset, so a task's neighbours share reads. The
    number of tasks follows from the bytes to read, not from the small rows of the index.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        source, opened = None, None
        names = ["page_id", "record_type", "refers_to", "url", "payload", "payload_digest"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            files, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            low = 0
            while low < len(files):
                high = low
                while high < len(files) and files[high] == files[low]:
                    high += 1
                if opened != files[low]:
                    if source:
                        source.close()
                    source, opened = store.open_input_file(files[low]), files[low]
                for start, end, first, last in coalesce_ranges(list(zip(offsets[low:high], lengths[low:high], strict=True))):
                    raw = source.read_at(end - start, start)
                    out: list[list] = [[] for _ in names]
                    for i in range(low + first, low + last):
                        fields, payload = parse_record(raw[offsets[i] - start : offsets[i] - start + lengths[i]])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:") if fields["warc-type"] == "revisit" else payload_digest(payload)
                        key, refers = fields.get("x-record-key"), fields.get("x-refers-to-key")
                        row = (int(key) if key else None, fields["warc-type"], int(refers) if refers else None, fields.get("warc-target-uri"), payload, digest)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                low = high
        if source:
            source.close()

    chosen = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / READ))
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // TASK) or 1
    dealt = chosen.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")
    return dealt.mapInArrow(read, "page_id long, record_type string, refers_to long, url string, payload binary, payload_digest string")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read every record back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Size and digest are of the payload as read; a revisit has those of the response that it names.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    back = read_records(index, folder).select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest")
    back = stage(back, "records")
    response = back.where("record_type = 'response'")
    revisit = back.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "payload_digest")
    target = response.select(F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest").dropDuplicates(["refers_to", "payload_digest"])
    seen = revisit.join(target, ["refers_to", "payload_digest"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return response.select(*columns).union(seen.select(*columns))
