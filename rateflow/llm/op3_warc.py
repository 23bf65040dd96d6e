"""WARC archives: write with an index, read back by coalesced byte ranges.

``write_archives`` writes one archive per task (each record a gzip member of
its own) and returns the index: file, offset, length, URL, digest and type of
every record. ``read_records`` takes any selection of index rows, sorts them by
place, joins neighbouring byte ranges into one read, and parses the records.

Of records with equal payloads (of ``min_revisit`` bytes at least) the one with
the largest page_id is a response and the others are revisits that refer to
it. Null html is an empty payload, a null URL an empty one. Rows that share the largest id
of their group are all responses. A null id counts as smaller than any other;
if a group has only null ids, all of them are responses.

Archives go to the shared folder; a file's name holds a random part, so a task
that runs twice leaves an orphan, never a damaged archive, and the index
(written by Spark's commit protocol) only names files of tasks that ended well.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import materialize, new_run_folder, read, ship

#: One read covers neighbouring records up to this many bytes, over gaps of up to GAP bytes.
READ_BYTES = 8 << 20
GAP = 64 << 10
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "page_id bigint, file string, offset bigint, length bigint, url string, digest string, record_type string"
RECORD_SCHEMA = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(null|-?\d+)>", uri)
    return None if not found or found[1] == "null" else int(found[1])


def make_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP header only, with the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """Fields of one record, its payload's digest and length taken from what was read."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = field["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != stated or digest32(payload) != digest):
        raise ValueError(f"damaged record {field['WARC-Record-ID']}")
    return {
        "page_id": page_of(field["WARC-Record-ID"]), "url": field["WARC-Target-URI"], "record_type": field["WARC-Type"],
        "refers_to": page_of(field["WARC-Refers-To"]) if revisit else None, "payload_bytes": stated, "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is the response's id for a revisit, else null.

    Groups of equal payloads are counted by digest before anything is shuffled;
    the join back has one row per digest on its other side, so a hot digest can be split.
    """
    own = pages.select(
        pages[id_col].cast("bigint").alias("page_id"), F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"),
    ).withColumn("key", F.sha1(F.col("html").cast("binary")))
    groups = own.where(F.octet_length("html") >= min_revisit).groupBy("key").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    repeated = groups.where("n > 1 AND keeper IS NOT NULL").select("key", "keeper")
    marked = own.join(repeated, "key", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")), F.col("keeper"))
    return marked.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``mark_revisits`` as archives under ``folder``; the index, one row per record."""
    ship(marked.sparkSession)
    base = f"{folder}/archives"

    def run(batches: Iterator[pa.RecordBatch]):
        fs, path = pafs.FileSystem.from_uri(base)
        out, name, at = None, f"{path}/{uuid.uuid4().hex}.warc.gz", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                    page_id, url, payload, refers = page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), refers.as_py()
                    digest = digest32(payload)
                    member = make_record(page_id, url, payload, digest, refers, refers is not None)
                    if out is None:
                        fs.create_dir(path, recursive=True)
                        out = fs.open_output_stream(name, compression=None)
                    out.write(member)
                    rows.append((page_id, name, at, len(member), url, digest, "revisit" if refers is not None else "response"))
                    at += len(member)
                if rows:
                    fields = ("page_id", "file", "offset", "length", "url", "digest", "record_type")
                    columns = dict(zip(fields, map(list, zip(*rows))))
                    columns["page_id"] = pa.array(columns["page_id"], pa.int64())
                    yield pa.RecordBatch.from_pydict(columns)
        finally:
            if out is not None:
                out.close()

    return materialize(marked.mapInArrow(run, INDEX_SCHEMA), folder, "index")


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Join places (file, offset, length), sorted, into reads: file, begin, end, and the places inside."""
    file, begin, end, inside = "", 0, 0, []
    for f, offset, length in rows:
        if inside and f == file and offset - end <= GAP and offset + length - begin <= READ_BYTES:
            end = max(end, offset + length)
            inside.append((offset, length))
            continue
        if inside:
            yield file, begin, end, inside
        file, begin, end, inside = f, offset, offset + length, [(offset, length)]
    if inside:
        yield file, begin, end, inside


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name, from the archives under ``folder``.

    Rows are dealt by place (file and offset), so a long archive is read by several tasks.
    """
    ship(index.sparkSession)
    base = f"{folder}/archives"

    def run(batches: Iterator[pa.RecordBatch]):
        fs, _ = pafs.FileSystem.from_uri(base)
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for file, begin, end, inside in ranges(places):
                with fs.open_input_file(file) as f:
                    f.seek(begin)
                    data = f.read(end - begin)
                rows = [parse_record(data[o - begin : o - begin + n]) for o, n in inside]
                columns = {k: [r[k] for r in rows] for k in rows[0]}
                if not with_payload:
                    columns["payload"] = [None] * len(rows)
                types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
                yield pa.RecordBatch.from_pydict({k: pa.array(v, types.get(k, pa.string())) for k, v in columns.items()})

    placed = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, RECORD_SCHEMA)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    folder = new_run_folder(spark)
    index = write_archives(mark_revisits(read(spark, sf_dir, "pages")), folder)
    records = read_records(index, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
