"""WARC archives compressed with a dictionary.

A dictionary is trained on a bounded sample of records. An archive begins with a skippable
Zstandard frame that holds the dictionary; after it every record is a frame of its own, compressed
with the dictionary, so that a reader needs nothing but the archive.

Tasks write archives under names of their own attempt and report them as rows; the table of those
rows, which Spark commits once, is the list of archives. Files that a lost or repeated attempt
leaves behind are in no list.
"""

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.text import parts, reachable, smallest_hashes
from orderloom.session import cut_lineage, work_folder

#: Payloads shorter than this are always stored.
REVISIT_BYTES = 1000
#: The dictionary's size, and how many records of how many bytes it is trained on.
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 800
SAMPLE_BYTES = 16 << 10
#: A task starts another archive after so many compressed bytes.
ARCHIVE_BYTES = 256 << 20

SKIPPABLE = 0x184D2A5D  # magic number of the frame with the dictionary, a fixed value
_HEAD = "<II"  # magic number and size of the frame that readers skip
_LEVEL = 6
_READ = 1 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
_DATE = "2000-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("0b7b1c3e-3f0e-4a53-9c62-6c1d3f7f5a10")


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, str(page_id))}>"


def build_record(kind, page_id, url, payload: bytes, size, digest, refers_to) -> bytes:
    """One WARC/1.1 record. A response holds an HTTP response with the payload; a revisit holds
    its head only. Page ids and the payload's size travel in headers of our own."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" \
           f"Content-Length: {size}\r\n\r\n".encode()
    if kind == "response":
        body += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", _DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type",
              "application/http; msgtype=response"), ("Content-Length", len(body)),
              ("X-Payload-Length", size)]
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                   ("X-Refers-To-Page-ID", refers_to)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict, bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines)}
    return fields, rest[:int(fields["content-length"])]


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    return block.partition(b"\r\n\r\n")[2]


def decide(pages: DataFrame, least=REVISIT_BYTES, key="page_id", payload="html") -> DataFrame:
    """`pages` as page_id, url, html with payload_bytes, payload_digest, and refers_to: of equal
    payloads of `least` bytes or more, all but that with the largest id refer to that one.

    Only digests that occur twice or more are joined back, from a written table, so that
    adaptive execution can broadcast a small one and split a digest that many pages share.
    Repeated rows with the largest id are all stored. A page without id never is referred to,
    and refers to the largest id there is.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col(payload).alias("html"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body).alias("payload_digest"))
    shared = cut_lineage(
        rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.max("page_id").alias("stored"), F.count("*").alias("copies"))
        .where("copies > 1 AND stored IS NOT NULL").drop("copies"), "warc-shared")
    return rows.join(shared, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(~F.col("stored").eqNullSafe(F.col("page_id")), F.col("stored"))
        .alias("refers_to"))


def train_dictionary(pages: DataFrame, records=SAMPLE_RECORDS, size=DICTIONARY_BYTES,
                     key="page_id", payload="html") -> bytes:
    """A dictionary from the records of the pages with the smallest hashes, of each at most
    `SAMPLE_BYTES` from a place that its hash decides; empty if they are too few or too small to
    train on."""
    body = F.coalesce(F.col(payload), F.lit(""))
    places = F.greatest(F.octet_length(body) - SAMPLE_BYTES, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(F.xxhash64(body)), places).cast("int") + 1
    hashed = pages.select(F.xxhash64(body).alias("hash"), F.col(key).alias("page_id"), "url",
                          F.substring(body.cast("binary"), place, F.lit(SAMPLE_BYTES))
                          .alias("body"))
    chosen = (smallest_hashes(hashed, records).groupBy("hash")
              .agg(F.min(F.struct("page_id", "url", "body")).alias("first"))
              .select("hash", "first.*").orderBy("hash").limit(records).collect())
    samples = [build_record("response", r.page_id, r.url, bytes(r.body), len(r.body),
                            hashlib.sha1(r.body).hexdigest(), None) for r in chosen]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _store(folder: str):
    """The file system of a folder's address, and the path in it."""
    if "://" not in folder:
        folder = re.sub(r"^file:/*", "/", folder)
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def write_archives(rows: DataFrame, folder: str, dictionary: bytes,
                   archive_bytes=ARCHIVE_BYTES) -> DataFrame:
    """Writes decided rows to archives in `folder`, which executors must share, and returns the
    written table of them: archive, records, bytes."""
    reachable(rows.sparkSession)

    def run(batches):
        compress = zstandard.ZstdCompressor(
            level=_LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        store, path = _store(folder)
        out = name = None
        done = []
        records = size = 0
        for batch in batches:
            for part in parts(batch, "html"):
                for row in part.to_pylist():
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(f"{path}/{name}")
                        out.write(struct.pack(_HEAD, SKIPPABLE, len(dictionary)) + dictionary)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    frame = compress.compress(build_record(
                        kind, row["page_id"], row["url"], (row["html"] or "").encode(),
                        row["payload_bytes"], row["payload_digest"], row["refers_to"]))
                    out.write(frame)
                    records, size = records + 1, size + len(frame)
                    if size >= archive_bytes:
                        out.close()
                        done.append((name, records, size))
                        out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], names=["archive", "records", "bytes"])

    return cut_lineage(rows.mapInArrow(run, "archive string, records long, bytes long"),
                       "warc-archives")


def read_frames(stream):
    """The records of an archive, one at a time."""
    head = stream.read(struct.calcsize(_HEAD))
    magic, size = struct.unpack(_HEAD, head)
    if magic != SKIPPABLE:
        raise ValueError("the archive has no dictionary frame")
    known = zstandard.ZstdCompressionDict(stream.read(size))
    decompressor = zstandard.ZstdDecompressor(dict_data=known)
    rest = b""
    while True:
        one, pieces = decompressor.decompressobj(), []
        while not one.eof:
            data = rest or stream.read(_READ)
            if not data:
                if pieces:
                    raise ValueError("the archive ends inside a record")
                return
            pieces.append(one.decompress(data))
            rest = one.unused_data if one.eof else b""
        yield b"".join(pieces)


def read_archives(archives: DataFrame, folder: str, with_payload=False) -> DataFrame:
    """One row per record of the listed archives: page_id, url, record_type, payload_bytes,
    payload_digest (of the stored payload where there is one), refers_to, and on demand payload
    (null for revisits). A task reads one archive at a time, record by record."""
    schema = ("page_id long, url string, record_type string, payload_bytes long, "
              "payload_digest string, refers_to long" + ", payload binary" * with_payload)
    spark = archives.sparkSession
    reachable(spark)
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.binary()][:6 + with_payload]
    names = [field.split()[0] for field in schema.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    def run(batches):
        for batch in batches:
            store, path = None, None
            for name in batch.column(0).to_pylist():
                store, path = _store(folder)
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}") as stream:
                    for record in read_frames(stream):
                        rows.append(_row(*parse_record(record))[:len(types)])
                        size += len(record)
                        if len(rows) == 1000 or with_payload and size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    count = archives.count()
    return archives.select("archive").repartition(max(1, count), "archive").mapInArrow(run, schema)


def _row(fields, block):
    page_id, refers_to = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"][5:]
    payload = None
    if fields["warc-type"] == "response":
        payload = payload_of(block)
        if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
    return (page_id and int(page_id), fields["warc-target-uri"], fields["warc-type"], size,
            digest, refers_to and int(refers_to), payload)


def archive_pages(pages: DataFrame, least=REVISIT_BYTES, folder: str | None = None):
    """Writes a record per row of `pages` (page_id, url, html; other columns are ignored) and
    returns the table of archives and their folder.

    A null html is an empty payload, a null url is about:blank. An empty table makes no archive.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or work_folder(spark, "warc")
    dictionary = train_dictionary(pages)
    return write_archives(decide(pages, least), folder, dictionary), folder
