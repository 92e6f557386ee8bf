"""WARC archives with an index: write, then read back by sorted, coalesced byte ranges.

Writing: each task appends one gzip member per record to an archive file of its own
under the shared folder and returns an index row per record (file, offset, length, URL,
digest, type).  File names are unique per attempt and only a finished task's index rows
are committed, so a retried task leaves an unreferenced file and nothing else.

Reading: the selected index rows are dealt by file stretch, sorted by offset, and
neighbouring ranges become one read.  Each record's payload is checked against its digest.

Payloads that recur (at least `min_revisit` bytes, equal digest and length) are stored once:
the record with the smallest page_id is the response, the others are revisit records that
carry the HTTP header block only.

Defined results: a null html is an empty payload; rows that repeat a response's page_id
and payload are responses too; a row without page_id revisits the first one with an id, and is
a response when no copy has an id; a null URL stays null.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbar.session import scratch_path

from .common import binaries, lean

MIN_REVISIT = 100
ROLL_BYTES = 64 << 20   # an archive file is closed beyond this size
GAP_BYTES = 64 << 10    # ranges closer than this are read as one
READ_BYTES = 8 << 20    # a coalesced read stays below this, unless one record is larger
TASK_BYTES = 16 << 20   # archive bytes per reading task (index rows are too small to size tasks by)
_DATE = "2024-01-01T00:00:00Z"
_INDEX = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "file string, offset long, length long")
_RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
           "payload_bytes long, payload binary")


def classify(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, size, refers_to (null: a response) of every page."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    firsts = (rows.where(F.col("size") >= min_revisit).groupBy(F.col("digest").alias("own"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(firsts, F.col("digest") == F.col("own"), "left")
    return joined.select("page_id", "url", "payload", "digest", "size",
                         F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _uri(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _clean(url: str) -> str:
    """Header-safe form of a URL: control characters, spaces and % followed by them are escaped."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
            f"WARC-Record-ID: {_uri(page_id, digest)}", f"WARC-Date: {_DATE}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def parse_record(member: bytes) -> dict:
    """The fields of one gzip member; fails if the payload doesn't match its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {fields['warc-record-id']} doesn't match its digest")
    number = lambda key: int(fields[key]) if key in fields else None
    return {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": number("x-refers-to-page-id"), "payload_digest": digest, "payload_bytes": size,
            "payload": payload if kind == "response" else None}


def _writer(root: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                cols = {c: batch.column(i).to_pylist() for i, c in enumerate(batch.schema.names) if c != "payload"}
                rows: dict[str, list] = {f.split()[0]: [] for f in _INDEX.split(", ")}
                for i, payload in enumerate(binaries(batch, "payload")):
                    if out is None:
                        store.create_dir(base, recursive=True)
                        name, at = f"records-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    page, url, ref, digest = (cols[c][i] for c in ("page_id", "url", "refers_to", "digest"))
                    member = build_record(page, url, payload, digest, ref)
                    out.write(member)
                    for key, v in (("page_id", page), ("url", url), ("refers_to", ref), ("payload_digest", digest),
                                   ("record_type", "response" if ref is None else "revisit"), ("file", name),
                                   ("offset", at), ("length", len(member))):
                        rows[key].append(v)
                    at += len(member)
                    if at >= roll:
                        out.close()
                        out = None
                types = {"long": pa.int64(), "string": pa.string()}
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v, types[f.split()[1]]) for f, (k, v) in zip(_INDEX.split(", "), rows.items())})
        finally:
            if out is not None:
                out.close()
    return lean(run)


def write_archives(pages: DataFrame, root: str, min_revisit: int = MIN_REVISIT, roll: int = ROLL_BYTES) -> DataFrame:
    """Write one record per page under `root`/archive and the index as Parquet under `root`/index; the index."""
    spark = pages.sparkSession
    index = classify(pages, min_revisit).mapInArrow(_writer(f"{root}/archive", roll), _INDEX)
    index.write.parquet(f"{root}/index")
    return read_index(spark, root)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{root}/index")


def _reader(root: str, gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        held: list[tuple[str, int, int]] = []
        opened: list = [None, None]

        def fetch() -> pa.RecordBatch:
            name, first = held[0][0], held[0][1]
            if opened[0] != name:
                if opened[1] is not None:
                    opened[1].close()
                opened[:] = name, store.open_input_file(f"{base}/{name}")
            end = max(o + n for _, o, n in held)
            data = opened[1].read_at(end - first, first)
            found = [parse_record(data[o - first:o - first + n]) for _, o, n in held]
            held.clear()
            types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in found], types[t])
                                               for k, t in (f.split() for f in _RECORD.split(", "))})

        try:
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if held and (row[0] != held[0][0] or row[1] - (held[-1][1] + held[-1][2]) > gap
                                 or row[1] + row[2] - held[0][1] > most):
                        yield fetch()
                    held.append(row)
            if held:
                yield fetch()
        finally:
            if opened[1] is not None:
                opened[1].close()
    return lean(run)


def read_records(selected: DataFrame, root: str, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records of the selected index rows (payload null for revisits)."""
    stretch = F.floor(F.col("offset") / most)
    total = selected.agg(F.sum("length")).first()[0] or 0
    rows = (selected.select("file", "offset", "length").repartition(max(1, -(-total // TASK_BYTES)), "file", stretch)
            .sortWithinPartitions("file", "offset"))
    return rows.mapInArrow(_reader(f"{root}/archive", gap, most), _RECORD)


def archive_root(spark: SparkSession) -> str:
    """A new folder for archives under the shared checkpoint location."""
    return scratch_path(spark, "warc")
