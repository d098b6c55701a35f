"""WARC archives written with an index, and read back through it.

Writing: each task appends records (one gzip member each) to an archive of its own in shared
storage and returns an index row per record: file, offset, length, URL, digest. The index is
committed by Spark as a table, so an archive of a task that was lost or repeated is simply
not named in it. A payload of ``LEAST`` bytes or more is stored once, by the record with the
smallest id; the other records with it are revisits that name that one.

Reading: the index comes first. The selected records, sorted by file and offset, are read in
byte ranges: neighbours no more than ``GAP`` bytes apart share one read of up to ``RANGE``
bytes. Payload digests are computed anew from what is read.

Defined cases: null html is the empty payload; payloads under ``LEAST`` bytes are always
responses; rows that share both the smallest id and the payload are all responses; a null id
never is the smallest unless all are null; a null URL is the empty one; control characters
in a URL are percent-encoded; an empty table gives an empty index; extra columns are
ignored."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bloom import bloom_filter, marked
from ..session import scratch_path
from .util import materialise

LEAST = 100
GAP = 1 << 16
RANGE = 8 << 20
ROLL = 512 << 20
TASK_BYTES = 16 << 20  # compressed records that a reading task takes
DATE = "2024-01-01T00:00:00Z"
INDEX = "file string, offset long, length long, id string, url string, digest string, type string"
RECORD = ("id string, url string, type string, refers string, payload_bytes long, "
          "payload_digest string, payload binary")


def record_bytes(rid: str, url: str, kind: str, refers: str | None, digest: str, payload: bytes,
                 payload_length: int, date: str = DATE) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head but not the payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_length}\r\n\r\n").encode()
    block = head + payload
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{rid}>",
              f"WARC-Target-URI: {url}", f"WARC-Date: {date}",
              f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        fields += [f"WARC-Refers-To: <urn:page:{refers}>",
                   "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(fields) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the payload of a revisit is None."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    name = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None
    revisit = fields["WARC-Type"] == "revisit"
    return {"id": name(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
            "type": fields["WARC-Type"],
            "refers": name(fields["WARC-Refers-To"]) if revisit else None,
            "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:")
            if revisit else hashlib.sha256(payload).hexdigest(),
            "payload": None if revisit else payload}


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = None
        try:
            for b in batches:
                rows: list[tuple] = []
                for rid, url, html, digest, size, kind, refers in zip(
                        *(b.column(c).to_pylist() for c in
                          ("id", "url", "html", "digest", "bytes", "type", "refers"))):
                    if out is None or out.tell() >= ROLL:
                        if out is not None:
                            out.close()
                        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        fs, path = pafs.FileSystem.from_uri(name)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(path, compression=None)
                    url = _safe_url(url or "")
                    body = b"" if kind == "revisit" else (html or "").encode()
                    data = _member(record_bytes(rid or "", url, kind, refers, digest, body, size))
                    rows.append((name, out.tell(), len(data), rid, url, digest, kind))
                    out.write(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4))],
                    names=["file", "offset", "length", "id", "url", "digest", "type"])
        finally:
            if out is not None:
                out.close()
    return run


def _uri(path: str) -> str:
    return path if re.match(r"\w+:", path) else f"file://{path}"


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least: int = LEAST, folder: str | None = None) -> DataFrame:
    """Write every row as a record; returns the committed index."""
    folder = _uri(folder or scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}"))
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("pid"), F.col(url).cast("string").alias("url"),
                        body.alias("html"), F.sha2(body.cast("binary"), 256).alias("digest"),
                        F.octet_length(body).cast("long").alias("bytes"))
    first = (rows.where(F.col("bytes") >= least).groupBy("digest")
             .agg(F.min("pid").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("digest").alias("known"), "first"))
    first = materialise(first, "warc-repeated")
    words, bits = bloom_filter(first, "known")
    told = marked(rows, "digest", words, bits)  # only what may be repeated is shuffled
    joined = told.where("_maybe").join(first, F.col("digest") == F.col("known"), "left").unionByName(
        told.where("not _maybe"), allowMissingColumns=True)
    revisit = F.col("first").isNotNull() & ~F.col("pid").eqNullSafe(F.col("first"))
    typed = joined.select(F.col("pid").cast("string").alias("id"), "url",
                          F.when(~revisit, F.col("html")).alias("html"), "digest", "bytes",
                          F.when(revisit, "revisit").otherwise("response").alias("type"),
                          F.when(revisit, F.col("first").cast("string")).alias("refers"))
    return materialise(typed.mapInArrow(_write(folder), INDEX), "warc-index")


def _ranges(rows: list[tuple], gap: int, most: int) -> Iterator[list[tuple]]:
    """Sorted (file, offset, length) rows, cut into runs that one read can cover."""
    run: list[tuple] = []
    for r in rows:
        if run and (r[0] != run[0][0] or r[1] - (run[-1][1] + run[-1][2]) > gap
                    or r[1] + r[2] - run[0][1] > most):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def _read(gap: int, most: int, payloads: bool):
    names = [x.split(" ")[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for group in _ranges(rows, gap, most):
                if group[0][0] != name:
                    if source is not None:
                        source.close()
                    name = group[0][0]
                    fs, path = pafs.FileSystem.from_uri(name)
                    source = fs.open_input_file(path)
                start = group[0][1]
                data = source.read_at(max(o + n for _, o, n in group) - start, start)
                got = [parse_record(zlib.decompress(data[o - start:o - start + n], 31))
                       for _, o, n in group]
                if not payloads:
                    for g in got:
                        g["payload"] = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[c] for g in got], t) for c, t in zip(names, kinds)], names=names)
        if source is not None:
            source.close()
    return run


def read_records(index: DataFrame, payloads: bool = True, gap: int = GAP, most: int = RANGE
                 ) -> DataFrame:
    """The records that the index rows name: id, url, type, refers, payload_bytes,
    payload_digest and, if wanted, the payload (null for revisits)."""
    # as many tasks as the payloads ask for, not as the index rows do
    total = index.agg(F.sum("length")).first()[0] or 0
    ordered = (index.select("file", "offset", "length")
               .repartitionByRange(max(1, -(-total // TASK_BYTES)), "file", "offset")
               .sortWithinPartitions("file", "offset"))
    return ordered.mapInArrow(_read(gap, most, payloads), RECORD)
