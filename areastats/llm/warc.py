"""WARC archives with the index first.

Every record is a gzip member of its own. Writing yields the index: file, offset, length, URL and digest per record. Reading
selects index rows, sorts them by file and offset, joins neighbouring ranges into one read, and cuts the records out of it.
A payload that occurs again is not stored again: its further records are revisits that refer to one response.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise
from areastats.llm.files import new_folder, own_name, place

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")
INDEX = "file string, offset long, length long, url string, digest string, page_id long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def named(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record. Control characters of a URL are percent-encoded; a revisit has headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {named(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {named(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(member: bytes) -> tuple:
    """The fields of READ from one record; the digest of a stored payload is computed and must agree."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    own, other = (re.sub(r"^<urn:page:|>$", "", fields.get(k, "<urn:page:null>")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
    number = [None if x == "null" else int(x) for x in (own, other)]
    return number[0], size, digest, kind, number[1], fields.get("WARC-Target-URI")


def with_references(pages: DataFrame, least: int = 1_000) -> DataFrame:
    """page_id, url, payload, digest and refers_to: the largest page_id of an equal payload of `least` bytes or more.

    Digests are counted with partial aggregates; only those that occur again are joined back, and a digest with very
    many pages is the skewed side of that join.
    """
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    base = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    again = base.where(F.octet_length("payload") >= least).groupBy("digest")
    again = again.agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null")
    same = (F.col("digest") == F.col("again")) & (F.octet_length("payload") >= least)
    met = base.join(again.select(F.col("digest").alias("again"), "last"), same, "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return met.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, max_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write the archives of `pages` and return their written index. Files roll over at `max_bytes`."""
    folder = new_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out, name, at = 0, None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= max_bytes:
                    if out:
                        out.close()
                    name, number, at = own_name(folder, number, ".warc.gz"), number + 1, 0
                    fs, path = place(name)
                    out = fs.open_output_stream(path, compression=None)
                member = gzip.compress(record(page_id, url, payload, digest, refers_to, date), level, mtime=0)
                out.write(member)
                rows.append((name, at, len(member), url, digest, page_id))
                at += len(member)
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "offset", "length", "url", "digest", "page_id"])
        if out:
            out.close()

    return materialise(with_references(pages).mapInArrow(run, INDEX))


def ranges(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (file, offset, length) in groups that one read covers: same file, gaps of at most `gap`, `most` bytes in all."""
    group: list[tuple[str, int, int]] = []
    for r in rows:
        if group and (r[0] != group[-1][0] or r[1] - sum(group[-1][1:]) > gap or r[1] + r[2] - group[0][1] > most):
            yield group
            group = []
        group.append(r)
    if group:
        yield group


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """The records of the selected index rows. Index rows are dealt in file order, so a task reads neighbouring ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f = None, None
        for batch in batches:
            for group in ranges(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)), gap, most):
                if group[0][0] != opened:
                    if f:
                        f.close()
                    opened = group[0][0]
                    fs, path = place(opened)
                    f = fs.open_input_file(path)
                first = group[0][1]
                data = f.read_at(sum(group[-1][1:]) - first, first)
                rows = [parsed(zlib.decompress(data[a - first : a - first + n], 31)) for _, a, n in group]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if f:
            f.close()

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, READ)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives of `pages` and read every record back through the index.

    Null and empty html is an empty payload; null ids and URLs stay null, and a null id never is referred to; of repeated
    rows of one payload each row with the largest page_id is a response; no rows give no archive. Other columns are not
    looked at.
    """
    return read_records(write_archives(pages, **options))
