"""WARC archives of pages: written as records with payload deduplication, read by boundary chains.

Writing: one record a page. Of pages with equal payloads of at least
``min_bytes`` bytes, the one with the smallest id is a ``response``; the others
are ``revisit`` records that refer to it and hold no payload. Archives are
files of concatenated records, at most ``records_per_file`` in each.

Reading: the magic ``WARC/1.`` may stand inside a payload, so a match is only a
candidate. Tasks scan archives and emit every candidate with the offset where
its record would end, which is where its successor must begin. Pointer jumping
over these offsets (each pass doubles the distance) starts at offset 0 of every
file and marks the records that its chain reaches; all other candidates are
bytes of some payload. A file of n records takes about log2(n) passes, whatever
the number of files.

Defined results: a null payload is empty; a null url gives a record without
target; pages that repeat the smallest id and payload are all responses; a null
id is written as ``null``; if all ids of a payload are null, all are responses;
a truncated or damaged archive is an error, or gives the records before the
damage if the caller asks for that; headers may have any length; no pages give an archive without records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arspark.llm.common import Scratch, released, rows_with_ids

# Fixed values of the format.
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LENGTH = re.compile(r"[0-9]{1,18}")
#: Fields that are read.
FIELDS = {b"content-length", b"content-type", b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-target-uri"}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page: str, first: str | None, url: str | None, html: bytes) -> bytes:
    revisit = first is not None and page != first
    block = HTTP if revisit else HTTP + html
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{base32_sha1(html)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r"  # the writer ends the row with the last line feed


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, first, url, html in zip(*(batch.column(c).to_pylist() for c in ("page", "first", "url", "html"))):
            out.append(_record(page, first, url, html.encode()).decode())
            if len(out) == 256:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, records_per_file: int = 4096) -> None:
    """Write one record for each row of ``pages`` to archive files under ``path``."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    keyed = rows.withColumn("same", F.when(F.octet_length("html") >= min_bytes, F.sha2(F.col("html"), 256)))
    firsts = keyed.filter("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # only payloads that may have copies are shuffled
    copies = rows_with_ids(keyed, firsts, "same").join(firsts, "same", "left").select(*keyed.columns, "first")
    flagged = copies.union(rows_with_ids(keyed, firsts, "same", others=True).withColumn("first", F.lit(None).cast(firsts.schema["first"].dataType)))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    out = flagged.select(text("id").alias("page"), F.col("first").cast("string").alias("first"), "url", "html")
    out.mapInArrow(released(_records), "value string").write.option("maxRecordsPerFile", records_per_file).option("lineSep", "\n").text(path)


def _headers(data: bytes) -> Iterator[tuple[int, dict[str, str], int]]:
    """Offset and fields of every record header, and the position after it."""
    group, end = [], -1
    for m in MAGIC.finditer(data):
        if m.start() > end:
            yield from _fields(data, group, end)
            group, end = [], data.find(b"\r\n\r\n", m.start())
            if end < 0:
                return
        group.append(m.start())
    yield from _fields(data, group, end)


def _fields(data: bytes, group: list[int], end: int) -> list[tuple[int, dict[str, str], int]]:
    """The headers at the offsets ``group``, which all end at ``end``. From the last one on, so that lines they share are read once."""
    found, fields, stop = [], {}, end
    for at in reversed(group):
        own = {}
        for line in data[at + 10:stop].split(b"\r\n") if at + 10 < stop else ():
            name, colon, value = line.partition(b":")
            if not colon:
                return found[::-1]
            name = name.strip().lower()
            if name in FIELDS:
                own[name.decode()] = value.strip().decode("utf-8", "replace")
        fields, stop = own | fields, at + 8
        found.append((at, fields, end + 4))
    return found[::-1]


def _candidates(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch.column("path")[k].as_py(), batch.column("content")[k].as_py() or b""
                rows = []
                for at, fields, body in _headers(data):
                    if not LENGTH.fullmatch(fields.get("content-length", "")):
                        continue
                    end = body + int(fields["content-length"])
                    if data[end:end + 4] != b"\r\n\r\n":
                        continue
                    block = data[body:end]
                    if fields.get("content-type", "").startswith("application/http"):
                        block = block.partition(b"\r\n\r\n")[2]
                    rows.append({"file": name, "off": at, "next": end + 4, "type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                                 "refers_to": fields.get("warc-refers-to"), "uri": fields.get("warc-target-uri"), "payload_bytes": len(block),
                                 "payload_digest": base32_sha1(block)} | ({"payload": block} if with_payload else {}))
                rows.append({"file": name, "off": len(data)})  # where the last record's successor would begin
                yield pa.RecordBatch.from_pylist(rows, SCHEMA_PAYLOAD if with_payload else SCHEMA)
    return run


SCHEMA = pa.schema([("file", pa.string()), ("off", pa.int64()), ("next", pa.int64()), ("type", pa.string()), ("record_id", pa.string()),
                    ("refers_to", pa.string()), ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
SCHEMA_PAYLOAD = SCHEMA.append(pa.field("payload", pa.binary()))
DDL = "file string, off long, next long, type string, record_id string, refers_to string, uri string, payload_bytes long, payload_digest string"


def reachable(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, off) of the candidates on the chain from each file's offset 0.

    ``candidates``: columns file, off, next; one row for each offset.
    """
    state = scratch.save(candidates.select("file", "off", F.col("next").alias("ptr"), (F.col("off") == 0).alias("on")))
    while True:
        hit = state.filter("on AND ptr IS NOT NULL").select("file", F.col("ptr").alias("off"), F.lit(True).alias("hit"))
        marked = state.join(hit.distinct(), ["file", "off"], "left").select("file", "off", "ptr", (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on"))
        ahead = state.select("file", F.col("off").alias("ptr"), F.col("ptr").alias("far"))
        after = scratch.save(marked.join(ahead, ["file", "ptr"], "left").select("file", "off", F.col("far").alias("ptr"), "on"))
        scratch.drop(state)
        state = after
        if state.filter("on AND ptr IS NOT NULL").isEmpty():
            return state.filter("on").select("file", "off")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, damaged: bool = False) -> DataFrame:
    """Records of the archives under ``path``: file, off, next, type, record_id, refers_to, uri, payload_bytes, payload_digest (and payload).

    ``payload_bytes`` and ``payload_digest`` are of what the record holds: empty for a revisit.
    A file whose chain of records stops before its end is an error, unless ``damaged`` files are allowed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*[!_SUCCESS]").load(path).select("path", "content")
    ddl = DDL + (", payload binary" if with_payload else "")
    with Scratch(spark, "warc-read") as scratch:
        candidates = scratch.save(files.mapInArrow(released(_candidates(with_payload)), ddl), keep=True)
        on = scratch.save(reachable(candidates, scratch), keep=True)
    if not damaged:
        broken = candidates.filter("next IS NULL").join(on, ["file", "off"], "left_anti").select("file").limit(3).collect()
        if broken:
            raise ValueError("records end before their file does: " + ", ".join(r["file"] for r in broken))
    return candidates.filter("next IS NOT NULL").join(on, ["file", "off"])


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``full_bytes`` and ``full_digest`` of the payload they stand for: a revisit has those of the response it refers to."""
    own = records.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"),
                                                     F.col("payload_digest").alias("full_digest")).dropDuplicates(["refers_to"])
    revisits = records.filter("refers_to IS NOT NULL").join(own, "refers_to", "left").select(*records.columns, "full_bytes", "full_digest")
    rest = records.filter("refers_to IS NULL").select("*", F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"))
    return rest.union(revisits).withColumn("full_bytes", F.coalesce("full_bytes", "payload_bytes")).withColumn("full_digest", F.coalesce("full_digest", "payload_digest"))
