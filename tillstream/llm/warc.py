"""WARC archives with revisit records, and a reader that trusts only the chain of records.

Archives are gzip files with one member a record, or plain.  Tasks read byte ranges on
their own: wherever the magic of a record stands and a record can be parsed, they report
where it begins and where its successor must begin.  Magic inside payloads is reported,
too; pointer jumping from the start of each file keeps what can be reached, and that is
the records that were written.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.store import filesystem, ship_code, shuffle_parts, work_area, written

LEAST = 1000  # payloads of fewer bytes are never revisits
HEAD = 1 << 20  # a record's fields are shorter
VERSION = b"WARC/1.1"
GZIP = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
RECORDS = (
    "path string, position long, next long, page_id long, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long"
)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One record: a response, or a revisit of the page refers_to without payload."""
    again = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if again else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if again:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("Refers-To-Page-Id", str(refers_to))]
    block = HTTP if again else HTTP + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int] | None:
    """Fields, block and end of the record that begins at `at`, or None if none stands there.

    Only the record's own bytes are copied, whatever follows it in data.
    """
    if not data.startswith(VERSION + b"\r\n", at):
        return None
    end = data.find(b"\r\n\r\n", at, at + HEAD)
    if end < 0:
        return None
    try:
        lines = data[at + len(VERSION) + 2 : end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
    except (ValueError, KeyError):
        return None
    stop = end + 4 + size
    if size < 0 or data[stop : stop + 4] != b"\r\n\r\n":
        return None
    return fields, data[end + 4 : stop], stop + 4


def _row(path: str, position: int, following: int, fields: dict[str, str], block: bytes) -> dict | None:
    again = fields.get("WARC-Type") == "revisit"
    payload = block[block.find(b"\r\n\r\n") + 4 :]
    try:
        page = fields.get("Page-Id")
        said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(fields["Payload-Length"]) if again else len(payload)
        refers = int(fields["Refers-To-Page-Id"]) if again else None
        page = None if page is None else int(page)
    except (KeyError, ValueError):
        return None
    if not again and hashlib.sha1(payload).hexdigest() != said:
        return None
    return {
        "path": path, "position": position, "next": following, "page_id": page, "payload_bytes": size,
        "payload_digest": said, "record_type": "revisit" if again else "response", "refers_to": refers,
    }


class _Window:
    """Bytes of a file, read on demand from a position on."""

    def __init__(self, file, size: int, begin: int, ahead: int):
        self.file, self.size, self.begin = file, size, begin
        self.data = file.read_at(min(ahead, size - begin), begin)

    def more(self) -> bool:
        got = self.begin + len(self.data)
        if got >= self.size:
            return False
        self.data += self.file.read_at(min(max(1 << 20, len(self.data)), self.size - got), got)
        return True


def candidates(path: str, size: int, begin: int, end: int) -> Iterator[dict]:
    """Parsed records that begin in [begin, end) of a file, wherever the magic stands."""
    store, inside = filesystem(path)
    zipped = path.endswith(".gz")
    magic = GZIP if zipped else VERSION + b"\r\n"
    with store.open_input_file(inside) as file:
        window = _Window(file, size, begin, end - begin + (1 << 16))
        at = window.data.find(magic)
        while 0 <= at < end - begin:
            found = None
            if zipped:
                unpack, parts, used = zlib.decompressobj(31), [], at
                try:
                    while not unpack.eof:
                        piece = window.data[used : used + (1 << 16)]
                        if not piece and not window.more():
                            break
                        parts.append(unpack.decompress(piece))
                        if len(parts) == 1 and not (VERSION.startswith(parts[0][:8]) or parts[0].startswith(VERSION)):
                            break
                        used += len(piece)
                    if unpack.eof:
                        whole = b"".join(parts)
                        found = parse(whole)
                        if found and found[2] == len(whole):
                            found = (found[0], found[1], used - len(unpack.unused_data) - at)
                        else:
                            found = None
                except zlib.error:
                    found = None
            else:
                found = parse(window.data, at)
                while found is None and _short(window.data, at) and window.more():
                    found = parse(window.data, at)
                if found:
                    found = (found[0], found[1], found[2] - at)
            if found:
                row = _row(path, begin + at, begin + at + found[2], found[0], found[1])
                if row:
                    yield row
            at = window.data.find(magic, at + 1)


def _short(data: bytes, at: int) -> bool:
    """Whether a record may stand at `at` that data does not hold to its end."""
    end = data.find(b"\r\n\r\n", at, at + HEAD)
    if end < 0:
        return len(data) - at < HEAD
    for line in data[at:end].split(b"\r\n"):
        if line.startswith(b"Content-Length: ") and line[16:].isdigit():
            return len(data) < end + 8 + int(line[16:])
    return False


def write_archives(
    pages: DataFrame, *, zipped: bool = True, plain: Column | None = None, file_bytes: int = 8 << 20
) -> DataFrame:
    """Write pages (page_id, url, html) and return the manifest: path, size, n_records.

    Records go to gzip archives, or to plain ones if not zipped, or for pages for which the
    condition `plain` over page_id is true.  Other columns are ignored; an empty table
    gives an empty manifest.

    Of pages with equal html of at least LEAST bytes, that with the largest page_id is a
    response and the others are revisits of it; smaller ones are all responses.  A null
    html is empty; rows that repeat the largest page_id are responses, too; where all ids
    are null, all are responses.  A null url or page_id leaves its field out.
    """
    ship_code(pages.sparkSession)
    folder = work_area(pages.sparkSession, "warc")
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    told = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.sha1(html).alias("digest"))
    shared = (
        told.where(F.octet_length("html") >= LEAST).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "keeper")
    )
    refers = F.when((F.col("page_id") != F.col("keeper")) | (F.col("page_id").isNull() & F.col("keeper").isNotNull()), F.col("keeper"))
    bare = F.lit(not zipped) if plain is None else F.coalesce(plain, F.lit(False))
    rows = told.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", refers.alias("refers_to"), bare.alias("bare")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[bool, list] = {}  # by kind: out, path, size, records

        def closed(bare: bool) -> pa.RecordBatch:
            out, path, size, n = open_.pop(bare)
            out.close()
            return pa.record_batch({"path": [path], "size": pa.array([size], pa.int64()), "n_records": pa.array([n], pa.int64())})

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to", "digest", "bare")]
            for page, url, body, refers, digest, bare in zip(*columns, strict=True):
                data = record(page, url, body, refers, digest)
                if not bare:
                    tool = zlib.compressobj(4, zlib.DEFLATED, 31)
                    data = tool.compress(data) + tool.flush()
                if bare not in open_:
                    path = f"{folder}/{uuid.uuid4().hex}.warc{'' if bare else '.gz'}"
                    store, inside = filesystem(path)
                    store.create_dir(inside.rpartition("/")[0], recursive=True)
                    open_[bare] = [store.open_output_stream(inside, compression=None), path, 0, 0]
                held = open_[bare]
                held[0].write(data)
                held[2:] = [held[2] + len(data), held[3] + 1]
                if held[2] >= file_bytes:
                    yield closed(bare)
        for bare in list(open_):
            yield closed(bare)

    return written(rows.mapInArrow(write, "path string, size long, n_records long"), "archives")


def read_archives(manifest: DataFrame, *, split_bytes: int = 4 << 20, count_rejected: bool = False) -> DataFrame:
    """Records of the files of a manifest (path, size), as RECORDS without position and next.

    A file whose chain of records does not end where the file ends is refused.  With
    count_rejected, n_rejected says how many candidates stand inside a record's payload:
    whole records by their looks, which the chain does not reach.
    """
    spark = manifest.sparkSession
    ship_code(spark)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    splits = manifest.where("size > 0").select("path", "size", F.explode(starts).alias("begin"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("path", pa.string()), ("position", pa.int64()), ("next", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ])
        for batch in batches:
            for s in batch.to_pylist():
                rows = list(candidates(s["path"], s["size"], s["begin"], min(s["size"], s["begin"] + split_bytes)))
                yield pa.RecordBatch.from_pylist(rows, kind)

    found = written(splits.repartition(shuffle_parts(spark)).mapInArrow(scan, RECORDS), "candidates")
    reached = reachable(found.select("path", "position", "next"), manifest.select("path"))
    kept = found.join(reached.hint("merge"), ["path", "position"], "left_semi")
    ends = kept.join(manifest, "path").where(F.col("next") == F.col("size")).select("path").distinct()
    broken = manifest.where("size > 0").join(ends, "path", "left_anti").count()
    if broken:
        raise ValueError(f"{broken} archives have a chain of records that does not reach their end")
    if count_rejected:
        inside = found.join(reached.hint("merge"), ["path", "position"], "left_anti").select("path", "position")
        # A file's records; a candidate belongs to the last record that begins before it.
        marks = kept.select("path", "position", F.col("position").alias("record")).unionByName(inside, allowMissingColumns=True)
        order = Window.partitionBy("path").orderBy("position")
        owned = marks.withColumn("owner", F.last("record", ignorenulls=True).over(order)).where("record is null")
        many = owned.groupBy("path", F.col("owner").alias("position")).agg(F.count(F.lit(1)).alias("n_rejected"))
        kept = kept.join(many, ["path", "position"], "left").fillna(0, ["n_rejected"])
    return kept.drop("path", "position", "next")


def reachable(pointers: DataFrame, files: DataFrame) -> DataFrame:
    """(path, position) that the chain of pointers (path, position, next) reaches from position 0.

    Each round doubles how far pointers go, so a file of n records takes log2(n) rounds.
    A join key is one position of one file and has one row.  The joins are asked to shuffle:
    files of pointers are far smaller than their rows, so their size is no guide to what a
    broadcast would hold.
    """
    pointers = pointers.dropDuplicates(["path", "position"])
    known = pointers.select("path", "position").hint("merge")
    reached = files.distinct().select("path", F.lit(0).cast("long").alias("position"))
    reached = reached.join(known, ["path", "position"], "left_semi")
    jump, before = pointers, -1
    while True:
        reached = written(reached, "reached")
        now = reached.count()
        if now == before:
            return reached
        before = now
        step = reached.join(jump.hint("merge"), ["path", "position"]).select("path", F.col("next").alias("position"))
        step = step.join(known, ["path", "position"], "left_semi")
        further = jump.alias("a").join(
            jump.alias("b").hint("merge"), (F.col("a.path") == F.col("b.path")) & (F.col("a.next") == F.col("b.position"))
        )
        jump = written(further.select("a.path", "a.position", "b.next"), "jumps")
        reached = reached.unionByName(step).distinct()
