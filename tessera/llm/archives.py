"""Web archives (operator 8): legacy ARC files to WARC files.

The converter reads ARC files of either record-line version: the version block
at their start names the fields of the record lines, and every record is read
by its declared length.  It synthesises what a WARC needs and an ARC lacks:
record identifiers (from url, date and payload digest), ISO timestamps, record
types and payload digests.  Of records with the same payload of at least
``REVISIT_BYTES`` bytes one stays a response (the largest page id); the others
become revisits that refer to it.  Payloads never move between machines: the
decisions, a few numbers per record, travel to the task that holds the file.

``write_arc`` makes the legacy archives from a pages table; ``read_warc`` gives
the records of WARC files.

Archives are streamed: a task holds one record, not the file.  Damage is stepped
over and counted: a record line that is none, a block that ends early, a gzip
member that does not unpack; reading goes on at the next record line or member.

Defined results: null html is an empty payload; a null url becomes
``urn:page:<id>``; null page ids stay null and lose against any other; of
repeated rows the later record stays the response; an empty table gives no
file and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.files import filesystem, write_file

REVISIT_BYTES = 1000
#: Raw bytes after which a task starts the next archive file.
FILE_BYTES = 16 << 20
#: Bytes of archives that a task converts, where there are enough files.
TASK_BYTES = 128 << 20
_CHUNK = 1 << 18
#: Capture time of pages that have none.
CAPTURE_DATE = "20240101000000"

# Fixed values of the two formats
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    """One record as a gzip member of its own."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _http(page_id, payload_size: int) -> bytes:
    named = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}"
            f"Content-Length: {payload_size}\r\n\r\n").encode()


def _url(url, page_id) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def arc_record(version: int, url: str, date: str, kind: str, block: bytes, offset: int = 0, name: str = "-") -> bytes:
    extra = {1: "", 2: f" 200 - - {offset} {name}"}[version]
    return f"{url} 0.0.0.0 {date} {kind}{extra} {len(block)}\n".encode() + block + b"\n"


def arc_version_block(version: int, name: str, date: str = CAPTURE_DATE) -> bytes:
    body = f"{version} 0 tessera\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", date, "text/plain", body)


def _write_arc_task(folder: str, version: int | None, date: str):
    def run(batches):
        part, number, size, parts, rows = TaskContext.get().partitionId(), 0, 0, [], 0
        kind = version or 1 + part % 2

        def flush():
            nonlocal number, size, parts, rows
            path = write_file(folder, f"pages-{part:08d}-{number:05d}.arc.gz", parts)
            done = pa.RecordBatch.from_pylist([{"path": path, "records": rows}])
            number, size, parts, rows = number + 1, 0, [], 0
            return done

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                if not parts:
                    parts.append(_member(arc_version_block(kind, f"pages-{part:08d}-{number:05d}.arc", date)))
                payload = (html or "").encode()
                record = arc_record(kind, _url(url, page_id), date, "text/html", _http(page_id, len(payload)) + payload, size)
                parts.append(_member(record))
                size, rows = size + len(record), rows + 1
                if size >= FILE_BYTES:
                    yield flush()
        if parts:
            yield flush()

    return run


def write_arc(pages: DataFrame, folder: str, version: int | None = None, date: str = CAPTURE_DATE) -> DataFrame:
    """Write pages (page_id, url, html) as ARC files; versions alternate by
    task unless one is given.  One row per file."""
    ship_package(pages.sparkSession)
    return land(pages.select("page_id", "url", "html").mapInArrow(
        _write_arc_task(folder, version, date), "path string, records bigint"), "arc-files")


class _Broken(Exception):
    """The data asked for are cut off by a damaged gzip member."""


class _Stream:
    """Decompressed bytes of a plain or gzip file.  Behind a damaged member it goes
    on at the next one; what would reach over the gap raises ``_Broken``."""

    def __init__(self, raw):
        self.raw, self.held, self.gap = raw, bytearray(), None
        self.pending, self.ended = raw.read(_CHUNK), False
        self.zipped = self.pending[:2] == b"\x1f\x8b"
        self.member = zlib.decompressobj(31) if self.zipped else None

    def _more(self) -> bool:
        """Take in another piece; False at the end of the file."""
        if self.gap is not None or self.ended:
            return False
        data, self.pending = self.pending or self.raw.read(_CHUNK), b""
        if not data:
            self.ended = True
            return False
        if not self.zipped:
            self.held += data
            return True
        try:
            self.held += self.member.decompress(data, _CHUNK)
            self.pending = self.member.unconsumed_tail or self.member.unused_data
            if self.member.eof:
                self.member = zlib.decompressobj(31)
                if self.pending[:1] != b"\x1f" and self.pending:
                    self._next_member(self.pending)
        except zlib.error:
            self._next_member(data[1:])
        return True

    def _next_member(self, data: bytes) -> None:
        """Look for the next member in ``data`` and behind it."""
        self.gap = len(self.held)
        self.member = zlib.decompressobj(31)
        while True:
            at = data.find(b"\x1f\x8b\x08")
            if at >= 0:
                self.pending = data[at:]
                return
            more = self.raw.read(_CHUNK)
            if not more:
                self.ended = True
                return
            data = data[-2:] + more

    def _take(self, n: int) -> bytes:
        if self.gap is not None and n >= len(self.held) and n > self.gap:
            n = self.gap
        out = bytes(self.held[:n])
        del self.held[:n]
        if self.gap is not None:
            self.gap -= n
        return out

    def _cross(self) -> None:
        """At a gap: drop what is in front of it and tell."""
        del self.held[: self.gap]
        self.gap = None
        raise _Broken

    def readline(self) -> bytes:
        at = 0
        while True:
            end = self.held.find(b"\n", at, None if self.gap is None else self.gap)
            if end >= 0:
                return self._take(end + 1)
            if self.gap is not None:
                self._cross()
            at = len(self.held)
            if not self._more() and self.gap is None:
                return self._take(len(self.held))

    def read(self, n: int) -> bytes:
        while len(self.held) < n or self.gap is not None and self.gap < n:
            if self.gap is not None:
                self._cross()
            if not self._more() and self.gap is None:
                break
        return self._take(min(n, len(self.held)))


def _record_line(text: str, fields: list[str], lost: bool) -> dict | None:
    """The fields of a record line, None if it is none.  Behind a damaged place
    the url must look like one."""
    values = text.rsplit(" ", len(fields) - 1)  # an old url may hold spaces
    found = dict(zip(fields, values))
    if (len(values) < len(fields) or not found["archive-length"].isdigit() or not found["archive-date"].isdigit()
            or lost and ":" not in found["url"]):
        return None
    return found


def read_arc(raw, damaged: list | None = None) -> Iterator[dict]:
    """Records of one ARC file (bytes or a stream, plain or gzip): the fields its
    version block names, lower-cased, and ``block``.  What is damaged is skipped
    and described in ``damaged``."""
    stream = _Stream(io.BytesIO(raw) if isinstance(raw, (bytes, bytearray)) else raw)
    damaged = [] if damaged is None else damaged
    fields: list[str] | None = None
    lost = False  # between a damaged place and the next record line

    def loss(what: str) -> None:
        nonlocal lost
        if not lost:
            damaged.append(what)
        lost = True

    while True:
        try:
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text.startswith("filedesc:") and text.rsplit(" ", 1)[1].isdigit():
                head = stream.read(int(text.rsplit(" ", 1)[1])).decode("utf-8", "replace").split("\n")
                named = head[1].lower().split() if len(head) > 1 else []
                if {"url", "archive-date", "archive-length"} <= set(named):
                    fields, lost = named, False
                else:
                    loss(f"unknown version block {head[0][:80]!r}")
                continue
            found = None
            for names in [fields] if fields else [ARC_FIELDS[v].lower().split() for v in (2, 1)]:
                found = _record_line(text, names, lost or fields is None)
                if found:
                    if fields is None:  # the version block is missing: this line tells the version
                        loss("no version block")
                        fields = names
                    break
            if found is None:
                loss(f"no record line: {text[:80]!r}")
                continue
            length = int(found["archive-length"])
            block = stream.read(length)
            if len(block) != length:
                loss(f"record ends early: {text[:80]!r}")
                return
            lost = False
            yield found | {"block": block}
        except _Broken:
            lost = False
            loss("damaged gzip member")


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload of a record's block."""
    at = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or at < 0:
        return b"", block
    return block[: at + 4], block[at + 4:]


def _header(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode()
    return None


def _page_id(head: bytes) -> int | None:
    value = _header(head, b"x-page-id")
    return int(value) if value else None


def _iso(date: str) -> str:
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, sha1: bytes, page_id) -> str:
    """The same record always gets the same identifier."""
    seed = hashlib.sha1("\0".join([url, date, sha1.hex(), str(page_id)]).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"


def _open_file(path: str):
    store, place = filesystem(path)
    return store.open_input_stream(place, compression=None)


_INDEX = ("path string, number bigint, page_id bigint, n_bytes bigint, sha1 binary, record_id string, url string, "
          "date string")
_INDEX_ROWS = 4096


def _index_task(batches):
    schema = pa.schema([("path", pa.string()), ("number", pa.int64()), ("page_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("sha1", pa.binary()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string())])
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            with _open_file(path) as f:
                for number, record in enumerate(read_arc(f)):
                    head, payload = _split_http(record["block"])
                    sha1, page_id = hashlib.sha1(payload).digest(), _page_id(head)
                    rows.append({"path": path, "number": number, "page_id": page_id, "n_bytes": len(payload), "sha1": sha1,
                                 "record_id": record_id(record["url"], record["archive-date"], sha1, page_id),
                                 "url": record["url"], "date": _iso(record["archive-date"])})
                    if len(rows) >= _INDEX_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def _head_lines(fields: dict) -> bytes:
    return (WARC_VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode()


def _warc_records(f, decided: list, damaged: list, count: list) -> Iterator[bytes]:
    """The WARC records of one ARC stream, as gzip members."""
    refers = {d["number"]: d for d in decided}
    for number, record in enumerate(read_arc(f, damaged)):
        head, payload = _split_http(record["block"])
        sha1 = hashlib.sha1(payload).digest()
        to = refers.get(number)
        block = head if to else record["block"]
        fields = {
            "WARC-Type": "revisit" if to else "response",
            "WARC-Record-ID": record_id(record["url"], record["archive-date"], sha1, _page_id(head)),
            "WARC-Target-URI": record["url"], "WARC-Date": _iso(record["archive-date"]),
            "WARC-IP-Address": record["ip-address"],
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1).decode(),
            "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        }
        if to:
            fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": to["to_id"],
                       "WARC-Refers-To-Target-URI": to["to_url"], "WARC-Refers-To-Date": to["to_date"]}
        fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
        count.append(number)
        yield _member(_head_lines(fields) + block + b"\r\n\r\n")


def _warc_task(folder: str):
    def run(batches):
        for batch in batches:
            for path, decided in zip(batch.column("path").to_pylist(), batch.column("decided").to_pylist()):
                damaged, count = [], []
                name = path.rsplit("/", 1)[1].removesuffix(".gz").removesuffix(".arc") + ".warc.gz"
                with _open_file(path) as f:
                    made = write_file(folder, name, _warc_records(f, decided or [], damaged, count))
                yield pa.RecordBatch.from_pylist([{"path": made, "records": len(count), "damaged": len(damaged)}])

    return run


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths of the archives below a folder, dealt to tasks by their number and
    bytes (not by the few bytes of the paths); contents are not read here."""
    files = land(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length"),
                 "archive-files")
    return files.repartition(_tasks(files), "path")


def _tasks(files: DataFrame) -> int:
    """At least as many tasks as keep TASK_BYTES each, and all cores, busy."""
    total = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(total["n"], max(4 * cores, -(-(total["size"] or 0) // TASK_BYTES))))


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Convert all ARC files below a folder; one row per WARC file with its
    records and the damaged places that were skipped."""
    ship_package(spark)
    files = _files(spark, arc_folder, "*.arc*")
    index = land(files.select("path").mapInArrow(_index_task, _INDEX), "arc-index")
    # the response of each payload: named before unnamed, the largest page id, then the latest record
    rank = F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "path", "number")
    keep = (index.where(F.col("n_bytes") >= revisit_bytes).groupBy("sha1", "n_bytes")
            .agg(F.max(F.struct(rank.alias("rank"), "record_id", "url", "date")).alias("to"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("sha1", "n_bytes", "to"))
    decided = (index.where(F.col("n_bytes") >= revisit_bytes).withColumn("rank", rank).join(keep, ["sha1", "n_bytes"])
               .where(F.col("rank") != F.col("to.rank"))
               .select("path", F.struct("number", F.col("to.record_id").alias("to_id"), F.col("to.url").alias("to_url"),
                                        F.col("to.date").alias("to_date")).alias("decided")))
    # per file at most one decision per record; files without any are converted as well
    by_file = files.select("path").join(decided.groupBy("path").agg(F.collect_list("decided").alias("decided")), "path", "left")
    return land(by_file.repartition(_tasks(files), "path").mapInArrow(
        _warc_task(warc_folder), "path string, records bigint, damaged bigint"), "warc-files")


def read_warc_records(raw) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of one WARC file (bytes or a stream, plain or gzip)."""
    stream = _Stream(io.BytesIO(raw) if isinstance(raw, (bytes, bytearray)) else raw)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        yield fields, block


def _read_warc_task(batches):
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to_id", pa.string())])
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            with _open_file(path) as f:
                for fields, block in read_warc_records(f):
                    head, payload = _split_http(block)
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
                    if fields["warc-type"] == "response":
                        size = len(payload)
                        if hashlib.sha1(payload).digest() != digest:
                            raise ValueError(f"payload digest of {fields['warc-record-id']} does not match")
                    else:  # a revisit has the head alone; it tells the payload's size
                        size = int(_header(head, b"content-length"))
                    rows.append({"record_id": fields["warc-record-id"], "page_id": _page_id(head),
                                 "url": fields["warc-target-uri"], "record_type": fields["warc-type"],
                                 "payload_bytes": size, "payload_digest": digest.hex(),
                                 "refers_to_id": fields.get("warc-refers-to")})
                    if len(rows) >= _INDEX_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all WARC files below a folder; ``refers_to`` is the page id
    of the response that a revisit names."""
    ship_package(spark)
    files = _files(spark, folder, "*.warc*")
    records = land(files.select("path").mapInArrow(
        _read_warc_task, "record_id string, page_id bigint, url string, record_type string, payload_bytes bigint, "
                         "payload_digest string, refers_to_id string"), "warc-records")
    # copies of one page row share an identifier
    named = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()
    wanted = records.where("refers_to_id IS NOT NULL").select("refers_to_id").distinct()
    return records.join(named.join(wanted, "refers_to_id"), "refers_to_id", "left")
