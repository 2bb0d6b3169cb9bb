"""ZIP-packaged WARC archives: written by tasks, read back by parsing the
central directory (ZIP64 too) and range-reading single records."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, functions as F

from .common import RID, cut_lineage, scratch_path, with_row_id

ARCHIVE_BYTES = 64 << 20     # stored bytes after which a task begins its next archive
MIN_BYTES = 0                # smaller payloads are never revisits
RECORDS_A_READ = 2000        # records of one range of an index, the unit of reading
RECORDS, INDEX = "data.warc.gz", "index.tsv"
_UNSAFE = {i: f"%{i:02X}" for i in [*range(0x21), 0x7F]}


# ------------------------------------------------------------------ writing

def open_store(uri: str):
    """(file system, path) of a folder that driver and executors share."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record_id(page_id, row) -> str:
    """A record's name: the page_id as text, percent-encoded (so that any text can
    stand there; ``!`` is no encoded text and means a null), and the row."""
    from urllib.parse import quote
    return f"<urn:x-page:{'!' if page_id is None else quote(str(page_id), safe='')}:{row}>"


def page_of(name: str) -> str | None:
    """The page_id in a ``record_id``."""
    from urllib.parse import unquote
    got = name.split(":")[2]
    return None if got == "!" else unquote(got)


def record_bytes(page_id, row, url, payload: bytes, digest: str, refers_to, refers_row) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit (refers_to
    given) with the payload's digest and size alone."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    body = http if refers_row is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_row is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, row)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {(url or 'about:blank').translate(_UNSAFE)}",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(body)}"]
    if refers_row is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, refers_row)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class _Archive:
    """One archive in the making: a stored member of gzip records, then the index."""

    def __init__(self, store, path):
        import uuid
        import zipfile
        self.store, self.path, self.temp = store, path, f"{path}.{uuid.uuid4().hex}.tmp"
        self.out = store.open_output_stream(self.temp)
        self.zip = zipfile.ZipFile(_Unseekable(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, name, data):
        import gzip
        packed = gzip.compress(data, 1, mtime=0)
        self.member.write(packed)
        self.index.append(f"{name}\t{self.at}\t{len(packed)}")
        self.at += len(packed)

    def close(self):
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.out.close()
        self.store.move(self.temp, self.path)     # whole or not there; a retry replaces it
        return len(self.index)


class _Unseekable:
    """A write-only stream: ZipFile then writes sizes after the data."""

    def __init__(self, out):
        self.out = out

    def write(self, data):
        self.out.write(data)
        return len(data)

    def flush(self):
        pass


def _write(batches, folder, archive_bytes):
    """Arrow rows of pages -> one row per finished archive (path, records)."""
    import pyarrow as pa
    from pyspark import TaskContext
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    part, number, archive, done = TaskContext.get().partitionId(), 0, None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in
                ("page_id", RID, "url", "payload", "digest", "refers_to", "refers_row")]
        for page_id, row, url, payload, digest, refers_to, refers_row in zip(*cols):
            if archive is None:
                archive = _Archive(store, f"{root}/part-{part:06d}-{number:04d}.zip")
                number += 1
            archive.add(row, record_bytes(page_id, row, url, payload, digest, refers_to, refers_row))
            if archive.at >= archive_bytes:
                done.append((archive.path, archive.close()))
                archive = None
    if archive is not None:
        done.append((archive.path, archive.close()))
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                      pa.array([d[1] for d in done], pa.int64())], ["path", "records"])


def _digests(batches):
    """payload -> bare base32 SHA-1."""
    import base64
    import hashlib

    import pyarrow as pa
    for batch in batches:
        d = [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d, pa.string())],
                                         [*batch.schema.names, "digest"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> ZIP archives in ``folder``; returns
    a table (path, records) of a row an archive.

    A record per row; null html is an empty payload, null url ``about:blank``.
    Of equal payloads of ``min_bytes`` or more, the row with the largest
    page_id is the response (rows that repeat it: the last), the others are
    revisits that refer to it. Equal payloads are told by SHA-1. Only digests
    are grouped, with a map-side maximum; payloads are shuffled only for the
    join to the few repeated digests, in which a hot one may be split.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    base = with_row_id(pages.select("page_id", F.col("url").cast("string").alias("url"),
                                    F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")))
    base = base.mapInArrow(_digests, f"page_id {id_type}, url string, payload binary, {RID} bigint, digest string")
    rows = cut_lineage(base.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct("page_id", RID)).alias("m"), F.count("*").alias("c")).where("c > 1").select(
        "digest", F.col("m.page_id").alias("refers_to"), F.col(f"m.{RID}").alias("refers_row")), "repeated")
    from .common import sized
    joined = base.join(sized(rows, 64), "digest", "left")
    revisit = (F.col("refers_row") != F.col(RID)) & (F.octet_length("payload") >= min_bytes)
    out = joined.select("page_id", RID, "url", "payload", "digest",
                        F.when(revisit, F.col("refers_to")).alias("refers_to"),
                        F.when(revisit, F.col("refers_row")).alias("refers_row"))
    return cut_lineage(out.mapInArrow(lambda it: _write(it, folder, archive_bytes),
                                      "path string, records bigint"), "archives")


# ------------------------------------------------------------------ reading

class ZipDirectory:
    """The members of a ZIP file, from its end records and central directory;
    nothing is extracted. ``read(offset, length)`` is all it asks of a file."""

    def __init__(self, read, size):
        self.read = read
        tail_at = max(0, size - (22 + 65535))
        tail = read(tail_at, size - tail_at)
        # the last end record whose comment reaches exactly to the end of the file
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory record")
        count, length, start = struct.unpack("<HLL", tail[at + 10:at + 20])
        here = tail_at + at
        if here >= 20 and (loc := read(here - 20, 20))[:4] == b"PK\x06\x07":
            where = struct.unpack("<Q", loc[8:16])[0]
            end = read(where, 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("ZIP64 end record is not where its locator says")
            count, length, start = struct.unpack("<QQQ", end[32:56])
        self.members = dict(self._entries(read(start, length), count))

    @staticmethod
    def _entries(data, count):
        at = 0
        for _ in range(count):
            if data[at:at + 4] != b"PK\x01\x02":
                raise ValueError("bad central directory entry")
            method, = struct.unpack("<H", data[at + 10:at + 12])
            packed, size, n, x, c = struct.unpack("<LLHHH", data[at + 20:at + 34])
            offset, = struct.unpack("<L", data[at + 42:at + 46])
            name = data[at + 46:at + 46 + n].decode("utf-8")
            extra, p = data[at + 46 + n:at + 46 + n + x], 0
            while p + 4 <= len(extra):
                tag, length = struct.unpack("<HH", extra[p:p + 4])
                if tag == 1:                 # 64-bit values, only of fields that are full
                    q = p + 4
                    if size == 0xFFFFFFFF:
                        size, q = struct.unpack("<Q", extra[q:q + 8])[0], q + 8
                    if packed == 0xFFFFFFFF:
                        packed, q = struct.unpack("<Q", extra[q:q + 8])[0], q + 8
                    if offset == 0xFFFFFFFF:
                        offset = struct.unpack("<Q", extra[q:q + 8])[0]
                p += 4 + length
            yield name, (method, packed, size, offset)
            at += 46 + n + x + c

    def stored(self, name) -> tuple[int, int]:
        """(offset in the file, length) of a stored member's data."""
        method, packed, size, offset = self.members[name]
        if method or packed != size:
            raise ValueError(f"{name} is not stored")
        head = self.read(offset, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("bad local header")
        n, x = struct.unpack("<HH", head[26:30])
        return offset + 30 + n + x, size


class _File:
    def __init__(self, store, path):
        self.file = store.open_input_file(path)
        self.size = self.file.size()

    def read(self, offset, length):
        self.file.seek(offset)
        return self.file.read(length)


def parse_record(data: bytes):
    """(headers in lower case, block) of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[:int(headers["content-length"])]


_READ = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, " \
        "refers_to string, payload binary"


def _read_ranges(batches, folder, with_payload):
    """Rows (path, lo, hi): index lines lo to hi of an archive -> records."""
    import base64
    import gzip
    import hashlib

    import pyarrow as pa
    store, _ = open_store(folder)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        for path, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "hi"))):
            file = _File(store, path)
            zip_dir = ZipDirectory(file.read, file.size)
            data_at, _ = zip_dir.stored(RECORDS)
            index_at, n = zip_dir.stored(INDEX)
            lines = file.read(index_at, n).decode().split("\n")[lo:hi]
            out = []
            for line in lines:
                _, at, size = line.split("\t")
                h, block = parse_record(gzip.decompress(file.read(data_at + int(at), int(size))))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                kind, length = h["warc-type"], len(payload)
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                if kind == "revisit":
                    length = int(http.lower().partition(b"content-length:")[2].split(b"\r\n")[0])
                ref = h.get("warc-refers-to")
                out.append((page_of(h["warc-record-id"]), h["warc-target-uri"], length, digest, kind,
                            page_of(ref) if ref else None, payload if with_payload else None))
            file.file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False,
                  records_a_read: int = RECORDS_A_READ) -> DataFrame:
    """(path, records) of archives -> a row per record. A task reads ranges of
    index lines; each record is one range read of the stored member."""
    ranges = (archives.withColumn("lo", F.explode(F.expr(f"sequence(0L, records - 1, {records_a_read}L)")))
              .select("path", "lo", (F.col("lo") + records_a_read).alias("hi")))
    n = max(1, ranges.count())
    parts = max(1, min(n, 4 * int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return ranges.repartition(parts).mapInArrow(lambda it: _read_ranges(it, folder, with_payload), _READ)


def archive_rows(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    id_type = pages.schema["page_id"].dataType.simpleString()
    got = read_archives(write_archives(pages, folder).where("records > 0"), folder)
    return got.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))
