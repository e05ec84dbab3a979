"""Legacy ARC archives, their conversion to WARC, and reading both (operator 7).

ARC files begin with a version block: version 1 headers hold URL, IP address,
date, content type and length; version 2 adds result code, checksum,
location, offset and file name.  The converter reads each header line by the
layout its file's version block declares, takes exactly the declared length
as the record's body, and writes the equivalent WARC 1.1 record: a record id
derived from file, offset and digest, the 14-digit date as a W3C time, type
response or revisit, and SHA-1 digests in base32.  Records are separate gzip
members.  Files are written by tasks straight to the shared folder; each
task names its files after its attempt and only names in a manifest are read.

Of records with equal payloads of at least ``least`` bytes, that with the
smallest id is the response and the others revisit it; this is decided by one
aggregate over digests, so a group of copies of any size meets as one row.

Null html counts as empty; null URLs become ``urn:page:<id>``; other columns
are ignored; an empty table gives no files and an empty result.  Rows that
repeat a page id are all kept; a row with a null id is always a response.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit
from cohortlens.llm.storage import open_fs

# Header layouts named by the version blocks.
ARC_LAYOUT = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
ROLL_BYTES = 128 << 20
_BLOCK = 1 << 20


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Members:
    """The concatenated content of a file of gzip members, read in blocks."""

    def __init__(self, stream):
        self.stream, self.z, self.raw, self.buf, self.done = stream, zlib.decompressobj(31), b"", bytearray(), 0

    def _fill(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(_BLOCK)
            if not self.raw:
                return False
        if self.z.eof:
            self.z = zlib.decompressobj(31)
        self.buf += self.z.decompress(self.raw)
        self.raw = self.z.unused_data if self.z.eof else b""
        return True

    def line(self) -> bytes | None:
        """Next line without its line end; None at the end of the file."""
        start = 0
        while (at := self.buf.find(b"\n", start)) < 0:
            start = len(self.buf)
            if not self._fill():
                if self.buf:
                    raise ValueError("an archive ends inside a header line")
                return None
        out = bytes(self.buf[:at]).rstrip(b"\r")
        del self.buf[:at + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not self._fill():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


# ---- ARC ----------------------------------------------------------------

def arc_version_block(version: int, name: str, date: str) -> bytes:
    layout = " ".join(ARC_LAYOUT[version]).encode()
    body = b"%d 0 legacy-writer\n" % version + layout + b"\n"
    blank = b" -" * (len(ARC_LAYOUT[version]) - 5)
    return b"filedesc://%s 0.0.0.0 %s text/plain%s %d\n" % (name.encode(), date.encode(), blank, len(body)) + body


def arc_record(version: int, url: str, date: str, payload: bytes, offset: int, name: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    more = b"" if version == 1 else b" 200 %s - %d %s" % (sha1_base32(payload).encode(), offset, name.encode())
    head = b"%s 0.0.0.0 %s text/html%s %d\n" % (url.encode(), date.encode(), more, len(http) + len(payload))
    return b"\n" + head + http + payload


def read_arc(stream):
    """(fields, body) of each record; the version block gives the header layout."""
    src = _Members(stream)
    first = src.line()
    if first is None:
        return
    block = src.take(int(first.rsplit(b" ", 1)[1])).split(b"\n")
    version = int(block[0].split(b" ")[0])
    names = ARC_LAYOUT[version]
    if tuple(block[1].decode().split(" ")) != names:
        raise ValueError("an ARC version block declares an unknown header layout")
    while (line := src.line()) is not None:
        if not line:  # records are set apart by an empty line
            continue
        parts = line.rsplit(b" ", len(names) - 1)
        fields = dict(zip(names, (p.decode() for p in parts)))
        yield fields, src.take(int(fields["Archive-length"]))


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(status line and headers with the empty line, payload)."""
    at = body.find(b"\r\n\r\n")
    return (body[:at + 4], body[at + 4:]) if at >= 0 else (b"", body)


def _url_of(page_id: int, url: str | None) -> str:
    """The page id rides in the URL's fragment, so an archive by itself tells it."""
    clean = "".join("%%%02X" % ord(c) if c <= " " or c == "\x7f" else c for c in url) if url else f"urn:page:{'' if page_id is None else page_id}"
    return f"{clean}#page={'' if page_id is None else page_id}"


def _page_of(url: str) -> tuple[str, int | None]:
    """(URL without the page mark, page id)."""
    clean, _, page = url.rpartition("#page=")
    return clean, int(page) if page else None


def _date_of(page_id: int) -> str:
    """A 14-digit date for pages that have none: one second a page from 1996 on, over ten years."""
    import datetime
    at = datetime.datetime(1996, 1, 1) + datetime.timedelta(seconds=(page_id or 0) % (3650 * 86400))
    return at.strftime("%Y%m%d%H%M%S")


def _rolled(folder: str, kind: str, records, roll_bytes: int):
    """Write (header of file or None, record) pairs to files of about ``roll_bytes``; yields (file, records)."""
    from pyspark import TaskContext
    task = TaskContext.get()
    fs, path = open_fs(folder)
    out, name, size, n, roll = None, "", 0, 0, 0
    for begin, record in records:
        if out is None:
            name = f"{kind}-{task.partitionId():06d}-{roll:04d}-{task.taskAttemptId()}.{kind}.gz"
            fs.create_dir(path, recursive=True)
            out, size, n, roll = fs.open_output_stream(f"{path}/{name}"), 0, 0, roll + 1
            head = begin(name)
            if head:
                size += out.write(_member(head)) or 0
        data = _member(record(name, size))
        out.write(data)
        size, n = size + len(data), n + 1
        if size >= roll_bytes:
            out.close()
            yield name, n
            out = None
    if out is not None:
        out.close()
        yield name, n


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write pages as ARC files, version 1 from even tasks and version 2 from odd ones; returns the manifest (file, records)."""
    def run(batches):
        from pyspark import TaskContext
        version = 1 + TaskContext.get().partitionId() % 2

        def records():
            for batch in batches:
                for part in textkit.row_blocks(batch, "html"):
                    for page, url, html in zip(*(c.to_pylist() for c in part.columns)):
                        payload = (html or "").encode()
                        yield (lambda name: arc_version_block(version, name, "19960101000000")), \
                              (lambda name, size: arc_record(version, _url_of(page, url), _date_of(page), payload, size, name))

        for name, n in _rolled(f"{folder}/arc", "arc", records(), roll_bytes):
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return storage.stage(rows.mapInArrow(run, "file string, records long"), folder, "arc_manifest")


def _each_file(manifest: DataFrame) -> DataFrame:
    """One file a row, dealt over tasks; files are of bounded size."""
    return manifest.select("file").repartition(max(1, manifest.count()))


def index_arc(manifest: DataFrame, folder: str) -> DataFrame:
    """(file, rec, page_id, payload_bytes, payload_digest) of every ARC record, from the bodies; rec is its place in the file."""
    def run(batches):
        fs, path = open_fs(f"{folder}/arc")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                ids, sizes, digests = [], [], []
                with fs.open_input_stream(f"{path}/{name}") as f:
                    for fields, body in read_arc(f):
                        payload = split_http(body)[1]
                        ids.append(_page_of(fields["URL"])[1])
                        sizes.append(len(payload))
                        digests.append(sha1_base32(payload))
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([name] * len(ids), pa.string()), "rec": pa.array(range(len(ids)), pa.int64()),
                    "page_id": pa.array(ids, pa.int64()), "payload_bytes": pa.array(sizes, pa.int64()),
                    "payload_digest": pa.array(digests, pa.string())})

    return _each_file(manifest).mapInArrow(
        run, "file string, rec long, page_id long, payload_bytes long, payload_digest string")


def repeated_payloads(index: DataFrame, least: int) -> DataFrame:
    """(payload_digest, payload_bytes, first): payloads of at least ``least`` bytes in more than one record."""
    return (index.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
            .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
            .where("first < last").drop("last"))


def warc_info(name: str) -> bytes:
    body = b"software: arc-to-warc\r\nformat: WARC File Format 1.1\r\n"
    return _warc([("WARC-Type", "warcinfo"), ("WARC-Filename", name), ("WARC-Date", "1996-01-01T00:00:00Z"),
                  ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                  ("Content-Type", "application/warc-fields")], body)


def _warc(fields: list, body: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _w3c(date14: str) -> str:
    d = date14
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def to_warc(fields: dict, body: bytes, first: int | None) -> bytes:
    """The WARC record of one ARC record; ``first`` is the page it revisits, if any."""
    http, payload = split_http(body)
    url, page = _page_of(fields["URL"])
    digest = sha1_base32(payload)
    record_id = lambda p: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest}/{p}')}>"
    block = body if first is None else http
    head = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Target-URI", url),
            ("WARC-Date", _w3c(fields["Archive-date"])), ("WARC-Record-ID", record_id(page)),
            ("WARC-IP-Address", fields["IP-address"]), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
            ("X-Page-ID", "" if page is None else page), ("X-Payload-Length", len(payload))]
    if first is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(first)), ("X-Refers-To-Page-ID", first)]
    return _warc(head, block)


def convert(manifest: DataFrame, folder: str, least: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Convert every ARC file to WARC files below ``folder``; returns the WARC manifest (file, records).

    Which records revisit another comes from the digests of all files; each converting task gets only the
    revisits of its own files, sorted as the file is."""
    index = storage.stage(index_arc(manifest, folder), folder, "arc_index")
    revisits = (index.join(repeated_payloads(index, least), ["payload_digest", "payload_bytes"])
                .where("page_id <> first").select("file", "rec", "first"))
    # a file and its own revisits meet in one row, bounded by the file's size
    firsts = revisits.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("rec", "first"))).alias("firsts"))
    todo = manifest.join(firsts, "file", "left").select("file", "firsts").repartition(max(1, manifest.count()), "file")

    def run(batches):
        fs, path = open_fs(f"{folder}/arc")

        def records():
            for batch in batches:
                for name, firsts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    known = dict(firsts or [])
                    with fs.open_input_stream(f"{path}/{name}") as f:
                        for rec, (fields, body) in enumerate(read_arc(f)):
                            yield warc_info, (lambda _n, _s: to_warc(fields, body, known.get(rec)))

        for name, n in _rolled(f"{folder}/warc", "warc", records(), roll_bytes):
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    return storage.stage(todo.mapInArrow(run, "file string, records long"), folder, "warc_manifest")


def read_warc(stream):
    """(fields, block) of each record of a WARC file of gzip members."""
    src = _Members(stream)
    while (line := src.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record without its version line")
        fields = {}
        while line := src.line():
            k, _, v = line.decode().partition(": ")
            fields[k] = v
        yield fields, src.take(int(fields["Content-Length"]))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Per page, from the WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, warc_date."""
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "target_uri string, warc_date string")

    def run(batches):
        fs, path = open_fs(f"{folder}/warc")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}") as f:
                    for h, block in read_warc(f):
                        kind = h["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if "sha1:" + sha1_base32(block) != h["WARC-Block-Digest"]:
                            raise ValueError("a WARC block does not match its digest")
                        size, digest = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response":
                            payload = split_http(block)[1]
                            size, digest = len(payload), sha1_base32(payload)
                        of = h.get("X-Refers-To-Page-ID")
                        page = h["X-Page-ID"]
                        rows.append((int(page) if page else None, size, digest, kind, int(of) if of else None,
                                     h["WARC-Target-URI"], h["WARC-Date"]))
                cols = list(zip(*rows)) if rows else [()] * 7
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[p.split(" ")[0] for p in schema.split(", ")])

    return _each_file(manifest).mapInArrow(run, schema)


def archive_digests(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """pages -> ARC files -> WARC files -> per page what the WARC files say."""
    warc = convert(write_arc(pages, folder), folder, least)
    return read_archives(warc, folder)


def read_file(data: bytes, kind: str = "warc") -> list:
    """Records of one archive held in memory (tests, small files)."""
    return list((read_warc if kind == "warc" else read_arc)(io.BytesIO(data)))
