"""WARC archives as a PySpark data source, read and written."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from lodestone.llm.common import shared_folder

SCHEMA = "record_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, payload_length long, headers map<string,string>, payload binary"
#: Columns that stand for one header each; a filter on them is answered before a payload is decoded.
HEADER_OF = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
#: Subfield of the gzip header that holds the member's whole length, so that a reader can step over it.
_LENGTH_FIELD = b"WL"
_HEAD = b"\x1f\x8b\x08\x04"
_BATCH_BYTES = 8 << 20
_READ = 1 << 16


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def pack_member(data: bytes, level: int = 1) -> bytes:
    """One gzip member whose header tells its own length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 12 + 12 + len(body) + 8
    return _HEAD + b"\0\0\0\0\0\xff" + struct.pack("<H", 12) + _LENGTH_FIELD + struct.pack("<HQ", 8, length) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def header_lines(fields: dict[str, str | None]) -> bytes:
    clean = lambda v: v.replace("\r", "%0D").replace("\n", "%0A")
    return "".join(f"{k}: {clean(v)}\r\n" for k, v in fields.items() if v is not None).encode()


def make_record(row) -> bytes:
    """A WARC/1.1 record; a response holds its payload, a revisit only the HTTP header."""
    payload = bytes(row["payload"]) if row["payload"] is not None else b""
    http = b"HTTP/1.1 200 OK\r\n" + header_lines({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(row["payload_length"])}) + b"\r\n"
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = header_lines(
        {
            "WARC-Type": row["record_type"],
            "WARC-Record-ID": row["record_id"],
            "WARC-Date": row["warc_date"],
            "WARC-Target-URI": row["target_uri"],
            "WARC-Refers-To": row["refers_to"],
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
            "WARC-Payload-Digest": row["payload_digest"],
            "Content-Type": "application/http; msgtype=response",
            "Content-Length": str(len(block)),
        }
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Range(InputPartition):
    """Byte ranges of files that one task reads: the records that start inside them."""

    parts: tuple[tuple[str, int, int], ...]


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``.

    Options: ``splitBytes`` (128 MiB) bounds what a task reads and a file that is
    written holds; ``payload`` names the record types whose payload is wanted
    (comma-separated; all by default, ``none`` for none); ``corrupt`` says what
    becomes of a record that is cut short, does not inflate, fails its gzip CRC or
    the payload's digest, or has a head that is none: ``raise`` (the default) ends
    the query with file, offset and reason; ``row`` gives a row of record type
    ``corrupt`` in its place, with these in ``headers``, so that such records can be
    counted, and reads on from the next record that can be found. What is not
    inflated (payloads that are not wanted, records that a filter drops) is not held
    against its CRC or digest.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


class WarcWriter(DataSourceWriter):
    """Tasks write under ``_temporary``; only the files of the attempts that won are moved out on commit."""

    def __init__(self, options):
        self.uri, self.split = options["path"], int(options.get("splitBytes", 128 << 20))
        self.job = uuid.uuid4().hex

    def write(self, rows) -> Written:
        store, folder = open_store(self.uri)
        store.create_dir(f"{folder}/_temporary-{self.job}", recursive=True)
        names, out, used = [], None, 0
        try:
            for row in rows:
                if out is None or used >= self.split:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, used = store.open_output_stream(f"{folder}/_temporary-{self.job}/{names[-1]}", compression=None), 0
                member = pack_member(make_record(row))
                out.write(member)
                used += len(member)
        finally:
            if out is not None:
                out.close()
        return Written(tuple(names))

    def commit(self, messages) -> None:
        store, folder = open_store(self.uri)
        for message in messages:
            for name in message.names if message else ():
                store.move(f"{folder}/_temporary-{self.job}/{name}", f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        store, folder = open_store(self.uri)
        if store.get_file_info(f"{folder}/_temporary-{self.job}").type != pafs.FileType.NotFound:
            store.delete_dir(f"{folder}/_temporary-{self.job}")


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.uri, self.split = options["path"], int(options.get("splitBytes", 128 << 20))
        wanted = options.get("payload", "all")
        self.payload = None if wanted == "all" else frozenset() if wanted == "none" else frozenset(wanted.split(","))
        self.corrupt = options.get("corrupt", "raise")
        if self.corrupt not in ("raise", "row"):
            raise ValueError(f"corrupt must be raise or row, not {self.corrupt}")
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        """Takes equality, membership and prefix tests on header columns; Spark keeps the others."""
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column in HEADER_OF and isinstance(f, (EqualTo, StringStartsWith)) and f.value is not None:
                self.tests.append((HEADER_OF[column], "=" if isinstance(f, EqualTo) else "^", (f.value,)))
            elif column in HEADER_OF and isinstance(f, In) and None not in f.value:
                self.tests.append((HEADER_OF[column], "=", tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[Range]:
        store, folder = open_store(self.uri)
        ranges: list[list[tuple[str, int, int]]] = [[]]
        room = self.split
        for info in sorted(store.get_file_info(pafs.FileSelector(folder)), key=lambda i: i.path):
            if info.type != pafs.FileType.File or not info.base_name.endswith((".warc", ".warc.gz")):
                continue
            # A plain archive cannot be entered in its middle without a doubt, so it is one range.
            step = self.split if info.path.endswith(".gz") else max(info.size, 1)
            for start in range(0, info.size, step):
                end = min(start + step, info.size)
                if ranges[-1] and end - start > room:
                    ranges.append([])
                    room = self.split
                ranges[-1].append((info.path, start, end))
                room -= end - start
        return [Range(tuple(r)) for r in ranges]

    def _wanted(self, head: dict[str, str]) -> bool:
        return all((head.get(name) in values) if kind == "=" else (head.get(name) or "").startswith(values[0]) for name, kind, values in self.tests)

    def _takes_payload(self, head: dict[str, str]) -> bool:
        kind = head.get("WARC-Type", "")
        return kind not in ("revisit", "corrupt") and (self.payload is None or kind in self.payload)

    def _records(self, file, path: str, start: int, end: int) -> Iterator[tuple[dict, bytes]]:
        """The range's records; a broken one is an error or a row, and reading goes on behind it."""
        zipped = path.endswith(".gz")
        at: int | None = start if not zipped or start == 0 else _first_record(file, start, end)
        while at is not None and at < end:
            try:
                one = (gz_record if zipped else plain_record)(file, at, self._wanted, self._takes_payload)
            except CorruptRecord as broken:
                if self.corrupt == "raise":
                    raise ValueError(f"corrupt WARC record in {path} at offset {at}: {broken}") from broken
                head = {"WARC-Type": "corrupt", "File": path, "Offset": str(at), "Reason": str(broken)}
                if self._wanted(head):
                    yield head, b""
                at = _first_record(file, at + 1, end) if zipped else _next_plain(file, at + 1, end)
                continue
            if one is None:
                return
            head, block, length = one
            if head is not None:
                yield head, block
            at += length

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.uri)
        schema = pa.schema([(c, pa.string()) for c in HEADER_OF] + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        rows: list[dict] = []
        used = 0
        for path, start, end in partition.parts:
            with store.open_input_file(path) as file:
                for head, block in self._records(file, path, start, end):
                    http, payload = split_http(head, block)
                    length = next((int(v) for k, v in http.items() if k.lower() == "content-length" and v.strip().isdigit()), None)
                    if not self._takes_payload(head):
                        payload = None
                    rows.append({c: head.get(h) for c, h in HEADER_OF.items()} | {"payload_length": length, "headers": list(head.items()), "payload": payload})
                    used += 500 + len(payload or b"")
                    if used > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, used = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class CorruptRecord(Exception):
    """A record that cannot be read whole, or is not what its checksums say."""


def parse_head(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if _}


def warc_head(data: bytes) -> tuple[dict[str, str], int]:
    """A record's header fields and its block's length."""
    if not data.startswith(b"WARC/"):
        raise CorruptRecord("no WARC version line")
    head = parse_head(data)
    length = head.get("Content-Length", "")
    if not length.isdecimal():
        raise CorruptRecord("no Content-Length")
    return head, int(length)


def split_http(head: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and body of a block; a block of another kind is all body."""
    if not head.get("Content-Type", "").startswith("application/http"):
        return {}, block
    top, gap, body = block.partition(b"\r\n\r\n")
    return parse_head(top), body


def check_digest(head: dict[str, str], block: bytes) -> None:
    """Hold a payload against its digest, if that is of a known kind and no transfer coding stands between."""
    kind, _, want = head.get("WARC-Payload-Digest", "").partition(":")
    if head.get("WARC-Type") == "revisit" or kind.lower() not in ("sha256", "sha1", "md5"):
        return
    http, payload = split_http(head, block)
    if any(k.lower() in ("transfer-encoding", "content-encoding") for k in http):
        return
    made = hashlib.new(kind.lower(), payload)
    if want.lower() != made.hexdigest() and want.upper().rstrip("=") != base64.b32encode(made.digest()).decode().rstrip("="):
        raise CorruptRecord("the payload is not what its digest says")


def plain_record(file, at: int, wanted, takes_payload) -> tuple[dict | None, bytes, int] | None:
    """Head (none if unwanted), block and whole length of the record at ``at``; nothing at the file's end."""
    file.seek(at)
    data = b""
    while (top := data.find(b"\r\n\r\n")) < 0:
        more = file.read(4096)
        if not more:
            if not data.strip():
                return None
            raise CorruptRecord("the head is cut short")
        if not data and not more.startswith(b"WARC/"):
            raise CorruptRecord("no WARC version line")
        data += more
    head, length = warc_head(data[:top])
    top += 4
    if at + top + length > file.size():
        raise CorruptRecord("the block is cut short")
    if not wanted(head):
        return None, b"", top + length + 4
    size = length if takes_payload(head) else min(length, _READ)
    block = data[top : top + size]
    if len(block) < size:
        file.seek(at + top + len(block))
        block += file.read(size - len(block))
    if takes_payload(head):
        check_digest(head, block)
    return head, block, top + length + 4


def _next_plain(file, start: int, end: int) -> int | None:
    """Offset of the next version line behind the end of a record in ``[start, end)``."""
    at, tail = start, b""
    while at < end:
        file.seek(at)
        data = tail + file.read(_READ)
        k = data.find(b"\r\n\r\nWARC/1.")
        if k >= 0:
            found = at - len(tail) + k + 4
            return found if found < end else None
        if len(data) == len(tail):
            return None
        at, tail = at - len(tail) + len(data), data[-10:]
    return None


def _member_at(file, at: int) -> tuple[bytes, int | None]:
    """The first bytes of a gzip member, and its length where its header tells it."""
    file.seek(at)
    data = file.read(_READ)
    if len(data) >= 24 and data[:4] == _HEAD and data[12:14] == _LENGTH_FIELD:
        return data, struct.unpack("<Q", data[16:24])[0]
    return data, None


def _first_record(file, start: int, end: int) -> int | None:
    """Offset of the first member in ``[start, end)`` that inflates to the head of a WARC record."""
    at, tail = start, b""
    while at < end:
        file.seek(at)
        data = tail + file.read(_READ)
        base = at - len(tail)
        k = data.find(b"\x1f\x8b\x08")
        while 0 <= k and base + k < end:
            file.seek(base + k)
            try:
                if zlib.decompressobj(31).decompress(file.read(4096), 16).startswith(b"WARC/"):
                    return base + k
            except zlib.error:
                pass
            k = data.find(b"\x1f\x8b\x08", k + 1)
        if len(data) == len(tail):
            return None
        at, tail = base + len(data), data[-2:]
    return None


def gz_record(file, at: int, wanted, takes_payload) -> tuple[dict | None, bytes, int] | None:
    """Head (none if unwanted), block and whole length of the member at ``at``; nothing at the file's end.

    The head is inflated and judged first; the rest of an unwanted member is stepped
    over, or, where its length is not told, inflated without being kept. A member
    whose payload is taken is inflated to its end, which checks its CRC.
    """
    data, length = _member_at(file, at)
    if not data:
        return None
    inflate, read = zlib.decompressobj(31), at + len(data)

    def more(limit: int = _READ) -> bytes:
        """The next piece, which may be empty; an error where the file ends before the member."""
        nonlocal data, read
        if not data:
            file.seek(read)
            data = file.read(_READ)
            read += len(data)
            if not data:
                raise CorruptRecord("the member is cut short")
        try:
            made = inflate.decompress(data, limit)
        except zlib.error as wrong:
            raise CorruptRecord(str(wrong)) from wrong
        data = inflate.unconsumed_tail
        return made

    text = bytearray(more(4096))
    while (top := text.find(b"\r\n\r\n")) < 0:
        if inflate.eof or not b"WARC/".startswith(bytes(text[:5])):
            raise CorruptRecord("no WARC head")
        text += more()
    head, size = warc_head(bytes(text[:top]))
    chosen, whole = wanted(head), takes_payload(head)
    if chosen:
        need = top + 4 + (size if whole else min(size, _READ))
        while len(text) < need and not inflate.eof:
            text += more(need - len(text) + 1)
        if len(text) < need:
            raise CorruptRecord("the block is shorter than its Content-Length")
    if length is None or (chosen and whole):
        while not inflate.eof:
            more()
        length = read - len(inflate.unused_data) - at
    elif at + length > file.size():
        raise CorruptRecord("the member is cut short")
    block = bytes(text[top + 4 : need]) if chosen else b""
    if chosen and whole:
        check_digest(head, block)
    return (head if chosen else None), block, length


def write_warc(rows: DataFrame, uri: str, **options) -> None:
    """Write rows of SCHEMA (``headers`` is made anew) as gzipped WARC files into a folder."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.withColumn("headers", F.lit(None).cast("map<string,string>")).select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.format("warc").mode("append").options(**options).save(uri)


def read_warc(spark: SparkSession, uri: str, **options) -> DataFrame:
    """The records of a folder; filters on header columns are pushed down to the reader."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(uri)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows of SCHEMA for pages: of equal payloads of at least ``least`` bytes the
    smallest id is a response, the others are revisits of it.

    A null page has an empty payload; rows with the group's smallest id, repeated
    rows included, are responses; a null id revisits, unless its whole group is
    null. Digests are grouped before the join, whose other side has one row for
    each digest, so a payload that very many pages share is split by AQE.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), html.alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256)).withColumn("payload_length", F.octet_length("payload").cast("long"))
    firsts = base.where(F.col("payload_length") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return base.join(firsts, "digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        named(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.when(revisit, named(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive_pages(pages: DataFrame, uri: str | None = None, **columns) -> DataFrame:
    """Write all pages into WARC files (in the shared folder by default) and read them back.

    Responses are read with their payloads, revisits by their heads alone: both
    tests are pushed down to the reader. Rows that share an id give a record each.
    Pages of any length are held one at a time. An empty table gives no rows; other
    columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    uri = uri or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    store, folder = open_store(uri)
    store.create_dir(folder, recursive=True)
    write_warc(page_records(pages, **columns), uri)
    revisits = read_warc(spark, uri, payload="none").where("record_type = 'revisit'")
    return read_warc(spark, uri).where("record_type = 'response'").union(revisits)
