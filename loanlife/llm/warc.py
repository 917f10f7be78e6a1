"""WARC archives as a PySpark data source.

``df.write.format("warc")`` writes one gzip member per record; a member's extra
field (subfield ``sl``) holds its compressed size, so that a reader can step
over a record it does not want.  Files are named in a manifest at commit: files
of failed or repeated attempts are never read.  A folder without a manifest is another
writer's: all its ``.warc.gz`` files are read, nested ones included.

``spark.read.format("warc")`` plans one partition per file, takes equality, IN,
prefix, suffix, substring and null predicates on the header columns, parses the headers of
a record first, and decodes its payload only if the record passes and the read
schema has the payload.  Members without the size field (other writers' files)
are decoded and discarded instead of skipped.

Defined results
* null payload counts as empty; null header values are left out of the record and read back as null;
* bytes of the payload are written and read unchanged, whole, of any length below 2 GB;
* a revisit record has no payload of its own: ``payload`` is null, ``payload_digest``
  and ``payload_length`` describe the payload of the record it refers to;
* header names count without case; the payload of a record is what follows the head of an HTTP message,
  or else the whole block; a record without a length is read to its end;
* a folder with neither a manifest nor archives, a file that is not gzip and an archive that
  breaks off are errors, never fewer rows;
* line breaks in header values become spaces; an empty table gives an archive without
  records; columns beyond the schema are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_length bigint, payload binary")

# Field names of the format; payload_length has no standard field.
HEADER_OF = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
             "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
             "payload_length": "X-Payload-Length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "manifest-"
FILE_BYTES = 256 << 20    # a file is closed once it is this long; the unit of reading
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20
READ_BYTES = 1 << 20


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(values: dict) -> bytes:
    """One record as a gzip member that tells its own size."""
    revisit = values.get("record_type") == "revisit"
    block = HTTP_HEAD if revisit else HTTP_HEAD + (values.get("payload") or b"")
    lines = ["WARC/1.1"]
    for column, field in HEADER_OF.items():
        value = values.get(column)
        if value is not None:
            text = str(value).replace("\r", " ").replace("\n", " ")
            if column in ("record_id", "refers_to"):
                text = f"<{text}>"
            lines.append(f"{field}: {'sha1:' if column == 'payload_digest' else ''}{text}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    body = "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    data = deflate.compress(body) + deflate.flush()
    size = 10 + 2 + 12 + len(data) + 8
    return (b"\x1f\x8b\x08\x04" + b"\x00" * 4 + b"\x00\xff" + struct.pack("<H", 12) + b"sl"
            + struct.pack("<HII", 8, size, len(body)) + data
            + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF))


class Members:
    """The gzip members of an open file: heads first, bodies on demand."""

    def __init__(self, file):
        self.file, self.buffer = file, bytearray()      # cheap to extend, and to cut at the front

    def _fill(self, size: int) -> bool:
        while len(self.buffer) < size:
            more = self.file.read(READ_BYTES)
            if not more:
                return False
            self.buffer += more
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        """(headers, function that returns the block's bytes) of each record."""
        while self._fill(1):
            if not self._fill(10) or self.buffer[:3] != b"\x1f\x8b\x08":
                raise ValueError("not a gzip member where a record should begin")
            flags, start = self.buffer[3], 10
            size = None
            if flags & 4:
                self._fill(12)
                extra = struct.unpack_from("<H", self.buffer, 10)[0]
                self._fill(12 + extra)
                start = 12 + extra
                field = self.buffer[12:start]
                while len(field) >= 4:
                    length = struct.unpack_from("<H", field, 2)[0]
                    if field[:2] == b"sl":
                        size = struct.unpack_from("<I", field, 4)[0]
                    field = field[4 + length:]
            for flag in (8, 16):                      # name and comment, each ended by a zero byte
                if flags & flag:
                    while b"\0" not in self.buffer[start:] and self._fill(len(self.buffer) + 1):
                        pass
                    start = self.buffer.index(b"\0", start) + 1
            start += 2 * bool(flags & 2)
            inflate, at, text = zlib.decompressobj(-15), start, b""
            while b"\r\n\r\n" not in text and not inflate.eof:
                self._fill(at + 1)
                piece = inflate.unconsumed_tail or self.buffer[at:at + 4096]
                if not inflate.unconsumed_tail:
                    at += len(piece)
                if not piece:
                    raise ValueError("the archive ends within a record")
                text += inflate.decompress(piece, 4096)
            head, _, rest = text.partition(b"\r\n\r\n")
            headers = dict(line.partition(":")[::2] for line in head.decode("utf-8", "replace").split("\r\n")[1:])
            headers = {k.strip().lower(): v.strip() for k, v in headers.items()}
            state = {"at": at, "rest": rest, "inflate": inflate}

            def block(state=state, headers=headers) -> bytes:
                told, parts, inflate = headers.get("content-length", ""), [state["rest"]], state["inflate"]
                while not inflate.eof:
                    piece = inflate.unconsumed_tail
                    if not piece:
                        self._fill(state["at"] + 1)
                        piece = self.buffer[state["at"]:state["at"] + READ_BYTES]
                        state["at"] += len(piece)
                        if not piece:
                            raise ValueError("the archive ends within a record")
                    parts.append(inflate.decompress(piece))
                whole = b"".join(parts)
                return whole[:int(told)] if told.isdecimal() else whole.removesuffix(b"\r\n\r\n")

            yield headers, block
            if size is None:
                block()
                size = state["at"] - len(state["inflate"].unused_data) + 8
            if not self._fill(size):
                raise ValueError("the archive ends within a record")
            del self.buffer[:size]


def header_values(headers: dict[str, str]) -> dict:
    values = {column: headers.get(field.lower()) for column, field in HEADER_OF.items()}
    for column in ("record_id", "refers_to"):
        if values[column] is not None:
            values[column] = values[column].removeprefix("<").removesuffix(">")
    if values["payload_digest"] is not None:
        values["payload_digest"] = values["payload_digest"].removeprefix("sha1:")
    if values["payload_length"] is not None:
        told = values["payload_length"]
        values["payload_length"] = int(told) if told.isdecimal() else None
    return values


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the head of an HTTP message, the whole block of any other record."""
    if headers.get("content-type", "").lower().startswith("application/http") or block.startswith(b"HTTP/"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def passes(values: dict, filters: list) -> bool:
    for f in filters:
        value = values[f.attribute[0]]
        if isinstance(f, IsNull):
            ok = value is None
        elif isinstance(f, EqualNullSafe):
            ok = value == f.value
        elif value is None:
            ok = False
        elif isinstance(f, IsNotNull):
            ok = True
        elif isinstance(f, EqualTo):
            ok = value == f.value
        elif isinstance(f, In):
            ok = value in f.value
        elif isinstance(f, StringStartsWith):
            ok = value.startswith(f.value)
        elif isinstance(f, StringEndsWith):
            ok = value.endswith(f.value)
        else:
            ok = f.value in value
        if not ok:
            return False
    return True


@dataclass
class ArchiveFile(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema, path: str):
        self.columns, self.path, self.filters = list(schema.fieldNames()), path, []
        self.schema = schema

    def pushFilters(self, filters):
        kinds = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        store, root = fs.FileSystem.from_uri(self.path)
        names, manifests = [], 0
        for info in store.get_file_info(fs.FileSelector(root)):
            if info.base_name.startswith(MANIFEST):
                manifests += 1
                with store.open_input_stream(info.path) as f:
                    names += f.read().decode().split()
        if not manifests:
            every = store.get_file_info(fs.FileSelector(root, recursive=True))
            foreign = sorted(i.path for i in every if i.is_file and i.base_name.endswith(".warc.gz"))
            if not foreign:
                raise FileNotFoundError(f"neither a manifest nor archives in {self.path}")
            return [ArchiveFile(p) for p in foreign]
        return [ArchiveFile(f"{root}/{n}") for n in sorted(names)]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None or not getattr(partition, "path", None):
            return
        schema = to_arrow_schema(self.schema)
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], schema.field(c).type) for c in self.columns], schema=schema)

        with store.open_input_stream(partition.path, compression=None) as f:
            for headers, block in Members(f):
                values = header_values(headers)
                if not passes(values, self.filters):
                    continue
                values["payload"] = None
                if "payload" in self.columns and values["record_type"] != "revisit":
                    values["payload"] = payload_of(headers, block())
                    held += len(values["payload"])
                rows.append(values)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for values in batch.to_pylist():
                    if out is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    member = record(values)
                    out.write(member)
                    size += len(member)
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as f:
            f.write("\n".join(n for m in messages if m for n in m.files).encode())

    def abort(self, messages):
        """Files of an aborted write are in no manifest, so that no reader sees them."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options["path"])

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record per page: of equal payloads of at least ``min_bytes`` bytes the largest id is the response.

    Digests are grouped before they are joined, and the join shuffles both
    sides, so that adaptive execution can split a payload that very many pages
    have.  Equal payloads that repeat the largest id are all responses; a null
    id is a response only if no equal payload has an id.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    page = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("target_uri"),
                        payload.alias("payload"), F.sha1(payload).alias("sha"))
    first = page.groupBy("sha").agg(F.max("page_id").alias("first"))
    joined = page.join(first.hint("merge"), "sha")
    revisit = ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_bytes)

    def uri(c: str):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         uri("page_id").alias("record_id"), "target_uri", F.lit(date).alias("date"),
                         F.when(revisit, uri("first")).alias("refers_to"), base32(F.col("sha")).alias("payload_digest"),
                         F.octet_length("payload").cast("bigint").alias("payload_length"),
                         F.when(~revisit, F.col("payload")).alias("payload"))


def base32(sha_hex):
    """Base32 of a hexadecimal SHA-1: 160 bits, five at a time."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(sha_hex, i, 10), 16, 2), 40, "0") for i in (1, 11, 21, 31)])
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[F.substring(alphabet, F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1))
                      for i in range(32)])
