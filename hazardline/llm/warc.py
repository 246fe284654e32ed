"""WARC archives of pages, and their normaliser: from one gzip stream a file to one gzip member a record, with an index.

Archives are often one gzip stream from end to end, in which no record can be read without all before it. The normaliser
inflates such a file once, rewrites every record as a gzip member of its own, and writes a sidecar with the place of each.
Then a record is read by its offset. Files are streams throughout: neither a file nor a record is held whole while it is
rewritten. All three steps are Spark jobs over many files; a task that is run again writes the same files again.
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.llm.common import cut, map_arrow
from hazardline.session import shared_folder

#: Payloads of fewer bytes are never written as a reference to an equal one.
LEAST_BYTES = 1000
#: Records of a file that :func:`write_archives` writes.
FILE_RECORDS = 100_000
#: Bytes read, inflated or compressed at a time.
CHUNK = 1 << 18
#: Bytes of payloads in a batch that :func:`read_archives` hands on.
BATCH_BYTES = 16 << 20
#: Longest header of a record.
HEADER_BYTES = 1 << 16

# --- fixed values of the format ---
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = "\r\n\r\n"
# ----------------------------------

_INDEX = ["archive", "offset", "length", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to"]
_INDEX_SCHEMA = (
    "archive string, offset long, length long, record_type string, page_id string, payload_bytes long, "
    "payload_digest string, refers_to string"
)


# ---------------------------------------------------------------- writing


def tag_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to for each row of ``pages``.

    Of rows with equal payloads of ``least_bytes`` or more, those with the largest page_id are responses and the others
    revisit it. Payloads are compared by SHA-1 and size. Rows that repeat the largest page_id are all responses; a null
    page_id is smaller than any, and where a group has no other all its rows are responses. Smaller payloads are always
    responses. A null html is an empty payload. Only ids and digests are shuffled to find the groups, and their largest
    ids are combined before that, so a payload that a third of the pages share is no large group.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), html.alias("payload"),
        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    large = rows.where(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_digest")
    last = large.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = (
        large.join(last.select("payload_digest", "refers_to"), "payload_digest")
        .where(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("id_"), F.col("payload_digest").alias("digest_"), "refers_to")
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("id_")) & (F.col("payload_digest") == F.col("digest_"))
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type")
    return rows.join(revisits, same, "left").select(*rows.columns, kind, "refers_to")


def _record(date: str) -> F.Column:
    """A record as text, from the columns of :func:`tag_revisits`."""

    def name(page) -> F.Column:  # the same for rows that repeat page_id and payload
        made = F.md5(F.concat_ws(":", page.cast("string"), "payload_digest").cast("binary"))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(made, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("urn:unknown"))
    page = F.url_encode(F.col("page_id").cast("string"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    head = F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Page-ID", page),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, line("WARC-Refers-To", name(F.col("refers_to")))),
        F.when(revisit, line("Refers-To-Page-ID", F.url_encode(F.col("refers_to").cast("string")))),
        line("Payload-Length", F.col("payload_bytes")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.when(revisit, 0).otherwise(F.col("payload_bytes")) + len(HTTP_HEADER)),
    )
    return F.concat(head, F.lit(END + HTTP_HEADER), F.when(revisit, F.lit("")).otherwise(F.col("payload")))


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z", file_records: int = FILE_RECORDS
) -> None:
    """Writes one record per row of ``pages`` (page_id, url, html) into gzip files below ``folder``, each a single stream.

    See :func:`tag_revisits` for what is a response and what a revisit. Control characters and blanks in a url become
    ``%20``, a null url ``urn:unknown``; a null page_id leaves its header out. Other columns are left out. An empty table
    gives files without records. Spark's text writer makes the files, so ``folder`` can be in any store that it reaches.
    """
    rows = tag_revisits(pages, least_bytes).select(_record(date).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", file_records).text(folder)


# ---------------------------------------------------------------- normalising


class Inflated:
    """The bytes inside a gzip file of one or more members, read in order."""

    def __init__(self, source, name: str) -> None:
        self.source, self.name = source, name
        self.member = zlib.decompressobj(31)
        self.begun = self.ended = False
        self.packed = b""
        self.ready = bytearray()

    def _more(self) -> bool:
        if self.ended:
            return False
        if not self.packed:
            self.packed = self.source.read(CHUNK)
        if not self.packed:
            if self.begun and not self.member.eof:
                raise ValueError(f"{self.name}: the gzip stream breaks off")
            self.ended = True
            return False
        if self.member.eof:
            self.member = zlib.decompressobj(31)
        self.begun = True
        try:
            self.ready += self.member.decompress(self.packed, CHUNK)
        except zlib.error as e:
            raise ValueError(f"{self.name}: not a gzip stream: {e}") from None
        self.packed = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        return True

    def until(self, mark: bytes, most: int) -> bytes | None:
        """The bytes through ``mark``; None at the end of the file."""
        searched = 0
        while (at := self.ready.find(mark, searched)) < 0:
            searched = max(0, len(self.ready) - len(mark) + 1)
            if len(self.ready) > most:
                raise ValueError(f"{self.name}: a header of more than {most} bytes")
            if not self._more():
                if self.ready:
                    raise ValueError(f"{self.name}: the last record breaks off")
                return None
        found = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.ready and not self._more():
                raise ValueError(f"{self.name}: the last record breaks off")
            piece = bytes(self.ready[:n])
            del self.ready[:n]
            n -= len(piece)
            if piece:
                yield piece


def parse_header(head: bytes, name: str) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"{name}: a record begins with {first[:40]!r}")
    fields = (line.partition(":") for line in lines)
    return {key.strip().lower(): value.strip() for key, _, value in fields}


class _Payload:
    """Digest and size of what follows the HTTP header of a block that comes in pieces."""

    def __init__(self) -> None:
        self.sha1, self.size, self.head = hashlib.sha1(), 0, b""
        self.inside = False

    def add(self, piece: bytes) -> bytes:
        """The part of ``piece`` that belongs to the payload."""
        if not self.inside:
            self.head += piece
            at = self.head.find(b"\r\n\r\n")
            if at < 0:
                return b""
            piece, self.inside = self.head[at + 4 :], True
            self.head = self.head[:at]
        self.sha1.update(piece)
        self.size += len(piece)
        return piece


def _checked(fields: dict[str, str], payload: _Payload, name: str) -> tuple[str, int]:
    """Digest and size of the full payload. A stored payload has to agree with its header."""
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if fields.get("warc-type") == "revisit":
        return digest, int(fields.get("payload-length", 0))
    found = payload.sha1.hexdigest()
    if digest and re.fullmatch("[0-9a-f]{40}", digest) and digest != found:
        raise ValueError(f"{name}: record {fields.get('warc-record-id')} has payload {found}, not {digest}")
    return found, payload.size


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def normalise_file(source: str, target: str) -> tuple[int, int]:
    """Rewrites the archive ``source`` as ``target``, a member per record, and writes ``target``'s index to ``target.idx``
    beside it. Returns records and bytes. Both files appear under their names when they are whole."""
    fs, path = _file_system(source)
    to, out_path = _file_system(target)
    attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
    part = f".attempt-{attempt}"
    offset = records = 0
    archive = out_path.rsplit("/", 1)[-1]
    # a name that begins with a dot is no file of a table to Spark
    hidden = lambda p: p.rsplit("/", 1)[0] + "/." + p.rsplit("/", 1)[1] + part
    with (
        fs.open_input_stream(path, compression=None) as packed,
        to.open_output_stream(hidden(out_path), compression=None) as out,
        to.open_output_stream(hidden(out_path + ".idx"), compression=None) as index,
    ):
        stream = Inflated(packed, path)
        while (head := stream.until(b"\r\n\r\n", HEADER_BYTES)) is not None:
            fields = parse_header(head, path)
            member, payload = zlib.compressobj(6, zlib.DEFLATED, 31), _Payload()
            length = out.write(member.compress(head))
            for piece in stream.take(int(fields["content-length"])):
                payload.add(piece)
                length += out.write(member.compress(piece))
            if b"".join(stream.take(4)) != b"\r\n\r\n":
                raise ValueError(f"{path}: record {records} is not closed by two line ends")
            length += out.write(member.compress(b"\r\n\r\n") + member.flush())
            digest, size = _checked(fields, payload, path)
            line = (archive, offset, length, fields.get("warc-type", ""), fields.get("warc-page-id", ""), size, digest)
            index.write(("\t".join([*map(str, line), fields.get("refers-to-page-id", "")]) + "\n").encode())
            offset += length
            records += 1
    to.move(hidden(out_path), out_path)
    to.move(hidden(out_path + ".idx"), out_path + ".idx")
    return records, offset


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites every ``.gz`` archive below ``source`` into the folder ``target`` and returns file, records, bytes of each.

    A gzip stream can only be read from its start, so a file is one task; its memory is a few chunks, whatever the file
    and its records hold. Input files may have one member or many. The work is done once, before this returns. Names in
    ``target`` are those of ``source``, which have to differ. A broken stream, an unclosed record or a payload that is not
    that of its digest raises an error that names the file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(source).select("path")
    fs, path = _file_system(target)
    fs.create_dir(path, recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                name = file.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt").removesuffix(".warc") + ".warc.gz"
                records, size = normalise_file(file, f"{target}/{name}")
                yield pa.RecordBatch.from_pylist([{"file": name, "records": records, "bytes": size}])

    # one file a task: a file may take long
    dealt = files.repartition(max(1, min(files.count(), 100_000)), F.xxhash64("path"))
    return cut(map_arrow(dealt, work, "file string, records long, bytes long"), "warc-files")


# ---------------------------------------------------------------- reading


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecars of a normalised folder: archive, offset, length, record_type, page_id (as text), payload_bytes,
    payload_digest, refers_to (as text); one row per record."""
    rows = spark.read.option("sep", "\t").option("quote", "").option("pathGlobFilter", "*.idx").schema(_INDEX_SCHEMA).csv(folder)
    decode = lambda c: F.url_decode(F.col(c)).alias(c)
    return rows.select(*[decode(c) if c in ("page_id", "refers_to") else F.col(c) for c in _INDEX])


def read_archives(index: DataFrame, folder: str, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """The records that ``index`` names, each read at its own offset: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, on request, payload (null for a revisit).

    Any part of an index will do. Digest and size are taken from the payload as read; one that is not that of its header is
    an error. Every file is opened once for rows that follow each other. Batches are handed on at ``BATCH_BYTES``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name, held, size = None, None, [], 0
        schema = pa.schema([
            ("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
        ])
        try:
            for batch in batches:
                places = zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)
                for archive, offset, length in places:
                    if archive != name:
                        if opened is not None:
                            opened.close()
                        fs, path = _file_system(f"{folder}/{archive}")
                        opened, name = fs.open_input_file(path), archive
                    opened.seek(offset)
                    whole = zlib.decompressobj(31).decompress(opened.read(length))
                    at = whole.find(b"\r\n\r\n") + 4
                    fields = parse_header(whole[:at], archive)
                    payload = _Payload()
                    body = payload.add(whole[at : at + int(fields["content-length"])])
                    digest, n = _checked(fields, payload, archive)
                    kind, ref = fields["warc-type"], fields.get("refers-to-page-id")
                    page = fields.get("warc-page-id")
                    held.append({
                        "page_id": page and urllib.parse.unquote_plus(page), "url": fields.get("warc-target-uri"),
                        "payload_bytes": n, "payload_digest": digest, "record_type": kind,
                        "refers_to": ref and urllib.parse.unquote_plus(ref),
                        "payload": body if with_payload and kind == "response" else None,
                    })
                    size += len(body) if with_payload else 100
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)
        finally:
            if opened is not None:
                opened.close()

    rows = map_arrow(
        index.select("archive", "offset", "length"), work,
        "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary",
    )
    typed = [F.col(c).cast(id_type).alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in rows.columns]
    return rows.select(*[c for c, n in zip(typed, rows.columns, strict=True) if with_payload or n != "payload"])


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row of ``pages``, as read back from archives
    that were written, normalised and indexed in the shared folder. Nulls, ties and repeated rows: :func:`tag_revisits`."""
    spark = pages.sparkSession
    root = shared_folder(spark, "warc")
    write_archives(pages, f"{root}/whole", least_bytes)
    normalise(spark, f"{root}/whole", f"{root}/members")
    rows = read_archives(read_index(spark, f"{root}/members"), f"{root}/members", dict(pages.dtypes)["page_id"], with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The round trip as DuckDB SQL.
ROUND_TRIP_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') h, octet_length(encode(coalesce(html, ''))) n FROM pages),
d AS (SELECT page_id, CAST(n AS BIGINT) n, sha1(h) s, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END top FROM p)
SELECT page_id, n payload_bytes, s payload_digest,
  CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END refers_to
FROM d
"""
