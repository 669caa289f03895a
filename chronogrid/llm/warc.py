"""WARC archives in Zstandard: written in parallel, read back record by record.

An archive (``.warc.zst``) begins with a skippable frame that holds the dictionary;
every record is a frame of its own, compressed with that dictionary.  Tasks write
archives of bounded size to the shared folder under names of their own and report
them; only reported archives are read, so a task that is lost or repeated leaves
nothing in the result.  Spark lists and reads the archives as binary files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import salted_join
from .registry import register

#: Fixed values of the formats: the dictionary's skippable frame, a dictionary, a frame.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
#: The dictionary is trained on this many payloads (those of the smallest hashes) and cut of each.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8192, 32 * 1024
#: An archive is closed beyond this size, so one fits a task's memory.
ARCHIVE_BYTES = 8 * 1024 * 1024
LEVEL = 3

RECORDS = ("record_id string, record_type string, page_id long, url string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


class WarcError(ValueError):
    """An archive breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def one_line(value: str | None) -> str:
    """A header's value: no line ends."""
    return " ".join((value or "").split())


def encode_record(kind: str, page_id: int | None, url: str | None, payload: bytes, sha1: str, length: int,
                  refers_to: int | None) -> bytes:
    """One record: its header, and an HTTP response block whose body a revisit leaves out."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    if kind == "response":
        block += payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Target-URI", one_line(url)),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{sha1}"),
            ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(lines: bytes, encoding: str = "utf-8") -> dict[str, str]:
    """Header fields by lower-case name; the values of a repeated one stand in order, one a line.

    A line that begins with a blank goes on with the one before."""
    found: dict[str, str] = {}
    name = ""
    for line in lines.split(b"\r\n"):
        text = line.decode(encoding)
        if text[:1] in (" ", "\t") and name:
            found[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise WarcError(f"bad header line: {line[:80]!r}")
        found[name] = f"{found[name]}\n{value.strip()}" if name in found else value.strip()
    return found


def whole_number(value: str, what: str) -> int:
    """A length; repeated equal values are one."""
    values = set(value.split("\n"))
    if len(values) != 1 or not (only := values.pop()).isdecimal():
        raise WarcError(f"{what} is no number: {value[:40]!r}")
    return int(only)


def unchunked(body: bytes) -> bytes:
    """A body without its chunked transfer coding (as it is, if it isn't coded)."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body
        if not size:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size
    return body


def page_number(urn: str | None) -> int | None:
    """The page's id in a record id that ``record_id`` made; other archives' ids have none."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def decode_record(raw: bytes) -> dict:
    """The fields of one record; its headers, lengths and digests are validated.

    Responses and revisits carry an HTTP message, whose body is the payload (its length is
    held against Content-Length where there is one, and its SHA-1 against the announced
    digest, with or without a chunked transfer coding).  Records of other types (warcinfo,
    request, metadata, resource ...) come back as such, their block as the payload."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError("a record doesn't begin with a WARC header")
    h = headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in h:
            raise WarcError(f"a record lacks {name}")
    me, kind, length = h["warc-record-id"], h["warc-type"], whole_number(h["content-length"], "Content-Length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"{me}: {len(rest) - 4} bytes of block, {length} announced")
    block = rest[:length]

    def differs(announced: str, *bodies: bytes) -> bool:
        """Whether an announced SHA-1 (base32) is that of none of the bodies; other algorithms aren't looked at."""
        return announced.startswith("sha1:") and announced.removeprefix("sha1:").upper() not in map(digest, bodies)
    if differs(h.get("warc-block-digest", ""), block):
        raise WarcError(f"{me}: the block's digest differs")
    announced, payload, size = h.get("warc-payload-digest", ""), block, length
    http_kind = h.get("content-type", "application/http").lower().startswith("application/http")
    if kind in ("response", "revisit") and http_kind:
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap or not http.startswith(b"HTTP/"):
            raise WarcError(f"{me}: no HTTP header in the block")
        fields = http.partition(b"\r\n")[2]
        message = headers(fields, "latin-1") if fields else {}
        size = whole_number(message["content-length"], "HTTP Content-Length") if "content-length" in message else len(payload)
        if kind == "response":
            bodies = (payload, unchunked(payload)) if "chunked" in message.get("transfer-encoding", "").lower() else (payload,)
            if "warc-truncated" not in h and (size not in map(len, bodies) or differs(announced, *bodies)):
                raise WarcError(f"{me}: the payload's length or digest differs")
        elif payload and "warc-truncated" not in h:
            raise WarcError(f"{me}: a revisit has a payload")
    if kind == "revisit" and not ({"warc-refers-to", "warc-refers-to-target-uri"} & h.keys()):
        raise WarcError(f"{me}: a revisit refers to nothing")
    return {"record_id": me, "record_type": kind, "page_id": page_number(me), "url": h.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": announced.removeprefix("sha1:"), "refers_to": page_number(h.get("warc-refers-to")),
            "payload": None if kind == "revisit" else payload}


def dictionary_frame(content: bytes) -> bytes:
    """The leading skippable frame; an empty dictionary is allowed."""
    return struct.pack("<II", DICTIONARY_FRAME, len(content)) + content


def load_dictionary(raw: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading frame, itself plain or compressed, and where the records begin."""
    if len(raw) < 8 or struct.unpack_from("<I", raw)[0] != DICTIONARY_FRAME:
        raise WarcError("the archive doesn't begin with a dictionary frame")
    size = struct.unpack_from("<I", raw, 4)[0]
    content = raw[8:8 + size]
    if len(content) != size:
        raise WarcError("the dictionary frame is cut off")
    if content.startswith(FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    if content and struct.unpack_from("<I", content)[0] != DICTIONARY_MAGIC:
        raise WarcError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(content) if content else None, 8 + size


def read_archive(raw: bytes) -> Iterator[dict]:
    """The records of an archive, one per frame."""
    dictionary, at = load_dictionary(raw)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(raw)
    while at < len(raw):
        if bytes(view[at:at + 4]) != FRAME_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        frame, parts = reader.decompressobj(), []
        step = 1 << 16
        while not frame.eof:
            if at >= len(raw):
                raise WarcError("the last frame is cut off")
            parts.append(frame.decompress(view[at:at + step]))
            at += min(step, len(raw) - at)
        at -= len(frame.unused_data)
        yield decode_record(b"".join(parts))


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or none where the samples are too few or too small to train on."""
    if sum(map(len, samples)) < 8 * size or len(samples) < 16:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_archives(records: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Writes ``record_type, page_id, url, payload, payload_digest, payload_bytes, refers_to``.

    Returns the archives written (``path, n_records, bytes``): one row each, from
    which the work starts when an action asks for it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(folder)
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if d:
            d.precompute_compress(level=LEVEL)
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=True)
        out, n = io.BytesIO(), 0

        def close() -> pa.RecordBatch:
            name = f"part-{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{at}/{name}", compression=None) as f:
                f.write(out.getbuffer())
            return pa.RecordBatch.from_pydict({"name": [name], "n_records": [n], "bytes": [out.tell()]})

        for batch in batches:
            for r in batch.to_pylist():
                if not n:
                    out.write(dictionary_frame(dictionary))
                out.write(coder.compress(encode_record(r["record_type"], r["page_id"], r["url"], r["payload"] or b"",
                                                       r["payload_digest"], r["payload_bytes"], r["refers_to"])))
                n += 1
                if out.tell() >= ARCHIVE_BYTES:
                    yield close()
                    out, n = io.BytesIO(), 0
        if n:
            yield close()

    return records.mapInArrow(run, "name string, n_records long, bytes long")


def read_archives(spark: SparkSession, folder: str, written: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives that ``written`` names, one row each.

    Headers, lengths, digests and each archive's number of records are validated;
    an archive that breaks the format raises.  Without ``payloads`` the payload
    column stays empty, after it has been read and validated."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split(" ")[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split(" ")[1]])
                            for f in RECORDS.split(", ")])
        for batch in batches:
            for name, count, content in zip(*(batch.column(c) for c in ("name", "n_records", "content"))):
                rows, size, n = [], 0, 0
                for r in read_archive(content.as_py()):
                    n, size = n + 1, size + len(r["payload"] or b"")
                    rows.append(r if payloads else r | {"payload": None})
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if n != count.as_py():
                    raise WarcError(f"{name}: {n} records, {count} written")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.join(written.select("name", "n_records"), "name").mapInArrow(run, RECORDS).select(*names)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Record type, digest, length and reference of every page; equal payloads meet by digest.

    Of the pages of an equal payload of at least ``min_bytes`` bytes, that of the
    largest id is the response and the others revisit it.  Pages that repeat the
    largest id are all responses, and so are pages without an id in a group that
    has none.  A null html is the empty payload."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    sha1 = F.unhex(F.sha1(payload))
    d = pages.select("page_id", "url", payload.alias("payload"), sha1.alias("sha1"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    # counted from the narrow columns, reduced per task, then only what repeats
    keepers = (pages.select("page_id", sha1.alias("sha1")).groupBy("sha1")
               .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"))
    j = salted_join(d, keepers, ["sha1"], F.xxhash64("page_id"), "left")
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return j.select(F.when(revisit, "revisit").otherwise("response").alias("record_type"), "page_id", "url",
                    F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                    _base32(F.col("sha1")).alias("payload_digest"), F.when(revisit, F.col("keeper")).alias("refers_to"))


def _base32(sha1):
    """RFC 4648 base 32 of 20 bytes: 32 letters of 5 bits, from the hexadecimal digits."""
    digits = F.hex(sha1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for part in range(4):  # 5 bytes are 8 letters
        n = F.conv(F.substring(digits, 10 * part + 1, 10), 16, 10).cast("long")
        out += [F.substring(F.lit(letters), F.shiftright(n, 35 - 5 * k).bitwiseAND(F.lit(31).cast("long")).cast("int") + 1, F.lit(1)) for k in range(8)]
    return F.concat(*out)


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes every page as a record; returns the folder and the archives written."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    # first the smallest hashes alone, then the pages that have them: little reaches the driver from any task
    hashed = pages.where("html IS NOT NULL").select(F.xxhash64("html").alias("h"), F.substring("html", 1, SAMPLE_BYTES).alias("s"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    head = hashed.where(F.col("h") <= (least[-1] if least else 0)).dropDuplicates(["h"]).orderBy("h").collect() if least else []
    dictionary = train_dictionary([r["s"].encode() for r in head])
    log = f"{folder}/written.parquet"
    write_archives(with_revisits(pages), folder, dictionary).write.parquet(log)
    return folder, spark.read.parquet(log)


ORACLE_SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
s AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hx FROM p),
m AS (SELECT hx, max(page_id) AS keeper FROM s GROUP BY hx),
v AS (SELECT s.*, keeper, [CAST('0x' || substr(s.hx, 10 * g + 1, 10) AS BIGINT) FOR g IN [0, 1, 2, 3]] AS q FROM s JOIN m USING (hx))
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((q[1 + i // 8] >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM v"""


@register("op2_warc", ORACLE_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say when they are read back."""
    folder, written = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(spark, folder, written, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
