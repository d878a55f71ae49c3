"""A content-addressed web archive: payload bytes stored once, exact record headers apart, records rebuilt by joins.

An archive is a folder of two tables. ``headers`` has a row for each record: everything up to its payload, byte for byte
(the WARC header and the HTTP header), and the SHA-256 of the payload that belongs behind it, null where the record has
none. ``payloads`` has each different payload once under that digest. ``restore`` joins them to the original records;
it works out each payload's digest anew, so bytes that have changed on disk are an error and never a wrong record.

``page_records`` makes the records of a table of pages. Which record is the first of its payload is settled on digests
and ids alone; payload bytes never meet at one key. ``write_warc`` and ``read_warc`` exchange records with plain or
gzipped WARC files.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import Scratch, named, table, written

#: Payloads of at least so many bytes are stored by one response; the others with the same payload revisit it.
LEAST_BYTES = 0
#: The date that records bear unless another is given.
DATE = "2000-01-01T00:00:00Z"
#: Rows that are broadcast at most, some 150 bytes each.
BROADCAST_ROWS = 200_000
#: Digests that a task remembers at once.
REMEMBERED = 500_000
END = "\r\n\r\n"
_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: What tells the rows of ``digested`` apart.
_ROW = ("id", "url", "sha256")


def base32(hexadecimal: Column) -> Column:
    """Forty hex digits as bare upper-case base32: five digits are four letters. The digits are worked out once."""

    def four(number: Column) -> Column:
        letter = lambda shift: F.substring(F.lit(_BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1))
        return F.concat(*map(letter, (15, 10, 5, 0)))

    numbers = lambda digits: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.conv(F.substring(digits, k * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    return F.array_join(F.transform(let(hexadecimal, numbers), four), "")


def digested(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(id, url, payload, sha256, sha1, bytes)``: the pages' payloads in UTF-8, null ones empty, with their digests."""
    payload = F.coalesce(named(html).cast("binary"), F.lit(bytearray()))
    rows = pages.select(named(id).alias("id"), named(url).cast("string").alias("url"), payload.alias("payload"))
    return rows.select("*", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.length("payload").cast("long").alias("bytes"))


def decided(rows: DataFrame) -> DataFrame:
    """``(id, url, sha256, sha1, bytes, n, first, alone)`` for each different row of ``digested``: how often it stands there,
    the ``struct(id, url)`` that comes first of all with its payload, and whether it is that one itself.

    Payloads are equal if both digests and the lengths are. Null ids come after all others. Digests are counted before
    they are shuffled, so a payload that a third of all pages share is no burden.
    """
    own = rows.groupBy(*_ROW, "sha1", "bytes").agg(F.count("*").alias("n"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("url").isNull().alias("bare"), "url")
    shared = own.groupBy("sha256", "sha1", "bytes").agg(F.min(order).alias("f"), F.count("*").alias("m")).where("m > 1")
    shared = shared.select("sha256", "sha1", "bytes", F.struct("f.id", "f.url").alias("f"))
    both = own.join(shared, ["sha256", "sha1", "bytes"], "left")
    first = F.coalesce("f", F.struct("id", "url"))
    return both.select(*_ROW, "sha1", "bytes", "n", first.alias("first"), (first["id"].eqNullSafe(F.col("id")) & first["url"].eqNullSafe(F.col("url"))).alias("alone"))


def record_id(id: Column, url: Column, sha256: Column, copy: Column) -> Column:
    """``<urn:page:id:what tells rows with one id apart:copy>``."""
    rest = F.md5(F.concat(F.coalesce(url, F.lit("\n")), F.lit("\n"), sha256).cast("binary"))
    own = F.coalesce(F.concat(F.lit("="), F.url_encode(id.cast("string"))), F.lit(""))
    return F.concat(F.lit("<urn:page:"), own, F.lit(":"), rest, F.lit(":"), copy.cast("string"), F.lit(">"))


def page_of(record: Column) -> Column:
    """The id, as text, of the page that a record id was made for."""
    found = F.regexp_extract(record, "^<urn:page:([^:]*):", 1)
    return F.when(F.startswith(found, F.lit("=")), F.url_decode(F.substring(found, F.lit(2), F.length(found))))


def page_records(found: DataFrame, least: int = LEAST_BYTES, date: str = DATE) -> DataFrame:
    """The headers ``(record_id, header, sha256)`` of ``decided`` pages: a record for each row, repeated rows included.

    Of records with equal payloads of at least ``least`` bytes that with the smallest id (then URL) is the response, and
    the others revisit it; smaller payloads are all responses. Control characters and blanks of a URL are escaped, as
    URLs demand; a null URL gives no target.
    """
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    is_first = F.col("alone") & (F.col("copy") == 1) | (F.col("bytes") < least)
    own = record_id(F.col("id"), F.col("url"), F.col("sha256"), F.col("copy"))
    other = record_id(F.col("first.id"), F.col("first.url"), F.col("sha256"), F.lit(1))
    escaped = lambda c: F.regexp_replace(F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(is_first, F.col("bytes")).otherwise(0)
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(is_first, "response").otherwise("revisit")),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", escaped(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(~is_first, F.concat(line("WARC-Refers-To", other), line("WARC-Profile", F.lit(_PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    )
    return rows.select(own.alias("record_id"), header.cast("binary").alias("header"), F.when(is_first, F.col("sha256")).alias("sha256"))


def _once(rows: DataFrame) -> DataFrame:
    """``(sha256, payload)`` with each payload once; each task lets one of its copies through, so that few are shuffled."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            keep = []
            for key in batch.column("sha256").to_pylist():
                keep.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))
            if len(seen) > REMEMBERED:
                seen.clear()

    return rows.select("sha256", "payload").mapInArrow(local, "sha256 string, payload binary").dropDuplicates(["sha256"])


def payloads(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(sha256, payload)`` of ``digested`` rows, each payload once: that of the row that comes first in ``decided``.

    Only the rows that do not come first are sent to the pages, as keys, and they are broadcast where they are few;
    payloads move where they are many, each by its own row's key, or where rows are repeated.
    """
    others = found.where("NOT alone").select(*_ROW)
    few = others.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    others = others.select(*[F.col(c).alias(f"_{c}") for c in _ROW])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ROW]
    kept = rows.join(F.broadcast(others) if few else others, same[0] & same[1] & same[2], "left_anti").select("sha256", "payload")
    return kept if found.where("alone AND n > 1").isEmpty() else _once(kept)


def store(headers: DataFrame, bodies: DataFrame, path: str) -> None:
    """Writes an archive of ``(record_id, header, sha256)`` and ``(sha256, payload)``, which has each payload once."""
    headers.select("record_id", "header", "sha256").write.parquet(f"{path}/headers")
    bodies.select("sha256", "payload").write.parquet(f"{path}/payloads")


def archive_pages(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES) -> None:
    """Writes the archive of a table of pages, a record for each row.

    Null texts have the empty payload. Null ids are ids of their own, the last in order; null URLs have no target. Rows
    that repeat are records of their own, of which the first is the response. An empty table gives an empty archive;
    further columns, whatever their names, are left out.
    """
    rows = digested(pages, id, url, html)
    with Scratch(pages.sparkSession) as scratch:
        found = scratch.written(decided(rows.drop("payload")))
        store(page_records(found, least), payloads(rows, found), path)


def restore(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, record)``: the archive's records as they were, each with the two line ends that close it.

    A payload that has not the digest it is stored under, or that is missing, is an error.
    """
    headers = spark.read.parquet(f"{path}/headers")
    bodies = spark.read.parquet(f"{path}/payloads")
    right = F.sha2("payload", 256) == F.col("sha256")
    wrong = F.raise_error(F.concat(F.lit("the payload has changed: "), F.col("sha256"))).cast("binary")
    bodies = bodies.select("sha256", F.when(right, F.col("payload")).otherwise(wrong).alias("payload"))
    lost = F.raise_error(F.concat(F.lit("the payload is missing: "), F.col("sha256"))).cast("binary")
    whole = headers.where("sha256 IS NOT NULL").join(bodies, "sha256", "left")
    whole = whole.select("record_id", F.concat("header", F.coalesce("payload", lost), F.lit(END.encode()).cast("binary")).alias("record"))
    bare = headers.where("sha256 IS NULL").select("record_id", F.concat("header", F.lit(END.encode()).cast("binary")).alias("record"))
    return whole.union(bare)


def _field(head: Column, name: str) -> Column:
    """A header's value, null where it has none."""
    pattern = rf"(?im)^{name}:[ \t]*([^\r\n]*)"
    return F.when(head.rlike(pattern), F.regexp_extract(head, pattern, 1))


def parsed(records: DataFrame) -> DataFrame:
    """``(record_id, record_type, refers_to, digest, payload)`` of HTTP records, taken from their bytes alone."""
    end = F.lit(END)
    rows = records.select("record", F.substring_index(F.col("record").cast("string"), END, 1).alias("head"))
    size = _field(F.col("head"), "Content-Length").cast("int")
    rows = rows.withColumn("block", F.substring("record", F.octet_length("head") + F.length(end) + 1, size)).drop("record")
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    rows = rows.select("head", F.substring("block", F.octet_length(http) + F.length(end) + 1, F.octet_length("block")).alias("payload"))
    fields = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "refers_to": "WARC-Refers-To", "digest": "WARC-Payload-Digest"}
    return rows.select(*[_field(F.col("head"), name).alias(c) for c, name in fields.items()], "payload")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page, payload_bytes, payload_digest, record_type, refers_to)`` of an archive of pages, ids as text.

    Length and digest of a response are those of its payload as read; a digest that differs from the header's is an
    error. A revisit has them from the response that it refers to.
    """
    rows = parsed(restore(spark, path))
    wrong = F.raise_error(F.concat(F.lit("the payload has another digest than its header says: "), F.col("record_id")))
    real = lambda own: F.when(F.col("record_type") != "response", F.lit(None)).when(F.col("digest") == F.concat(F.lit("sha1:"), own), own).otherwise(wrong)
    checked = let(base32(F.sha1("payload")), real).alias("payload_digest")
    # without payloads the rows are small; they are needed twice
    rows = written(rows.select("record_id", "record_type", "refers_to", checked, F.length("payload").cast("long").alias("payload_bytes")))
    full = rows.where("record_type = 'response'")
    revisits = rows.where("record_type = 'revisit'").select("record_id", "record_type", "refers_to")
    revisits = revisits.join(full.select(F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes"), "refers_to", "left")
    columns = (page_of(F.col("record_id")).alias("page"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))
    return full.select(*columns).union(revisits.select(*columns))


# ---- WARC files ----


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records ``(record)`` as WARC files, a file for each partition; ``compression`` is ``gzip`` or ``none``."""
    size = F.octet_length("record") - len(END)
    rows = records.select(F.substring("record", F.lit(1), size).cast("string").alias("value"))
    rows.write.option("lineSep", END).option("compression", compression).text(path)


_LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)", re.I | re.M)
_ID = re.compile(rb"^warc-record-id:[ \t]*([^\r\n]*)", re.I | re.M)
_HTTP = re.compile(rb"^content-type:[ \t]*application/http", re.I | re.M)


def _records_of(data: bytes) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Record id, everything before the payload, and the payload, of each record of a file."""
    stream = io.BytesIO(data)
    source = gzip.GzipFile(fileobj=stream) if data[:2] == b"\x1f\x8b" else stream
    while True:
        head = line = source.readline()
        if not line:
            return
        while line not in (b"\r\n", b"\n", b""):
            line = source.readline()
            head += line
        length = _LENGTH.search(head)
        if not length:
            raise ValueError("a record has no Content-Length")
        block, end = source.read(int(length[1])), source.read(len(END))
        if len(block) < int(length[1]) or end != END.encode():
            raise ValueError("a record is cut off")
        at = block.find(END.encode()) + len(END) if _HTTP.search(head) and END.encode() in block else 0
        yield (m[1] if (m := _ID.search(head)) else b""), head + block[:at], block[at:]


def read_warc(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, pos, record_id, header, payload)`` of WARC files, plain or gzipped; a record that is cut off is an error.

    A file is one task's work and has 2 GB at most.
    """
    names = ["file", "pos", "record_id", "header", "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for pos, (own, header, payload) in enumerate(_records_of(data.as_py())):
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary())
                    values = (name, pos, own.decode("utf-8", "replace"), header, payload)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(read, "file string, pos long, record_id string, header binary, payload binary")


def archive_warc(spark: SparkSession, paths: list[str], path: str) -> None:
    """Archives the records of WARC files, headers byte for byte, equal payloads once. Records without a payload have none."""
    rows = read_warc(spark, paths)
    sha = F.when(F.length("payload") > 0, F.sha2("payload", 256))
    rows = rows.select("record_id", "header", "payload", sha.alias("sha256"))
    store(rows, _once(rows.where("sha256 IS NOT NULL")), path)


def op12_warc(spark, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record and read back."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    with Scratch(spark) as scratch:
        archive_pages(pages, scratch.path)
        found = read_pages(spark, scratch.path)
    return found.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def _oracle() -> str:
    letter = lambda shift: f"substr('{_BASE32}', CAST(v // {1 << shift} % 32 AS INT) + 1, 1)"
    four = f"list_transform(list_transform(range(8), lambda i: CAST('0x' || substr(sha1(encode(p)), CAST(5 * i + 1 AS INT), 5) AS BIGINT)), lambda v: {' || '.join(map(letter, (15, 10, 5, 0)))})"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS p FROM pages
), d AS (SELECT page_id, p, row_number() OVER (PARTITION BY p ORDER BY page_id NULLS LAST, url NULLS LAST) AS place,
         first(page_id) OVER (PARTITION BY p ORDER BY page_id NULLS LAST, url NULLS LAST) AS low FROM p)
SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes, array_to_string({four}, '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN low END AS refers_to FROM d
"""


ORACLE = _oracle()
