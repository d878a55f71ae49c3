"""Archives of filings: a source of their members, one planned partition an archive.

``read_members`` lists the files of all arguments once, on the driver, and hands the list to one scan. Each archive is a
partition that opens its file where it lies and reads it as a stream, a member at a time, so an archive may have any size
and ten thousand of them are one node of the plan. The place of an archive among the arguments, the suffix and the list of
accessions are pushed into the reader: a member that is not wanted is skipped before its bytes are read.
"""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MEMBERS = "tar_pos int, tarball string, member_pos int, member_name string, content binary"
SOURCE = "tar_pos int, tarball string, member_pos int, member_name string, matched string, content binary"
#: Entries of a list that are pushed into the reader at most; longer lists are met by ``submissions.match_accessions``.
PUSHED = 200_000
SUFFIX = ".nc"


def plain_name(name: str) -> str:
    """A name without dashes and underscores, which do not count in a match."""
    return name.replace("-", "").replace("_", "")


class Listed:
    """A list of accessions to find in names: by length, so that a name's substrings are looked up, not the list walked through."""

    def __init__(self, accessions: Iterable[str]):
        self.by_length: dict[int, dict[str, tuple[int, str]]] = {}
        for k, a in enumerate(accessions):
            self.by_length.setdefault(len(plain_name(a)), {}).setdefault(plain_name(a), (k, a))

    def first(self, name: str) -> str | None:
        """The accession that is listed first of those that ``name`` holds."""
        text, best = plain_name(name), None
        for n, own in self.by_length.items():
            for k in range(len(text) - n + 1):
                found = own.get(text[k : k + n])
                if found and (best is None or found < best):
                    best = found
        return best[1] if best else None


def members_of(archive: tarfile.TarFile, listed: Listed | None, suffix: str = SUFFIX) -> Iterator[tuple[int, str, str | None, bytes]]:
    """``(member_pos, member_name, matched, content)`` of the regular members that are wanted."""
    for k, m in enumerate(archive):
        archive.members = []  # or all headers of a long archive would be kept
        if not m.isfile() or not m.name.lower().endswith(suffix):
            continue
        matched = listed.first(m.name) if listed else None
        if listed is None or matched is not None:
            yield k, m.name, matched, archive.extractfile(m).read()


def expanded(spark: SparkSession, paths: list[str]) -> list[tuple[int, str]]:
    """``(tar_pos, file)`` of arguments that are files, folders or patterns, files of one argument by name.

    An argument that matches nothing is an error, and so is a folder without files.
    """
    context, out = spark.sparkContext, []
    for k, path in enumerate(paths):
        pattern = context._jvm.org.apache.hadoop.fs.Path(path)
        system = pattern.getFileSystem(context._jsc.hadoopConfiguration())
        files = []
        for status in system.globStatus(pattern) or ():
            inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
            files += [x.getPath().toString() for x in inside if not x.isDirectory() and not x.getPath().getName().startswith(("_", "."))]
        if not files:
            raise FileNotFoundError(f"no archive at {path}")
        out += [(k, f) for f in sorted(files)]
    return out


class ArchivePartition(InputPartition):
    def __init__(self, tar_pos: int, tarball: str):
        self.tar_pos, self.tarball = tar_pos, tarball


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = json.loads(options["files"])
        self.accessions = json.loads(options["accessions"]) if options.get("accessions") else None
        self.suffix = options.get("suffix", SUFFIX)

    def partitions(self) -> list[InputPartition]:
        return [ArchivePartition(k, name) for k, name in self.files]

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        listed = Listed(self.accessions) if self.accessions is not None else None
        files, name = fs.FileSystem.from_uri(partition.tarball)
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.binary())
        names = [c.split()[0] for c in SOURCE.split(", ")]
        with files.open_input_stream(name, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as archive:
            for member in members_of(archive, listed, self.suffix):
                values = (partition.tar_pos, partition.tarball, *member)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)


class ArchiveSource(DataSource):
    """``spark.read.format("exhibita_archive")``; ``read_members`` sets its options."""

    @classmethod
    def name(cls) -> str:
        return "exhibita_archive"

    def schema(self) -> str:
        return SOURCE

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_members(spark: SparkSession, paths: list[str], accessions: list[str] | None = None, suffix: str = SUFFIX) -> DataFrame:
    """``(tar_pos, tarball, member_pos, member_name, matched, content)`` of archives, whatever their compression.

    With a list, only members whose names hold one of its accessions are read, and ``matched`` is the one listed first;
    a list without entries, or one of more than ``PUSHED``, is an error. Without a list all members are read and
    ``matched`` is null. An argument that does not exist is an error. ``tar_pos`` is an archive's place among the arguments.
    """
    if accessions is not None and not accessions:
        raise ValueError("the list has no accessions")
    if accessions is not None and len(accessions) > PUSHED:
        raise ValueError(f"more than {PUSHED} accessions: read all members and use match_accessions")
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(ArchiveSource.name()).option("files", json.dumps(expanded(spark, paths))).option("suffix", suffix)
    return (reader if accessions is None else reader.option("accessions", json.dumps(accessions))).load()


def archives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(tar_pos, tarball, content)`` of archive files as values of 2 GB at most, in one scan; see ``expanded``."""
    files = expanded(spark, paths)
    known = spark.createDataFrame(files, "tar_pos int, tarball string")
    found = spark.read.format("binaryFile").load([name for _, name in dict.fromkeys(files)] if files else [])
    return known.join(found.select(F.col("path").alias("tarball"), "content"), "tarball").select("tar_pos", "tarball", "content")


def members(found: DataFrame, accessions: list[str] | None = None, suffix: str = SUFFIX) -> DataFrame:
    """``MEMBERS`` of archives that are values ``(tarball, content)``, with or without ``tar_pos``; see ``read_members``.

    Rows are dealt out anew, since one archive is one task's work.
    """
    listed = Listed(accessions) if accessions else None
    names = [c.split()[0] for c in MEMBERS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tar_pos, name, content in zip(batch.column("tar_pos").to_pylist(), batch.column("tarball").to_pylist(), batch.column("content"), strict=True):
                with tarfile.open(fileobj=pa.BufferReader(content.as_buffer()), mode="r:*") as archive:
                    for pos, member, _, data in members_of(archive, listed, suffix):
                        values = (tar_pos, name, pos, member, data)
                        kinds = (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

    rows = found if "tar_pos" in found.columns else found.withColumn("tar_pos", F.lit(0))
    return rows.select("tar_pos", "tarball", "content").mapInArrow(read, MEMBERS).repartition("tarball", "member_pos")
