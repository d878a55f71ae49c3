"""Filing submissions: the texts of archive members, their SGML headers and documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.names import spare
from ..functions.text import LINE_END, safe_item_id, strip

_LINE = LINE_END.replace(r"\r\n|", "")
#: The order in which members are read: archives as they were given, files of one argument by name.
READ_ORDER = ("tar_pos", "tarball", "member_pos")


#: Rows that are decoded at once.
SLICE = 256


def decode_lossy(df: DataFrame, content: str = "content", text: str = "text") -> DataFrame:
    """``df`` with ``content`` as UTF-8 ``text``, undecodable bytes dropped; a worker holds the texts of ``SLICE`` rows at once."""
    schema = df.drop(content).withColumn(text, F.lit("")).schema
    rest = [c for c in df.columns if c != content]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, SLICE) for k in range(0, batch.num_rows, SLICE)):
                texts = [None if (b := x.as_py()) is None else b.decode("utf-8", "ignore") for x in part.column(content)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(texts, pa.string())], names=[*rest, text])

    return df.select(*rest, content).mapInArrow(read, schema)


def accession_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(list_pos, accession)`` from lines: trimmed, blank ones dropped, in order. A list without any is an error.

    The position comes from the order of the lines in their files; a list is far smaller than one partition.
    """
    kept = lines.select(F.monotonically_increasing_id().alias("list_pos"), strip(F.col(line)).alias("accession"))
    kept = kept.where("accession <> ''")
    if kept.isEmpty():
        raise ValueError("the list has no accessions")
    return kept


def header_field(text: Column, tag: str) -> Column:
    """The rest of the line after the first ``<tag>`` anywhere, stripped; null where there is none."""
    marker = f"<{tag}>"
    return F.when(F.instr(text, marker) > 0, strip(F.regexp_extract(text, rf"<{tag}>([^\n]*)", 1)))


def with_header(subs: DataFrame, text: str = "text") -> DataFrame:
    """``subs`` with ``accession``, ``cik``, ``form_type`` and ``filing_date``."""
    fields = {"accession": "ACCESSION-NUMBER", "cik": "CIK", "form_type": "TYPE", "filing_date": "FILING-DATE"}
    return subs.withColumns({name: header_field(F.col(text), tag) for name, tag in fields.items()})


def sections(text: Column) -> Column:
    """The documents of a submission: what follows each ``<DOCUMENT>`` up to its end tag, or to the end."""
    parts = F.split(text, "<DOCUMENT>", -1)
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.substring_index(p, "</DOCUMENT>", 1))


def document_field(section: Column, tag: str) -> Column:
    """The rest of the first line that starts with ``<tag>``, stripped; null where there is none."""
    pattern = rf"(?:^|[{_LINE[1:-1]}])<{tag}>([^{_LINE[1:-1]}]*)"
    return F.when(section.rlike(pattern), strip(F.regexp_extract(section, pattern, 1)))


def body(section: Column) -> Column:
    """What stands between the first ``<TEXT>`` and the next ``</TEXT>`` or the end; null without ``<TEXT>``."""
    after = F.split(section, "<TEXT>", 2)
    return F.when(F.instr(section, "<TEXT>") > 0, F.substring_index(F.element_at(after, 2), "</TEXT>", 1))


def documents(subs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each document of each submission: ``pos``, ``type``, ``sequence``, ``filename``, ``content``."""
    rows = subs.select(*[c for c in subs.columns if c != text], F.posexplode(sections(F.col(text))).alias("pos", "section"))
    part = F.col("section")
    return rows.select(
        *[c for c in subs.columns if c != text],
        "pos",
        document_field(part, "TYPE").alias("type"),
        document_field(part, "SEQUENCE").alias("sequence"),
        document_field(part, "FILENAME").alias("filename"),
        body(part).alias("content"),
    )


def documents_of(
    text: Column,
    accession: Column,
    keep: Callable[[Column], Column] | None = None,
    content: bool = True,
) -> Column:
    """A submission's kept documents, worked out inside its row: an array of structs ``DOCUMENT`` in order.

    ``keep`` is a predicate over a document's struct, which may use the row's other columns too; a null counts as false.
    ``ordinal`` numbers the kept documents from 1. An empty or missing sequence becomes the ordinal in two digits, an
    empty or missing file name follows the sequence. The primary document is the one with the lowest integer sequence,
    the first on ties, or the first of all where any sequence is no integer. Without ``content`` bodies are not cut out.
    A null text gives null, a text without documents an empty array.
    """

    def fields(part: Column, pos: Column) -> Column:
        own = {"type": document_field(part, "TYPE"), "sequence": document_field(part, "SEQUENCE"), "filename": document_field(part, "FILENAME")}
        own |= {"content": body(part)} if content else {}
        return F.struct(pos.alias("pos"), *[c.alias(n) for n, c in own.items()])

    def named(d: Column, k: Column) -> Column:
        ordinal = k + 1
        sequence = F.coalesce(F.nullif(d["sequence"], F.lit("")), F.format_string("%02d", ordinal))
        filename = F.coalesce(F.nullif(d["filename"], F.lit("")), F.concat(F.lit("EX-10-"), sequence, F.lit(".html")))
        rest = [d["content"].alias("content")] if content else []
        return F.struct(d["pos"].alias("pos"), ordinal.alias("ordinal"), d["type"].alias("type"), sequence.alias("sequence"), filename.alias("filename"), *rest)

    def marked(docs: Column) -> Column:
        numbers = F.transform(docs, lambda d: F.trim(d["sequence"]).try_cast("bigint"))
        whole = F.forall(numbers, lambda n: n.isNotNull())
        first = let(numbers, lambda n: F.when(whole, F.array_position(n, F.array_min(n))).otherwise(1))

        def one(d: Column, at: Column) -> Column:
            item = safe_item_id(accession, d["sequence"], d["ordinal"])
            return F.struct(*[d[c].alias(c) for c in DOCUMENT if c in DOCUMENT[:5] or content and c == "content"], (d["ordinal"] == at).alias("primary"), item.alias("item_id"))

        return let(first, lambda at: F.transform(docs, lambda d: one(d, at)))

    found = F.transform(sections(text), fields)
    if keep is not None:
        found = F.filter(found, lambda d: F.coalesce(keep(d), F.lit(False)))
    return let(F.transform(found, named), marked)


#: The fields of a kept document.
DOCUMENT = ("pos", "ordinal", "type", "sequence", "filename", "content", "primary", "item_id")


def with_documents(subs: DataFrame, keep: Callable[[Column], Column] | None = None, text: str = "text", accession: str = "accession", content: bool = True) -> DataFrame:
    """``subs`` with ``documents`` in place of ``text``, see ``documents_of``; submissions without a kept document go.

    Nothing is shuffled and no key is needed, so submissions that repeat or have no key of their own stay apart.
    """
    # worked out once, in the explode; a filter on it would work it out again
    found = F.filter(F.array(documents_of(F.col(text), F.col(accession), keep, content)), lambda d: F.size(d) > 0)
    rest = [c for c in subs.columns if c not in (text, "documents")]
    return subs.select(*rest, F.explode(found).alias("documents"))


def flat(subs: DataFrame, documents: str = "documents") -> DataFrame:
    """A row for each of the nested documents, in order, with the submission's columns beside the document's."""
    kinds = subs.schema[documents].dataType.elementType.names
    rest = [c for c in subs.columns if c != documents and c not in kinds]
    (one,) = spare(subs, "_document")
    rows = subs.select(*rest, F.explode(documents).alias(one))
    return rows.select(*rest, *[F.col(one)[c].alias(c) for c in kinds])


def plain(name: Column) -> Column:
    """A name without dashes and underscores, which do not count in a match."""
    return F.translate(name, "-_", "")


def match_accessions(found: DataFrame, accessions: DataFrame | None, name: str = "member_name") -> DataFrame:
    """``found`` with ``matched``: the first accession of ``(list_pos, accession)`` that ``name`` holds.

    Dashes and underscores do not count. Rows without a match go, those with a null name too. Without a list (None) all
    rows stay with a null match; a list without entries is an error, so that a list gone wrong does not let everything
    pass.

    An entry can only be found as a substring of its own length. So each name is cut into its substrings of the lengths
    that the list has, these meet the list in an equality join, and the entry that is listed first is taken. A name costs
    as many rows as it has such substrings, however long the list is, and names are looked up once however often they
    occur; what else the rows hold stays out of it.
    """
    if accessions is None:
        return found.withColumn("matched", F.lit(None).cast("string"))
    found = found.drop("matched")
    key, wanted, cut, entry = spare(found, "_name", "_plain", "_cut", "_entry")
    listed = accessions.select(F.struct("list_pos", "accession").alias(entry), plain(F.col("accession")).alias(wanted)).where(f"{wanted} IS NOT NULL")
    lengths = [r[0] for r in listed.select(F.length(wanted)).distinct().collect()]
    if not lengths:
        raise ValueError("the list has no accessions")
    entries = listed.groupBy(wanted).agg(F.min(entry).alias(entry))

    def windows(text: Column) -> Column:
        last = lambda n: F.length(text) - n
        of = lambda n: F.when(last(n) >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last(n), F.lit(0))), lambda k: F.substring(text, k + 1, F.lit(n))))
        return F.array_distinct(F.flatten(F.filter(F.array(*[of(n) for n in lengths]), lambda w: w.isNotNull())))

    names = found.select(F.col(name).alias(key)).distinct()
    names = names.select(key, F.explode(let(plain(F.col(key)), windows)).alias(cut))
    first = names.join(entries, F.col(cut) == F.col(wanted)).groupBy(key).agg(F.min(entry).alias(entry))
    rows = found.join(first.select(F.col(key), F.col(entry)["accession"].alias("matched")), F.col(name) == F.col(key))
    return rows.drop(key)


def resolve_accessions(subs: DataFrame, own: str = "accession", matched: str = "matched") -> DataFrame:
    """``subs`` with ``own`` filled up: the header's accession, else the listed one; submissions with neither go."""
    return subs.withColumn(own, F.coalesce(F.nullif(F.col(own), F.lit("")), F.col(matched))).where(F.col(own).isNotNull())


def doc_type_matches(kind: Column, prefixes: list[str] | None = None, part: str | None = None) -> Column:
    """Whether a type starts with one of ``prefixes`` or holds ``part``, in any case; true without either."""
    if not prefixes and not part:
        return F.lit(True)
    found = F.lit(False)
    for p in prefixes or ():
        found = found | F.startswith(F.upper(kind), F.lit(p.upper()))
    if part:
        found = found | F.contains(F.lower(kind), F.lit(part.lower()))
    return F.coalesce(found, F.lit(False))


def last_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key; aggregates before the shuffle, so a frequent key is no burden."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*")


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key."""
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*")


def items_of(
    found: DataFrame,
    accessions: DataFrame | None = None,
    keep: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """From members of archives to items in one call: a row for each kept document of each submission that is listed.

    Members are matched with the list, unless the reader has done that, decoded, and taken apart; the accession is the header's or else the listed one.
    Items of repeated submissions repeat; ``first_per_key`` over ``READ_ORDER`` and ``last_per_key`` choose among them.
    """
    if accessions is not None or "matched" not in found.columns:
        found = match_accessions(found, accessions)
    subs = with_header(decode_lossy(found))
    return flat(with_documents(resolve_accessions(subs), keep)).drop("matched")
