"""Column functions for canonical text. White space is Unicode white space plus the four ASCII separators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
#: Line ends as text files count them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: A list marker: a dash, a dot, or a word in parentheses, with white space after it.
BULLET = rf"(?U)^{SPACE}*(?:[-•]|\([A-Za-z0-9]+\)){SPACE}+"
TABLE = r"(?s)\[\[TABLE\]\].*?\[\[/TABLE\]\]"
#: Zero-width place before the white space that may end a sentence.
SENTENCE_END = rf"(?U)(?<=[A-Za-z0-9]{{2}}[.!?])(?={SPACE}+[A-Za-z])"

# fixed values: words before whose full stop no sentence ends
ABBREVIATIONS = (
    "mr", "ms", "mrs", "dr", "inc", "ltd", "corp", "co", "no", "art", "sec", "ex", "fig", "st", "llc", "lp", "llp",
    "plc", "na", "cf", "vs", "dept", "div", "assoc", "approx", "appx",
)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def is_bullet(line: Column) -> Column:
    return line.rlike(BULLET)


def newline_cleanup(text: Column) -> Column:
    """No carriage returns, and no more than one blank line in a row."""
    return F.regexp_replace(F.regexp_replace(text, "\r", ""), "\n{3,}", "\n\n")


def blank_collapse(text: Column) -> Column:
    """Runs of blanks and tabs as one blank."""
    return F.regexp_replace(text, "[ \t]{2,}", " ")


def bullet_normalize(text: Column) -> Column:
    """Each line's list marker as ``- ``; other lines get their blanks collapsed."""

    def line(x: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(x, BULLET, ""), rf"(?U)^{SPACE}+", "")
        return F.when(is_bullet(x), F.concat(F.lit("- "), rest)).otherwise(blank_collapse(x))

    return F.array_join(F.transform(F.split(text, LINE_END), line), "\n")


def reflow(paragraph: Column) -> Column:
    """A paragraph on one line, or line by line where it is a list."""
    raw = F.split(paragraph, "\n")
    lines = F.transform(raw, strip)
    listed = F.exists(raw, is_bullet)
    kept = strip(F.array_join(F.transform(raw, lambda x: strip(blank_collapse(x))), "\n"))
    joined = blank_collapse(F.array_join(F.filter(lines, lambda x: x != ""), " "))
    return F.when(listed, kept).otherwise(joined)


def paragraph_reflow(text: Column) -> Column:
    """Paragraphs reflowed, empty ones dropped, one blank line between them."""
    parts = F.transform(F.split(newline_cleanup(text), "\n\n"), reflow)
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n\n")


def canonical(fenced: Column) -> Column:
    """Canonical text of a page's text with fenced tables."""
    between = F.split(fenced, TABLE, -1)
    tables = F.regexp_extract_all(fenced, F.lit(TABLE), F.lit(0))
    pairs = F.arrays_zip(between.alias("b"), tables.alias("t"))
    parts = F.flatten(F.transform(pairs, lambda p: F.array(paragraph_reflow(p["b"]), F.coalesce(p["t"], F.lit("")))))
    return bullet_normalize(F.array_join(F.filter(parts, lambda x: x != ""), "\n\n"))


_NO_TEXT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<!doctype[^>]*>"
#: A tag whose attributes hold no angle brackets.
_TAG = r"""</?[a-zA-Z][^<>"']*+(?:(?:"[^"<>]*+"|'[^'<>]*+')[^<>"']*+)*+>"""
#: References that ``html_to_text`` decodes, in this order.
_REFERENCES = (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def is_plain_page(html: Column) -> Column:
    """Whether ``html_to_text`` says all about a page: no tables or preformatted text, no other references, no stray
    brackets, and no runs of white space between tags."""
    bare = F.regexp_replace(F.regexp_replace(html, _NO_TEXT, ""), _TAG, "")
    known = "|".join(r[1:-1] for r, _ in _REFERENCES)
    odd = rf"(?i)<(?:table|pre|textarea|template|plaintext|xmp|title/)|&(?!(?:{known});)|>\s\s+<"
    return ~html.rlike(odd) & ~bare.rlike("[<>]")


def html_to_text(html: Column) -> Column:
    """Text nodes of a plain page, one to a line, by expressions alone; see ``is_plain_page``.

    ``sources.html.page_text`` takes any page, and this way only those it is right for.
    """
    text = F.regexp_replace(F.regexp_replace(html, _NO_TEXT, "<x>"), r"(?:<[^>]*>)+", "\n")
    for reference, char in _REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    return outer_newlines(text)


def outer_newlines(text: Column) -> Column:
    """Without newlines at both ends."""
    return F.regexp_replace(text, "^\n+|\n+$", "")


def markdown_table(rows: Column) -> Column:
    """``ARRAY<ARRAY<STRING>>`` as a Markdown table, the first row as its head, short rows padded."""
    width = F.array_max(F.transform(rows, F.size))
    padded = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
    lines = F.transform(padded, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")


def html_wrap(body: Column) -> Column:
    """A document body as HTML: what has no html tag is wrapped; null is empty."""
    text = F.coalesce(body, F.lit(""))
    return F.when(F.contains(F.lower(text), F.lit("<html")), text).otherwise(
        F.concat(F.lit("<html><body><pre>"), text, F.lit("</pre></body></html>"))
    )


def safe_item_id(accession: Column, sequence: Column, ordinal: Column | None = None) -> Column:
    """``accession_sequence`` with runs of other characters than letters, digits, ``._-`` as ``_``."""
    blank = F.lit("doc") if ordinal is None else F.format_string("doc%02d", ordinal)
    clean = lambda c: F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")
    return F.concat(clean(accession), F.lit("_"), clean(F.coalesce(F.nullif(sequence, F.lit("")), blank)))
