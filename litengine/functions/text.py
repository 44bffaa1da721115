"""String expressions; all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """White space of any kind removed at both ends (trim() removes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def name_key(c: Column) -> Column:
    """What a name has in common with itself written in another case, with other blanks or punctuation; null if it has no letter or digit."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", " ")), F.lit(""))


def split_list(c: Column) -> Column:
    """Comma-separated cell to an array of stripped parts; null stays null."""
    return F.transform(F.split(c, ","), strip)


def join_list(a: Column) -> Column:
    """', '-joined array; a null element reads 'None'; null or empty array gives null."""
    return F.when(F.size(a) > 0, F.array_join(F.transform(a, lambda x: F.coalesce(x.cast("string"), F.lit("None"))), ", "))


def pmc_prefixed(c: Column) -> Column:
    return F.concat(F.lit("PMC"), c)


def pmc_bare(c: Column) -> Column:
    return F.replace(c, F.lit("PMC"), F.lit(""))


def drop_last(c: Column) -> Column:
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0)))


# What marks an error message as worth another attempt.
RETRIABLE_MARKS = ("rate limit", "429", "timeout", "connection", "503", "502")


def is_retriable(message: Column) -> Column:
    """True where the message holds one of the marks, in any case; null reads as false."""
    low = F.lower(message)
    hit = F.lit(False)
    for mark in RETRIABLE_MARKS:
        hit = hit | low.contains(mark)
    return F.coalesce(hit, F.lit(False))


def shortened(text: str, n: int = 100) -> str:
    """The start of a long text, for logs only."""
    return text if len(text) <= n else text[:n]


# --- XML held as text ---------------------------------------------------------------------------


def xml_escape(c: Column) -> Column:
    """Text as it stands inside serialized markup."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_plain(c: Column) -> Column:
    """Markup removed, the five named entities resolved."""
    bare = F.regexp_replace(c, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return bare


def xml_usable(c: Column) -> Column:
    """True for a document that closes its root element and has at least one child: a cut-off or childless one counts as absent."""
    root = F.regexp_extract(c, r"^\s*(?:<\?[^>]*\?>\s*)?<([A-Za-z][A-Za-z0-9_.:-]*)", 1)
    closed = F.endswith(strip(c), F.concat(F.lit("</"), root, F.lit(">")))
    children = F.regexp_count(c, F.lit("<[A-Za-z]")) > 1
    return F.coalesce((root != "") & closed & children, F.lit(False))
