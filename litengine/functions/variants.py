"""Sequence-variant and gene-symbol patterns as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four notations that are recognised, most specific first.
FULL_HGVS = r"NM_[0-9]+\.[0-9]+\([A-Z0-9\-]+\):c\.[0-9_]+[A-Za-z]*>[A-Za-z]+"
CDNA = r"c\.[0-9]+(?:_[0-9]+)?(?:[A-Za-z]+>[A-Za-z]+|(?:del|ins|dup|inv)[A-Za-z]*)"
PROTEIN = r"p\.[A-Z][a-z]{2}[0-9]+[A-Z][a-z]{2}|p\.[A-Z][0-9]+[A-Z*]"
RSID = r"\brs[0-9]+\b"
NOTATIONS = (FULL_HGVS, CDNA, PROTEIN, RSID)

# Fixed value: a gene acronym. \z, not $: a trailing line feed is no part of it.
ACRONYM = r"^[A-Z0-9\-]{2,8}\z"
# Fixed value: the gene of a variant, in parentheses before a colon.
GENE_IN_VARIANT = r"\(([A-Z0-9\-]+)\):"


def variants_in(text: Column) -> Column:
    """Distinct variants of a text: notation by notation, then by place. Null text gives null."""
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in NOTATIONS)))


def gene_of_variant(variant: Column) -> Column:
    """The gene in parentheses before a colon, else the whole string."""
    gene = F.regexp_extract(variant, GENE_IN_VARIANT, 1)
    return F.when(gene != "", gene).otherwise(variant)


def is_acronym(name: Column) -> Column:
    return F.coalesce(name.rlike(ACRONYM), F.lit(False))


def acronyms_in(text: Column) -> Column:
    """Whole tokens that pass the acronym test, with repeats."""
    return F.filter(F.split(text, "[^A-Za-z0-9-]+"), lambda t: t.rlike(ACRONYM))


def without_protein(name: Column) -> Column:
    """A variant name without its trailing ' (p.…)'."""
    return F.regexp_replace(name, r"\s*\(p\.[^)]*\)\s*\z", "")
