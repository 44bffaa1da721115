"""Mentions of both sides to the eight buckets and the summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket key, report order, place in the candidates dictionary, entity type, source label, note.
BUCKETS = (
    ("genes_in_both_abstract_clinvar", 1, 1, "Gene", "Both", "Found in literature (PubMed|PMC) + ClinVar"),
    ("genes_only_abstract", 2, 2, "Gene", "Abstract Only", "Found only in literature (abstracts) but not in ClinVar"),
    ("genes_only_clinvar", 3, 3, "Gene", "ClinVar Only", "Found only in ClinVar but not in fetched abstracts"),
    ("genes_only_full_text", 4, 4, "Gene", "Full Text PMC", "Found only in full-text articles but not in ClinVar"),
    ("variants_in_abstract_clinvar", 5, 5, "Variant", "Both", "Found in literature (PubMed|PMC) + ClinVar"),
    ("variants_only_text", 6, 6, "Variant", "Abstract Only", "Found only in literature (abstracts) but not in ClinVar"),
    ("variants_only_full_text", 7, 8, "Variant", "Full Text Only", "Found only in full-text articles but not in ClinVar"),
    ("variants_only_clinvar", 8, 7, "Variant", "ClinVar Only", "Found only in ClinVar but not in abstracts or full text"),
)
BUCKET_KEYS = tuple(b[0] for b in sorted(BUCKETS, key=lambda b: b[2]))


def presence(mentions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row for each entity with three flags: in an abstract, in a full text, curated. One shuffle, with partial aggregation: a gene named a million times is one row a task."""
    def seen(origin: str) -> Column:
        return F.bool_or(F.col("origin") == origin)

    return mentions.groupBy(*keys, "etype", "name").agg(seen("abstract").alias("a"), seen("full_text").alias("f"), seen("curated").alias("c"))


def buckets(mentions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, bucket, bucket_ord, etype, source, name). 'Full text' is measured against abstracts only, so an entity may stand in two buckets."""
    return bucketed(presence(mentions, keys), keys)


def bucketed(present: DataFrame, keys: tuple[str, ...] = (), rules: tuple[str, ...] = ("in_both", "only_abstract", "only_curated", "only_full")) -> DataFrame:
    """The buckets of entities whose three flags are known; of the rules named alone."""
    a, f, c = F.col("a"), F.col("f"), F.col("c")
    which = {"in_both": a & c, "only_abstract": a & ~c, "only_curated": c & ~a, "only_full": f & ~a}
    rule = dict(zip((b[0] for b in BUCKETS), ("in_both", "only_abstract", "only_curated", "only_full", "in_both", "only_abstract", "only_full", "only_curated"), strict=True))
    hits = [
        F.when((F.col("etype") == kind.lower()) & which[rule[key]], F.struct(F.lit(key).alias("bucket"), F.lit(order).alias("bucket_ord"), F.lit(source).alias("source")))
        for key, order, _, kind, source, _ in BUCKETS
        if rule[key] in rules
    ]
    return (
        present.select(*keys, "etype", "name", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("b"))
        .select(*keys, "b.bucket", "b.bucket_ord", "etype", "b.source", "name")
    )


def summary(mentions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Exact distinct counts per etype from the presence table: no second pass over the mentions."""
    p, lit = presence(mentions, keys), F.col("a") | F.col("f")

    def n(etype: str, cond: Column) -> Column:
        return F.count_if((F.col("etype") == etype) & cond)

    yes = F.lit(True)
    return p.groupBy(*keys).agg(
        n("gene", lit).alias("genes_from_literature"),
        n("gene", F.col("c")).alias("genes_from_clinvar"),
        n("gene", yes).alias("total_unique_genes"),
        n("variant", lit).alias("variants_from_literature"),
        n("variant", F.col("c")).alias("variants_from_clinvar"),
        n("variant", yes).alias("total_unique_variants"),
    )


def as_candidates(bucketed: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Wide form: one row a key, one sorted array a bucket."""
    arrays = [F.array_sort(F.collect_set(F.when(F.col("bucket") == b, F.col("name")))).alias(b) for b in BUCKET_KEYS]
    return bucketed.groupBy(*keys).agg(*arrays)
