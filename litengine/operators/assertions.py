"""Curated side: nested records parsed, flattened, filtered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.functions import text as TX
from litengine.functions import variants as V

# The columns of a flat record, in order.
FLAT_COLUMNS = (
    "uid", "accession", "accession_version", "title", "variant_type", "variation_name", "measure_id", "cdna_change", "protein_change", "aliases",
    "canonical_spdi", "genes", "gene_ids", "chr38", "start38", "stop38", "chr37", "start37", "stop37", "clinical_significance", "review_status",
    "last_evaluated", "trait_names", "trait_ids", "molecular_consequences", "scv", "rcv",
)


def latest(df: DataFrame, key: str = "uid", order: str = "loaded_at") -> DataFrame:
    """One row for each key: of repeated deliveries the latest. A partial aggregate, so that a hot key is reduced before it is shuffled."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("r")).select(key, "r.*")


def significant(df: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Exact membership; null and composite classes fall out."""
    return df.filter(F.col("clinical_significance").isin(*levels))


def curated_genes(genes: Column | None = None) -> Column:
    return F.explode(TX.split_list(F.col("genes") if genes is None else genes))


def curated_mentions(flat: DataFrame, levels: tuple[str, ...], normalize_hgvs: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep…, etype, origin='curated', name) of the records with one of the levels."""
    name = V.without_protein(F.col("variation_name")) if normalize_hgvs else F.col("variation_name")
    empty = F.array().cast("array<string>")
    both = F.concat(
        F.transform(F.coalesce(TX.split_list(F.col("genes")), empty), lambda g: F.struct(F.lit("gene").alias("etype"), F.lit("curated").alias("origin"), g.alias("name"))),
        F.filter(F.array(F.struct(F.lit("variant").alias("etype"), F.lit("curated").alias("origin"), name.alias("name"))), lambda s: s["name"].isNotNull()),
    )
    return significant(flat, levels).select(*keep, F.inline(both))


# --- nested records -----------------------------------------------------------------------------


def unwrapped(payload: Column) -> Column:
    """JSON text to a variant record: a record written as a string, or as a list, is taken out of it; null where it can't be read."""
    v = F.try_parse_json(payload)
    inner = F.when(F.startswith(F.ltrim(payload), F.lit('"')), F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v)
    return F.coalesce(F.try_variant_get(inner, "$[0]", "variant"), inner)


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def items(v: Column, path: str, wrapper: str | None = None) -> Column:
    """The objects of a list that may also be a single object, or sit under a wrapping key; anything else gives an empty array."""
    node = F.try_variant_get(v, path, "variant")
    if wrapper:
        node = F.coalesce(F.try_variant_get(node, f"$.{wrapper}", "variant"), node)
    alone = F.when(F.try_variant_get(node, "$", "map<string,variant>").isNotNull(), F.array(node))
    return F.coalesce(F.try_variant_get(node, "$", "array<variant>"), alone, F.array().cast("array<variant>"))


def strings(v: Column, path: str) -> Column:
    """A list of scalars, or one scalar, as an array of strings; absent gives an empty array."""
    node = F.try_variant_get(v, path, "variant")
    one = F.try_variant_get(node, "$", "string")
    many = F.transform(F.try_variant_get(node, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def classification(v: Column) -> Column:
    """The germline classification of either generation of keys; one that was written as a string is read."""
    node = F.coalesce(F.try_variant_get(v, "$.germline_classification", "variant"), F.try_variant_get(v, "$.clinical_significance", "variant"))
    is_object = F.try_variant_get(node, "$", "map<string,variant>").isNotNull()
    return F.when(is_object, node).otherwise(F.try_parse_json(F.try_variant_get(node, "$", "string")))


def parse_nested(raw: DataFrame, keys: tuple[str, ...] = ("raw_id", "loaded_at")) -> DataFrame:
    """(keys…, record): raw payloads to typed nested records; either generation of keys, lists or single objects, unreadable payloads dropped."""
    base = raw.select(*(F.col(k).alias(f"__{k}") for k in keys), unwrapped(F.col("payload")).alias("v")).filter(F.col("v").isNotNull())
    base = base.select("*", classification(F.col("v")).alias("g"))
    v, g = F.col("v"), F.col("g")
    first = F.get(items(v, "$.variation_set"), F.lit(0))

    def either(x: Column, *paths: str) -> Column:
        return F.coalesce(*(text_at(x, p) for p in paths))

    def list_of(x: Column, *pairs: tuple[str, str | None]) -> Column:
        lists = [items(x, p, w) for p, w in pairs]
        out = lists[-1]
        for a in reversed(lists[:-1]):
            out = F.when(F.size(a) > 0, a).otherwise(out)
        return out

    genes = F.transform(items(v, "$.genes", "gene"), lambda x: F.struct(text_at(x, "$.symbol").alias("symbol"), either(x, "$.GeneID", "$.gene_id").alias("gene_id"), text_at(x, "$.strand").alias("strand")))
    coordinates = F.transform(
        list_of(first, ("$.variation_loc", None), ("$.coordinates", None)),
        lambda x: F.struct(
            either(x, "$.assembly_name", "$.assembly").alias("assembly"),
            *(text_at(x, f"$.{k}").alias(k) for k in ("status", "chr", "band", "start", "stop")),
            either(x, "$.assembly_acc_ver", "$.assembly_accession").alias("assembly_accession"),
        ),
    )
    traits = F.transform(
        list_of(g, ("$.trait_set", "trait"), ("$.traits", "trait")),
        lambda t: F.struct(
            text_at(t, "$.trait_name").alias("trait_name"),
            F.transform(items(t, "$.trait_xrefs"), lambda x: F.struct(either(x, "$.db_source", "$.db").alias("db"), either(x, "$.db_id", "$.id").alias("id"))).alias("trait_xrefs"),
        ),
    )
    return base.select(
        *(F.col(f"__{k}").alias(k) for k in keys),
        *(text_at(v, f"$.{k}").alias(k) for k in ("uid", "accession", "accession_version", "title")),
        either(v, "$.obj_type", "$.variant_type").alias("variant_type"),
        *(text_at(first, f"$.{k}").alias(k) for k in ("measure_id", "variation_name", "cdna_change")),
        strings(first, "$.aliases").alias("aliases"),
        text_at(first, "$.canonical_spdi").alias("canonical_spdi"),
        strings(v, "$.molecular_consequence_list").alias("molecular_consequences"),
        text_at(v, "$.protein_change").alias("protein_change"),
        genes.alias("genes"),
        coordinates.alias("coordinates"),
        strings(v, "$.supporting_submissions.scv").alias("scv"),
        strings(v, "$.supporting_submissions.rcv").alias("rcv"),
        F.struct(*(text_at(g, f"$.{k}").alias(k) for k in ("description", "last_evaluated", "review_status")), traits.alias("traits")).alias("clinical_significance"),
        text_at(v, "$.oncogenicity_classification").alias("oncogenicity"),
        text_at(v, "$.clinical_impact_classification").alias("clinical_impact"),
        *(text_at(v, f"$.{k}").alias(k) for k in ("gene_sort", "chr_sort", "location_sort")),
    )


def trait_ids(significance: Column) -> Column:
    """All db:id of all traits in order; a missing piece reads 'None'."""
    none = F.lit("None")
    return F.flatten(F.transform(significance["traits"], lambda t: F.transform(t["trait_xrefs"], lambda x: F.concat_ws(":", F.coalesce(x["db"], none), F.coalesce(x["id"], none)))))


def on_assembly(coordinates: Column, assembly: str, field: str) -> Column:
    """A field of the first coordinate on the assembly, else null."""
    return F.get(F.filter(coordinates, lambda c: c["assembly"] == assembly), F.lit(0))[field]


def flatten_parsed(parsed: DataFrame, keys: tuple[str, ...] = ("raw_id",)) -> DataFrame:
    """The 27 flat string columns, in their fixed order, after the keys."""
    c = F.col
    made = {
        "genes": TX.join_list(F.transform(c("genes"), lambda g: g["symbol"])),
        "gene_ids": TX.join_list(F.transform(c("genes"), lambda g: g["gene_id"])),
        "aliases": TX.join_list(c("aliases")),
        "clinical_significance": c("clinical_significance.description"),
        "review_status": c("clinical_significance.review_status"),
        "last_evaluated": c("clinical_significance.last_evaluated"),
        "trait_names": TX.join_list(F.transform(c("clinical_significance.traits"), lambda t: t["trait_name"])),
        "trait_ids": TX.join_list(trait_ids(c("clinical_significance"))),
        "molecular_consequences": TX.join_list(c("molecular_consequences")),
        "scv": TX.join_list(c("scv")),
        "rcv": TX.join_list(c("rcv")),
    }
    for short, assembly in (("38", "GRCh38"), ("37", "GRCh37")):
        made |= {f"{f}{short}": on_assembly(c("coordinates"), assembly, f) for f in ("chr", "start", "stop")}
    return parsed.select(*keys, *(made.get(name, c(name)).alias(name) for name in FLAT_COLUMNS))
