"""One run, or many runs at once, from tables or remote sources to the report; the sinks are what sets it going."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litengine.config import MiningConfig
from litengine.functions import tokens as TK
from litengine.operators import assertions as AS
from litengine.operators import literature as LI
from litengine.operators import reconcile as RE
from litengine.operators import report as RP
from litengine.operators import tagging as TG
from litengine.operators import validate as VA
from litengine.sources import entrez as EN

log = logging.getLogger("litengine")


@dataclass
class Mined:
    mentions: DataFrame
    buckets: DataFrame
    summary: DataFrame
    pmids: DataFrame


def mine(articles: DataFrame, assertions: DataFrame, cfg: MiningConfig = MiningConfig(), tagger: Callable[[], TG.Tagger] | None = None) -> Mined:
    """Both sides reconciled. Either side may be empty. Genes of texts are those of the tagger that reach cfg.min_score; without one, acronyms."""
    cfg.checked()
    texts = LI.fetched_once(articles)
    lit = LI.mentions(texts, cfg.full_text_mode, (), tagger, cfg.min_score).unionByName(AS.curated_mentions(assertions, cfg.clinical_relevance, cfg.normalize_hgvs))
    summary = RE.summary(lit)
    n = articles.agg(F.count_distinct("pmid").alias("total_articles_found")).withColumn("__one", F.lit(1))
    rows = AS.significant(assertions, cfg.clinical_relevance).agg(F.count(F.lit(1)).alias("clinvar_pathogenic_variants")).withColumn("__one", F.lit(1))
    summary = summary.withColumn("__one", F.lit(1)).join(n, "__one").join(rows, "__one").drop("__one").withColumn("disease_query", F.lit(cfg.disease_term))
    return Mined(lit, RE.buckets(lit), summary, articles.select("pmid").filter("pmid is not null").distinct())


def search(articles: DataFrame, assertions: DataFrame, cfg: MiningConfig) -> tuple[DataFrame, DataFrame]:
    """Offline stand-in for the two remote searches: substring predicates, source rank order, the same limit for both."""
    disease = ((cfg.disease_term,),)
    arts = LI.search_top(articles, F.concat_ws(" ", "title", "abstract"), disease + LI.parsed_terms(cfg.search_terms), [F.col("hit_rank"), F.col("pmid")], cfg.retmax)
    rows = LI.search_top(assertions, F.col("trait_names"), disease, [F.col("uid")], cfg.retmax)
    return arts, rows


def fetch_literature(spark: SparkSession, cfg: MiningConfig, options: dict[str, str], full_text: bool = True) -> DataFrame:
    """(rank, pmid, title, abstract, pmcid, pmc_xml): search, records, links and full texts in turn. An article without a link or whose full text fails keeps its row."""
    EN.register(spark)
    o = options | {"term": cfg.disease_term + cfg.search_terms, "retmax": str(cfg.retmax), "text_mode": cfg.text_mode}
    arts = spark.read.format("litengine_articles").options(**o).load()
    if not full_text:
        return arts.withColumns({"pmcid": F.lit(None).cast("string"), "pmc_xml": F.lit(None).cast("string")})
    linked = LI.resolve_ids(arts, EN.links(arts, options))
    return LI.attach_full_text(linked, EN.full_texts(linked, options))


def fetch_assertions(spark: SparkSession, cfg: MiningConfig, options: dict[str, str]) -> DataFrame:
    """(rank, the flat columns): search, summaries, parsed and flattened."""
    EN.register(spark)
    raw = spark.read.format("litengine_assertions").options(**options | {"term": cfg.disease_term, "retmax": str(cfg.retmax)}).load()
    return AS.flatten_parsed(AS.parse_nested(raw.drop("uid"), ("rank",)), ("rank",))


def validated(mined: Mined, cfg: MiningConfig, validator: VA.Validator) -> DataFrame:
    """One merged verdict row for a run. The names are packed as they stand in the buckets, without a row that holds them all."""
    order = {b: i for i, b in enumerate(RE.BUCKET_KEYS, 1)}
    place = F.element_at(F.create_map(*(F.lit(x) for kv in order.items() for x in kv)), F.col("bucket"))
    items = mined.buckets.select("bucket", place.alias("bucket_ord"), F.col("name").alias("item"))
    if cfg.include_ids:
        items = items.unionByName(mined.pmids.select(F.lit("pmids").alias("bucket"), F.lit(len(order) + 1).alias("bucket_ord"), F.col("pmid").alias("item")))
    items = items.withColumns({"run": F.lit(0), "pos": F.lit(0)})
    available = TK.budget(cfg.token_limit, cfg.disease_term, cfg.safety_margin) if cfg.enable_chunking else 2**31 - 1
    chunks = VA.pack(items, available, ("run",))
    texts = VA.validate(chunks, cfg.disease_term, validator, cfg.max_concurrent, cfg.max_retries)
    parsed = texts.select(F.col("chunk_id").alias("chunk_no"), VA.parse_verdict(F.col("verdict")).alias("v"), "error").select("chunk_no", "v.*", F.col("error").alias("failed"))
    merged = VA.merge(parsed.drop("error").withColumnRenamed("failed", "error"))
    mode = F.when(F.lit(cfg.enable_chunking) & (F.col("chunk_count") > 1), "concurrent").otherwise("single")
    return merged.withColumn("chunking_enabled", F.lit(cfg.enable_chunking)).withColumn("mode", mode)


def run_report(mined: Mined, cfg: MiningConfig, verdict: DataFrame | None = None) -> DataFrame:
    return RP.report(mined.buckets, verdict, status_column=cfg.status_column)
