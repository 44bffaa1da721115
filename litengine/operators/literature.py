"""Article side: search, id resolution, full text, mentions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.functions import text as TX
from litengine.functions import variants as V
from litengine.operators import tagging as TG


def parsed_terms(text: str) -> tuple[tuple[str, ...], ...]:
    """' AND (a OR b) AND c' → ((a, b), (c,)): groups that must all be met, each by any of its terms. ValueError for what is not of this form."""
    groups = []
    for part in re.split(r"\bAND\b", text):
        terms = tuple(t.strip().strip('"').strip() for t in re.split(r"\bOR\b", re.sub(r"^\s*\((.*)\)\s*$", r"\1", part)))
        if any(re.search(r"[()]|\bNOT\b", t) for t in terms):
            raise ValueError(f"search terms of another form than AND of ORs: {text}")
        if any(terms):
            groups.append(tuple(t for t in terms if t))
    return tuple(groups)


def search_top(df: DataFrame, text: Column, groups: tuple[tuple[str, ...], ...], rank: list[Column], k: int) -> DataFrame:
    """Rows whose text holds, for every group, at least one of its terms (case ignored), the first k in rank order."""
    low, hit = F.lower(text), F.lit(True)
    for terms in groups:
        some = F.lit(False)
        for t in terms:
            some = some | low.contains(t.lower())
        hit = hit & some
    return df.filter(F.coalesce(hit, F.lit(False))).orderBy(*rank).limit(k)


def first_links(links: DataFrame) -> DataFrame:
    """One link for each pmid: the lowest link_rank, ties by the id; a partial aggregate, so that repeats never travel."""
    best = links.filter(F.col("pmid").isNotNull()).groupBy("pmid").agg(F.min(F.struct("link_rank", "pmc_numeric_id")).alias("l"))
    return best.select("pmid", TX.pmc_prefixed(F.col("l.pmc_numeric_id")).alias("pmcid"))


def resolve_ids(articles: DataFrame, links: DataFrame) -> DataFrame:
    """Every article keeps its row; those without a link have a null pmcid."""
    return articles.drop("pmcid").join(first_links(links), "pmid", "left")


def attach_full_text(articles: DataFrame, full_texts: DataFrame) -> DataFrame:
    """Left join by pmcid; markup that is cut off or has no child counts as absent. full_texts: (pmcid, pmc_xml), one row a pmcid."""
    usable = full_texts.filter(TX.xml_usable(F.col("pmc_xml"))).groupBy("pmcid").agg(F.min("pmc_xml").alias("pmc_xml"))
    return articles.drop("pmc_xml").join(usable, "pmcid", "left")


def fetched_once(articles: DataFrame, keys: tuple[str, ...] = ("pmid",)) -> DataFrame:
    """(keys…, abstract, pmc_xml), each fetch that brought the same texts once: nothing is extracted twice from a repeated fetch. Fetches that differ all stand."""
    return articles.select(*dict.fromkeys((*keys, "abstract", "pmc_xml"))).distinct()


def mentions(articles: DataFrame, full_text_mode: str = "serialized", keep: tuple[str, ...] = ("pmid",), tagger: Callable[[], TG.Tagger] | None = None, min_score: float = 0.75) -> DataFrame:
    """(keep…, etype, origin, name), distinct within an article. An article without an abstract gives nothing, not even from its full text.

    Genes are those the tagger names with min_score or more; without a tagger, every acronym.
    """
    base = articles.filter(F.col("abstract").isNotNull() & (F.col("abstract") != ""))
    xml = F.when(TX.xml_usable(F.col("pmc_xml")), F.col("pmc_xml"))
    full = xml if full_text_mode == "serialized" else TX.xml_plain(xml)

    def found(etype: str, origin: str, names: Column) -> Column:
        return F.transform(F.array_distinct(F.coalesce(names, F.array().cast("array<string>"))), lambda n: F.struct(F.lit(etype).alias("etype"), F.lit(origin).alias("origin"), n.alias("name")))

    variants = [found("variant", "abstract", V.variants_in(F.col("abstract"))), found("variant", "full_text", V.variants_in(full))]
    if tagger is None:
        genes = [found("gene", "abstract", V.acronyms_in(F.col("abstract"))), found("gene", "full_text", V.acronyms_in(full))]
        return base.select(*keep, F.inline(F.concat(*genes, *variants)))
    texts = base.select(*keep, F.inline(F.array(*(F.struct(F.lit(o).alias("origin"), t.alias("__text")) for o, t in (("abstract", F.col("abstract")), ("full_text", full))))))
    tagged = TG.labels(texts, "__text", tagger, min_score).select(*keep, F.lit("gene").alias("etype"), "origin", "name").distinct()
    return tagged.unionByName(base.select(*keep, F.inline(F.concat(*variants))))


def tagged_genes(labels: DataFrame, min_score: float = 0.75, value: str = "gene", column: str = "etype") -> DataFrame:
    """Scored labels that count as gene mentions: exact label, inclusive score threshold, acronym form."""
    return labels.filter((F.col(column) == value) & (F.col("score") >= min_score) & V.is_acronym(F.col("name")))
