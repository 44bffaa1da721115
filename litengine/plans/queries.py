"""Queries of the core operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litengine.functions import text as TX
from litengine.functions import tokens as TK
from litengine.functions import variants as V
from litengine.operators import assertions as AS
from litengine.operators import literature as LI
from litengine.operators import multivalue as MV
from litengine.operators import nested as NE
from litengine.operators import reconcile as RE
from litengine.operators import report as RP
from litengine.operators import validate as VA
from litengine.runtime import table
from litengine.sources import retry as RT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LEVELS = ("Pathogenic", "Likely pathogenic")
DISEASE = "Fenn-Tremmel syndrome"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- shared pieces of SQL -----------------------------------------------------------------------

_USABLE = r"""(regexp_extract(pmc_xml, '^\s*(?:<\?[^>]*\?>\s*)?<([A-Za-z][A-Za-z0-9_.:-]*)', 1) <> ''
  AND ends_with(regexp_replace(pmc_xml, '^\s+|\s+$', '', 'g'), '</' || regexp_extract(pmc_xml, '^\s*(?:<\?[^>]*\?>\s*)?<([A-Za-z][A-Za-z0-9_.:-]*)', 1) || '>')
  AND len(regexp_extract_all(pmc_xml, '<[A-Za-z]')) > 1)"""
_ART = f"art AS (SELECT pmid, abstract, CASE WHEN {_USABLE} THEN pmc_xml END AS xml FROM articles WHERE abstract IS NOT NULL AND abstract <> '')"


def _genes(col: str) -> str:
    return f"unnest(string_split_regex({col}, '[^A-Za-z0-9-]+'))"


def _variants(col: str) -> str:
    return f"unnest(list_concat({', '.join(f"regexp_extract_all({col}, '{p}')" for p in V.NOTATIONS)}))"


_ACRONYM = "regexp_full_match(name, '[A-Z0-9-]{2,8}')"
_MENTIONS = f"""{_ART}, lit AS (
  SELECT pmid, 'gene' AS etype, 'abstract' AS origin, {_genes("abstract")} AS name FROM art UNION ALL
  SELECT pmid, 'variant', 'abstract', {_variants("abstract")} FROM art UNION ALL
  SELECT pmid, 'gene', 'full_text', {_genes("xml")} FROM art WHERE xml IS NOT NULL UNION ALL
  SELECT pmid, 'variant', 'full_text', {_variants("xml")} FROM art WHERE xml IS NOT NULL),
mentions_lit AS (SELECT DISTINCT pmid, etype, origin, name FROM lit WHERE etype = 'variant' OR {_ACRONYM}),
flat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY loaded_at DESC) AS rn FROM assertions_flat) WHERE rn = 1),
sig AS (SELECT * FROM flat WHERE clinical_significance IN ('Pathogenic', 'Likely pathogenic')),
cur AS (SELECT 'gene' AS etype, 'curated' AS origin, regexp_replace(unnest(string_split(genes, ',')), '^\\s+|\\s+$', '', 'g') AS name FROM sig
  UNION ALL SELECT 'variant', 'curated', variation_name FROM sig WHERE variation_name IS NOT NULL),
ment AS (SELECT etype, origin, name FROM mentions_lit UNION ALL SELECT etype, origin, name FROM cur),
pres AS (SELECT etype, name, bool_or(origin = 'abstract') AS a, bool_or(origin = 'full_text') AS f, bool_or(origin = 'curated') AS c FROM ment GROUP BY 1, 2)"""
_RULES = {"in_both": "a AND c", "only_abstract": "a AND NOT c", "only_curated": "c AND NOT a", "only_full": "f AND NOT a"}
_KIND = ("in_both", "only_abstract", "only_curated", "only_full", "in_both", "only_abstract", "only_full", "only_curated")
_BUCKETS = "buck AS (" + " UNION ALL ".join(
    f"SELECT '{key}' AS bucket, {order} AS bucket_ord, etype, '{source}' AS source, name, '{note}' AS note FROM pres WHERE etype = '{kind.lower()}' AND {_RULES[k]}" for (key, order, _, kind, source, note), k in zip(RE.BUCKETS, _KIND, strict=True)
) + ")"


def _articles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles")


def _flat(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    df = table(spark, d, "assertions_flat")
    return AS.latest(df.select(*columns, "loaded_at") if columns else df)


def _curated(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "uid", "genes", "variation_name", "clinical_significance")


def _mentions(spark: SparkSession, d: str, empty: bool = False) -> DataFrame:
    arts = LI.fetched_once(_articles(spark, d).filter(F.lit(not empty)))
    return LI.mentions(arts, keep=()).unionByName(AS.curated_mentions(_curated(spark, d), LEVELS))


# --- flagship -----------------------------------------------------------------------------------


@query(f"WITH {_MENTIONS}, {_BUCKETS} SELECT bucket, etype, source, name FROM buck")
def entity_crosslink(spark: SparkSession, d: str) -> DataFrame:
    return RE.buckets(_mentions(spark, d)).select("bucket", "etype", "source", "name")


_DKEY = r"nullif(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')), '')"
# the canonical traits a packed cell holds: a name between dividers or the cell's ends, more often than longer names in the cell hold it
_BY_QUERY = rf"""WITH {_MENTIONS},
runs AS (SELECT DISTINCT query_id, {_DKEY.format('summary.disease_query')} AS disease FROM candidates WHERE query_id IS NOT NULL),
asked AS (SELECT DISTINCT disease FROM runs WHERE disease IS NOT NULL),
names AS (SELECT DISTINCT lower(trait_name) AS name, {_DKEY.format('trait_name')} AS disease FROM trait_terms WHERE trait_name IS NOT NULL),
cells AS (SELECT DISTINCT uid, lower(replace(trait_names, chr(92), '')) AS cell FROM sig WHERE trait_names IS NOT NULL),
held AS (SELECT uid, name, disease, (length(cell) - length(replace(cell, name, ''))) // length(name) AS n FROM cells JOIN names ON contains(cell, name)
  WHERE regexp_matches(cell, '(^|[,;|\n"''\[]|\s/\s)\s*' || regexp_escape(name) || '\s*($|[,;|\n"''\]]|\s/\s)')),
inside AS (SELECT h.uid, h.name, sum(l.n * ((length(l.name) - length(replace(l.name, h.name, ''))) // length(h.name))) AS n FROM held h JOIN held l ON l.uid = h.uid AND l.name <> h.name AND contains(l.name, h.name) GROUP BY 1, 2),
traits AS (SELECT DISTINCT h.uid, disease FROM held h LEFT JOIN inside i ON i.uid = h.uid AND i.name = h.name WHERE h.n > coalesce(i.n, 0)),
curated AS (SELECT DISTINCT disease, 'gene' AS etype, regexp_replace(unnest(string_split(genes, ',')), '^\s+|\s+$', '', 'g') AS name FROM sig JOIN traits USING (uid)
  UNION SELECT disease, 'variant', variation_name FROM sig JOIN traits USING (uid) WHERE variation_name IS NOT NULL),
qart AS (SELECT query_id, pmid, etype, origin, name FROM (SELECT DISTINCT query_id, pmid FROM articles WHERE query_id IS NOT NULL) JOIN mentions_lit USING (pmid)),
qp AS (SELECT query_id, etype, name, bool_or(origin = 'abstract') AS a, bool_or(origin = 'full_text') AS f FROM qart GROUP BY 1, 2, 3),
qc AS (SELECT query_id, etype, name, true AS c FROM qp SEMI JOIN (SELECT query_id, etype, name FROM runs JOIN curated USING (disease)) USING (query_id, etype, name)),
lp AS (SELECT CAST(NULL AS VARCHAR) AS disease, query_id, etype, name, a, f, coalesce(c, false) AS c, true AS run FROM qp LEFT JOIN qc USING (query_id, etype, name)
  UNION ALL SELECT disease, NULL, etype, name, false, false, true, false FROM (SELECT DISTINCT disease, etype, name FROM curated SEMI JOIN asked USING (disease))), """


def _by_query_buckets() -> str:
    sql = _BUCKETS.replace("bucket_ord, etype", "bucket_ord, disease, query_id, etype").replace("FROM pres", "FROM lp")
    return sql.replace("AND c AND NOT a", "AND c AND NOT a AND NOT run")


@query(_BY_QUERY + _by_query_buckets() + " SELECT disease, query_id, bucket, etype, source, name FROM buck")
def entity_crosslink_by_query(spark: SparkSession, d: str) -> DataFrame:
    """All runs in one job: the literature by query_id, the curated records by the run's disease among their traits, however it is typed.

    What a run's own literature names has a row with its query_id. What is curated for a disease is the same for all its runs and stands
    once, with the disease and without a query_id: for a run it is `…_only_clinvar` but for the names in the run's `…_in_…_clinvar` bucket.
    So rows grow with the articles and the records, not with their product, and every bucket of every run can be read off.
    """
    disease = TX.name_key(F.col("summary.disease_query"))
    runs = table(spark, d, "candidates").select("query_id", disease.alias("disease")).filter("query_id is not null and disease is not null").distinct()
    flat = _flat(spark, d, "uid", "genes", "variation_name", "clinical_significance", "trait_names")
    traits = split_packed(spark, d, ("trait_names",), AS.significant(flat, LEVELS)).select("uid", TX.name_key(F.col("item")).alias("disease")).filter("disease is not null").distinct()
    traits = traits.join(runs.select("disease").distinct(), "disease", "left_semi")
    curated = AS.curated_mentions(flat, LEVELS, keep=("uid",)).join(traits, "uid").select("disease", "etype", "name").distinct()
    lit = LI.mentions(LI.fetched_once(_articles(spark, d).filter(F.col("query_id").isNotNull()), ("query_id", "pmid")), keep=("query_id",))
    present = RE.presence(lit, ("query_id",)).drop("c")
    # a run's own names look for themselves among the curated ones of its disease; those of many runs are never paired with it
    met = present.join(runs, "query_id", "left").join(curated.withColumn("c", F.lit(True)), ["disease", "etype", "name"], "left")
    present = met.groupBy("query_id", "etype", "name").agg(*(F.bool_or(F.coalesce(x, F.lit(False))).alias(x) for x in ("a", "f", "c")))
    own = RE.bucketed(present, ("query_id",), ("in_both", "only_abstract", "only_full")).withColumn("disease", F.lit(None).cast("string"))
    shared = RE.bucketed(curated.withColumns({"a": F.lit(False), "f": F.lit(False), "c": F.lit(True)}), ("disease",), ("only_curated",)).withColumn("query_id", F.lit(None).cast("string"))
    return own.unionByName(shared).select("disease", "query_id", "bucket", "etype", "source", "name")


@query(f"WITH {_MENTIONS}, {_BUCKETS} SELECT bucket, etype, source, name FROM buck".replace("WHERE abstract IS NOT NULL AND", "WHERE FALSE AND"))
def empty_source_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """No article at all: everything curated lands in its own bucket."""
    return RE.buckets(_mentions(spark, d, empty=True)).select("bucket", "etype", "source", "name")


@query(f"""WITH {_MENTIONS} SELECT (SELECT count(DISTINCT pmid) FROM articles) AS total_articles_found,
  count(*) FILTER (etype = 'gene' AND (a OR f)) AS genes_from_literature, count(*) FILTER (etype = 'gene' AND c) AS genes_from_clinvar, count(*) FILTER (etype = 'gene') AS total_unique_genes,
  count(*) FILTER (etype = 'variant' AND (a OR f)) AS variants_from_literature, count(*) FILTER (etype = 'variant' AND c) AS variants_from_clinvar, count(*) FILTER (etype = 'variant') AS total_unique_variants,
  (SELECT count(*) FROM sig) AS clinvar_pathogenic_variants FROM pres""")
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    from litengine.plans.pipeline import mine

    return mine(_articles(spark, d), _curated(spark, d)).summary.drop("disease_query")


# --- literature ---------------------------------------------------------------------------------


@query(f"WITH t AS (SELECT pmid, {_variants('abstract')} AS variant FROM articles WHERE abstract IS NOT NULL) SELECT DISTINCT pmid, variant FROM t")
def variant_extract(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).select("pmid", F.explode(V.variants_in(F.col("abstract"))).alias("variant")).distinct()


@query(f"""WITH t AS (SELECT DISTINCT {_variants('text')} AS variant FROM documents)
SELECT variant, CASE WHEN regexp_extract(variant, '{V.GENE_IN_VARIANT}', 1) <> '' THEN regexp_extract(variant, '{V.GENE_IN_VARIANT}', 1) ELSE variant END AS gene FROM t""")
def variant_gene(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "documents").select(F.explode(V.variants_in(F.col("text"))).alias("variant")).distinct()
    return v.select("variant", V.gene_of_variant(F.col("variant")).alias("gene"))


@query(f"WITH t AS (SELECT doc_id, {_genes('text')} AS name FROM documents) SELECT doc_id, name AS token, count(*) AS n FROM t WHERE {_ACRONYM} GROUP BY 1, 2")
def gene_acronym_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(V.acronyms_in(F.col("text"))).alias("token")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT mention_id, name, score FROM mentions WHERE etype = 'gene' AND score >= 0.75 AND {_ACRONYM}")
def mention_filter(spark: SparkSession, d: str) -> DataFrame:
    return LI.tagged_genes(table(spark, d, "mentions")).select("mention_id", "name", "score")


@query(f"SELECT pmid, hit_rank, query_id FROM articles WHERE contains(lower(concat_ws(' ', title, abstract)), '{DISEASE.lower()}') AND (contains(lower(concat_ws(' ', title, abstract)), 'genetics') OR contains(lower(concat_ws(' ', title, abstract)), 'variant')) ORDER BY hit_rank, pmid, query_id NULLS FIRST, fetched_at LIMIT 10")
def article_search_topk(spark: SparkSession, d: str) -> DataFrame:
    rank = [F.col("hit_rank"), F.col("pmid"), F.col("query_id").asc_nulls_first(), F.col("fetched_at")]
    return LI.search_top(_articles(spark, d), F.concat_ws(" ", "title", "abstract"), ((DISEASE,), *LI.parsed_terms(" AND (genetics OR variant)")), rank, 10).select("pmid", "hit_rank", "query_id")


@query(f"SELECT uid, accession FROM (SELECT DISTINCT uid, accession, trait_names FROM assertions_flat) WHERE contains(lower(trait_names), '{DISEASE.lower()}') ORDER BY uid LIMIT 10")
def assertion_search_topk(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "assertions_flat").select("uid", "accession", "trait_names").distinct()
    return LI.search_top(df, F.col("trait_names"), ((DISEASE,),), [F.col("uid")], 10).select("uid", "accession")


_LINKS = "links AS (SELECT pmid, 'PMC' || pmc_numeric_id AS pmcid FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY link_rank, pmc_numeric_id) AS rn FROM id_links WHERE pmid IS NOT NULL) WHERE rn = 1)"
_PMIDS = "p AS (SELECT DISTINCT pmid FROM articles)"


@query(f"WITH {_LINKS}, {_PMIDS} SELECT p.pmid, pmcid FROM p LEFT JOIN links USING (pmid)")
def id_resolution_left_join(spark: SparkSession, d: str) -> DataFrame:
    return LI.resolve_ids(_articles(spark, d).select("pmid").distinct(), table(spark, d, "id_links"))


@query(f"WITH {_LINKS}, {_PMIDS}, ft AS (SELECT pmcid, min(pmc_xml) AS pmc_xml FROM articles WHERE {_USABLE} GROUP BY 1) SELECT p.pmid, links.pmcid, CAST(coalesce(length(ft.pmc_xml), 0) AS BIGINT) AS xml_chars FROM p LEFT JOIN links USING (pmid) LEFT JOIN ft ON ft.pmcid = links.pmcid")
def full_text_attach(spark: SparkSession, d: str) -> DataFrame:
    arts = LI.resolve_ids(_articles(spark, d).select("pmid").distinct(), table(spark, d, "id_links"))
    return LI.attach_full_text(arts, _articles(spark, d).select("pmcid", "pmc_xml")).select("pmid", "pmcid", F.coalesce(F.length("pmc_xml"), F.lit(0)).cast("long").alias("xml_chars"))


@query(f"SELECT count(*) AS n, count(*) FILTER ({_USABLE}) AS n_full, count(pmcid) AS n_linked FROM articles")
def fulltext_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _articles(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count_if(TX.xml_usable(F.col("pmc_xml"))).alias("n_full"), F.count("pmcid").alias("n_linked"))


@query("SELECT pmid, 'PMC' || pmc_numeric_id AS raw, replace('PMC' || pmc_numeric_id, 'PMC', '') AS clean FROM id_links")
def pmcid_normalize(spark: SparkSession, d: str) -> DataFrame:
    raw = TX.pmc_prefixed(F.col("pmc_numeric_id"))
    return table(spark, d, "id_links").select("pmid", raw.alias("raw"), TX.pmc_bare(raw).alias("clean"))


@query(f"WITH t AS (SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS x FROM documents), v AS (SELECT doc_id, {_variants('x')} AS variant FROM t) SELECT DISTINCT doc_id, variant FROM v")
def full_text_scan_escaped(spark: SparkSession, d: str) -> DataFrame:
    """Text as it stands inside serialized markup: a substitution's '>' is an entity there and never matches."""
    return table(spark, d, "documents").select("doc_id", F.explode(V.variants_in(TX.xml_escape(F.col("text")))).alias("variant"))


_XML_SAFE = "regexp_replace({}, '[\\x{{0}}-\\x{{8}}\\x{{B}}\\x{{C}}\\x{{E}}-\\x{{1F}}\\x{{FFFE}}\\x{{FFFF}}]', '', 'g')"


def _article_xml(sections: Column, title: Column) -> Column:
    """An article element with an inline mark in its title and a mark at the end of every section."""
    safe = lambda c: F.regexp_replace(TX.xml_escape(c), r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{FFFE}\x{FFFF}]", "")
    body = F.array_join(F.transform(sections, lambda s: F.concat(F.lit("<AbstractText>"), safe(s), F.lit("<i>in</i> after</AbstractText>"))), "")
    return F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), F.col("__id").cast("string"), F.lit("</PMID></MedlineCitation><ArticleTitle>"), safe(title), F.lit("<b>bold</b></ArticleTitle><Abstract>"), body, F.lit("</Abstract></PubmedArticle>"))


@query(f"""SELECT pmid, replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS title, nullif(regexp_replace(replace(replace(a, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '^\\s+|\\s+$', '', 'g'), '') AS abstract
  FROM (SELECT DISTINCT pmid, {_XML_SAFE.format("coalesce(title, '')")} AS t, {_XML_SAFE.format("coalesce(abstract, '')")} AS a FROM articles WHERE pmid <> '')""")
def xml_leading_text(spark: SparkSession, d: str) -> DataFrame:
    """Titles and abstracts written as markup and read again: only what stands before the first inline mark is kept."""
    from litengine.sources.xmlshred import article_fields

    arts = _articles(spark, d).select("pmid", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("abstract", F.lit("")).alias("abstract")).filter("pmid <> ''").distinct()
    return article_fields(arts.withColumn("__id", F.col("pmid")).select(_article_xml(F.array("abstract"), F.col("title")).alias("xml")), "xml")


@query(f"""SELECT doc_id, nullif(regexp_replace(array_to_string(list_filter(string_split(t, chr(10)), lambda x: x <> ''), ' '), '^\\s+|\\s+$', '', 'g'), '') AS abstract
  FROM (SELECT doc_id, replace(replace({_XML_SAFE.format("text")}, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM documents WHERE text IS NOT NULL)""")
def abstract_assembly(spark: SparkSession, d: str) -> DataFrame:
    """A text's lines as the sections of an article, read by the article reader: those that are not empty, joined by one blank; nothing left gives null."""
    from litengine.sources.xmlshred import article_fields

    lines = F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n")
    docs = table(spark, d, "documents").filter("text is not null").select(F.col("doc_id").alias("__id"), lines.alias("lines"))
    read = article_fields(docs.select(_article_xml(F.col("lines"), F.lit("")).alias("xml")), "xml")
    return read.select(F.col("pmid").cast("long").alias("doc_id"), "abstract")


# --- assertions ---------------------------------------------------------------------------------


@query("SELECT DISTINCT uid, clinical_significance FROM assertions_flat WHERE clinical_significance IN ('Pathogenic', 'Likely pathogenic')")
def significance_filter(spark: SparkSession, d: str) -> DataFrame:
    return AS.significant(table(spark, d, "assertions_flat"), LEVELS).select("uid", "clinical_significance").distinct()


@query(r"SELECT DISTINCT regexp_replace(unnest(string_split(genes, ',')), '^\s+|\s+$', '', 'g') AS gene FROM assertions_flat WHERE clinical_significance IN ('Pathogenic', 'Likely pathogenic')")
def clinvar_gene_explode(spark: SparkSession, d: str) -> DataFrame:
    return AS.significant(table(spark, d, "assertions_flat"), LEVELS).select(AS.curated_genes().alias("gene")).distinct()


_DOC = """docs AS (SELECT raw_id, CASE WHEN json_type(p) = 'ARRAY' THEN json_extract(p, '$[0]') ELSE p END AS p FROM (
  SELECT raw_id, CASE WHEN json_type(q) = 'VARCHAR' THEN CAST(json_extract_string(q, '$') AS JSON) ELSE q END AS p FROM (
    SELECT raw_id, CAST(payload AS JSON) AS q FROM assertions_nested WHERE json_valid(payload)))),
d1 AS (SELECT *, coalesce(json_extract(p, '$.germline_classification'), json_extract(p, '$.clinical_significance')) AS g0, json_extract(p, '$.variation_set') AS vs0, json_extract(p, '$.genes') AS ge0 FROM docs),
d2 AS (SELECT raw_id, p, CASE WHEN json_type(g0) = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(g0, '$')) THEN CAST(json_extract_string(g0, '$') AS JSON) END ELSE g0 END AS g,
  CASE json_type(vs0) WHEN 'ARRAY' THEN json_extract(vs0, '$[0]') WHEN 'OBJECT' THEN vs0 END AS v, coalesce(json_extract(ge0, '$.gene'), ge0) AS ge FROM d1),
d3 AS (SELECT *, coalesce(json_extract(v, '$.variation_loc'), json_extract(v, '$.coordinates')) AS lo, coalesce(json_extract(g, '$.trait_set'), json_extract(g, '$.traits')) AS t0 FROM d2),
d4 AS (SELECT *, coalesce(json_extract(t0, '$.trait'), t0) AS tr FROM d3),
d5 AS (SELECT raw_id, p, v, g, GENES AS genes, LOCS AS locs, TRAITS AS traits FROM d4)"""
for _a, _b in (("GENES", "ge"), ("LOCS", "lo"), ("TRAITS", "tr")):
    _DOC = _DOC.replace(f" {_a} ", f" CASE json_type({_b}) WHEN 'ARRAY' THEN CAST({_b} AS JSON[]) WHEN 'OBJECT' THEN [{_b}] ELSE CAST([] AS JSON[]) END ")


def _js(node: str, *paths: str) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string({node}, '{p}')" for p in paths) + ", NULL)"


def _jl(items: str, value: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN array_to_string(list_transform({items}, lambda x: coalesce({value}, 'None')), ', ') END"


def _jstrings(node: str, path: str) -> str:
    at = f"json_extract({node}, '{path}')"
    return f"(CASE json_type({at}) WHEN 'ARRAY' THEN list_transform(CAST({at} AS JSON[]), lambda y: json_extract_string(y, '$')) WHEN 'NULL' THEN CAST([] AS VARCHAR[]) ELSE CASE WHEN {at} IS NULL THEN CAST([] AS VARCHAR[]) ELSE [json_extract_string({at}, '$')] END END)"


def _coord(assembly: str, field: str) -> str:
    return f"json_extract_string(list_filter(locs, lambda x: {_js('x', '$.assembly_name', '$.assembly')} = '{assembly}')[1], '$.{field}')"


_XREFS = """flatten(list_transform(traits, lambda t: list_transform(CASE json_type(json_extract(t, '$.trait_xrefs')) WHEN 'ARRAY' THEN CAST(json_extract(t, '$.trait_xrefs') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(t, '$.trait_xrefs')] ELSE CAST([] AS JSON[]) END,
  lambda x: coalesce(json_extract_string(x, '$.db_source'), json_extract_string(x, '$.db'), 'None') || ':' || coalesce(json_extract_string(x, '$.db_id'), json_extract_string(x, '$.id'), 'None'))))"""
_FLAT_SQL = {
    **{k: _js("p", f"$.{k}") for k in ("uid", "accession", "accession_version", "title", "protein_change")},
    "variant_type": _js("p", "$.obj_type", "$.variant_type"),
    **{k: _js("v", f"$.{k}") for k in ("variation_name", "measure_id", "cdna_change", "canonical_spdi")},
    "aliases": _jl(_jstrings("v", "$.aliases"), "x"),
    "genes": _jl("genes", "json_extract_string(x, '$.symbol')"),
    "gene_ids": _jl("genes", _js("x", "$.GeneID", "$.gene_id")),
    **{f"{f}{s}": _coord(f"GRCh{s}", f) for s in ("38", "37") for f in ("chr", "start", "stop")},
    "clinical_significance": _js("g", "$.description"),
    "review_status": _js("g", "$.review_status"),
    "last_evaluated": _js("g", "$.last_evaluated"),
    "trait_names": _jl("traits", "json_extract_string(x, '$.trait_name')"),
    "trait_ids": f"CASE WHEN len({_XREFS}) > 0 THEN array_to_string({_XREFS}, ', ') END",
    "molecular_consequences": _jl(_jstrings("p", "$.molecular_consequence_list"), "x"),
    "scv": _jl(_jstrings("p", "$.supporting_submissions.scv"), "x"),
    "rcv": _jl(_jstrings("p", "$.supporting_submissions.rcv"), "x"),
}


def _flat_sql(*names: str) -> str:
    return f"WITH {_DOC} SELECT raw_id, " + ", ".join(f"{_FLAT_SQL[n]} AS {n}" for n in names) + " FROM d5"


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return AS.parse_nested(table(spark, d, "assertions_nested"))


@query(f"""WITH {_DOC} SELECT raw_id, {_js('p', '$.uid')} AS uid, {_js('v', '$.variation_name')} AS variation_name, CAST(len(genes) AS BIGINT) AS n_genes, CAST(len(locs) AS BIGINT) AS n_coordinates,
  CAST(len(traits) AS BIGINT) AS n_traits, {_js('g', '$.description')} AS description FROM d5""")
def assertion_parse_nested(spark: SparkSession, d: str) -> DataFrame:
    n = {"n_genes": "genes", "n_coordinates": "coordinates", "n_traits": "clinical_significance.traits"}
    return _parsed(spark, d).select("raw_id", "uid", "variation_name", *(F.size(c).cast("long").alias(a) for a, c in n.items()), F.col("clinical_significance.description").alias("description"))


@query(_flat_sql(*AS.FLAT_COLUMNS))
def assertion_flatten(spark: SparkSession, d: str) -> DataFrame:
    return AS.flatten_parsed(_parsed(spark, d))


@query(_flat_sql("chr38", "start38", "stop38", "chr37", "start37", "stop37"))
def assembly_pivot(spark: SparkSession, d: str) -> DataFrame:
    return AS.flatten_parsed(_parsed(spark, d)).select("raw_id", "chr38", "start38", "stop38", "chr37", "start37", "stop37")


@query(f"WITH {_DOC} SELECT raw_id, unnest({_XREFS}) AS xref FROM d5")
def trait_xref_flatten(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).select("raw_id", F.explode(AS.trait_ids(F.col("clinical_significance"))).alias("xref"))


@query(_flat_sql("genes", "gene_ids"))
def gene_string_agg(spark: SparkSession, d: str) -> DataFrame:
    return AS.flatten_parsed(_parsed(spark, d)).select("raw_id", "genes", "gene_ids")


# --- sets and joins -----------------------------------------------------------------------------


@query(f"WITH {_MENTIONS} SELECT DISTINCT etype, name FROM ment")
def distinct_entities(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).select("etype", "name").distinct()


def _names(spark: SparkSession, d: str, etype: str, origin: str) -> DataFrame:
    return _mentions(spark, d).filter((F.col("etype") == etype) & (F.col("origin") == origin)).select("name")


@query(f"WITH {_MENTIONS} SELECT name FROM pres WHERE etype = 'gene' AND a AND c")
def gene_intersect(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d, "gene", "abstract").intersect(_names(spark, d, "gene", "curated"))


def _except(etype: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        p = RE.presence(_mentions(spark, d).filter(F.col("etype") == etype))
        a, f, c = F.col("a"), F.col("f"), F.col("c")
        sides = F.filter(F.array(F.when(a & ~c, "abstract - curated"), F.when(c & ~a, "curated - abstract"), F.when(f & ~a, "full_text - abstract")), lambda x: x.isNotNull())
        return p.select("name", F.explode(sides).alias("side"))

    return run


def _except_sql(etype: str) -> str:
    return f"WITH {_MENTIONS} " + " UNION ALL ".join(f"SELECT name, '{s}' AS side FROM pres WHERE etype = '{etype}' AND {r}" for s, r in (("abstract - curated", "a AND NOT c"), ("curated - abstract", "c AND NOT a"), ("full_text - abstract", "f AND NOT a")))


QUERIES |= {"gene_except": _except("gene"), "variant_except": _except("variant")}
SQL |= {"gene_except": _except_sql("gene"), "variant_except": _except_sql("variant")}
_LITGENES = f"WITH {_MENTIONS}, cg AS (SELECT DISTINCT name FROM cur WHERE etype = 'gene') SELECT pmid, name FROM mentions_lit WHERE etype = 'gene' AND origin = 'abstract'"


def _lit_genes(spark: SparkSession, d: str) -> DataFrame:
    arts = _articles(spark, d).filter(F.col("abstract") != "")
    return arts.select("pmid", F.explode(F.array_distinct(V.acronyms_in(F.col("abstract")))).alias("name")).distinct()


@query(f"{_LITGENES} AND name IN (SELECT name FROM cg)")
def gene_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return _lit_genes(spark, d).join(_names(spark, d, "gene", "curated").distinct(), "name", "left_semi").select("pmid", "name")


@query(f"{_LITGENES} AND name NOT IN (SELECT name FROM cg)")
def gene_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return _lit_genes(spark, d).join(_names(spark, d, "gene", "curated").distinct(), "name", "left_anti").select("pmid", "name")


@query(f"WITH {_MENTIONS}, bag AS (SELECT origin, etype FROM mentions_lit UNION ALL SELECT origin, etype FROM cur) SELECT origin, etype, count(*) AS n FROM bag GROUP BY 1, 2")
def bag_union(spark: SparkSession, d: str) -> DataFrame:
    lit = LI.mentions(LI.fetched_once(_articles(spark, d))).distinct().drop("pmid")
    return lit.unionByName(AS.curated_mentions(_curated(spark, d), LEVELS), allowMissingColumns=True).groupBy("origin", "etype").agg(F.count(F.lit(1)).alias("n"))


# --- validation ---------------------------------------------------------------------------------

_RUNS = "runs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY loaded_at DESC) AS rn FROM candidates) WHERE rn = 1)"
_LISTS = [*RE.BUCKET_KEYS, "pmids"]
_ITEMS = f"{_RUNS}, items AS (SELECT run_id, bucket, bucket_ord, i - 1 AS pos, l[i] AS item FROM (" + " UNION ALL ".join(
    f"SELECT run_id, '{b}' AS bucket, {i + 1} AS bucket_ord, {b} AS l, unnest(range(1, len({b}) + 1)) AS i FROM runs" for i, b in enumerate(_LISTS)
) + ") WHERE l[i] IS NOT NULL)"
ASCII_LENGTH = "length(to_json(x)) + 5 * length(regexp_replace(x, '[^\\x{7F}-\\x{FFFF}]', '', 'g')) + 11 * length(regexp_replace(x, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return AS.latest(table(spark, d, "candidates"), "run_id")


@query(f"WITH {_ITEMS} SELECT run_id, bucket, bucket_ord, CAST(pos AS INTEGER) AS pos, item FROM items")
def candidate_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return VA.unpivot(_runs(spark, d))


@query(f"SELECT doc_id, CAST(greatest(1, length(x) // 4) AS INTEGER) AS tokens, CAST(greatest(1, ({ASCII_LENGTH}) // 4) + 50 AS INTEGER) AS item_cost, CAST(trunc(greatest(1, length(x) // 4) * 1.1) AS INTEGER) AS listed FROM (SELECT doc_id, text AS x FROM documents)")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    t = TK.estimate(F.length("text"))
    return table(spark, d, "documents").select("doc_id", t.alias("tokens"), TK.item_cost(F.col("text")).alias("item_cost"), TK.list_cost(t).alias("listed"))


_AVAILABLE = TK.budget(1024, "Pancreatic cancer")


@query(f"""WITH RECURSIVE {_ITEMS}, cost AS (SELECT run_id, bucket, pos, item, row_number() OVER (PARTITION BY run_id ORDER BY bucket_ord, pos) AS k,
  CAST(greatest(1, ({ASCII_LENGTH}) // 4) + 50 AS INTEGER) AS cost FROM (SELECT *, item AS x FROM items)),
walk AS (SELECT run_id, k, 0 AS chunk_id, cost AS used FROM cost WHERE k = 1 UNION ALL
  SELECT c.run_id, c.k, CASE WHEN w.used + c.cost > {_AVAILABLE} AND w.used > 0 THEN w.chunk_id + 1 ELSE w.chunk_id END,
    CASE WHEN w.used + c.cost > {_AVAILABLE} AND w.used > 0 THEN c.cost ELSE w.used + c.cost END FROM walk w JOIN cost c ON c.run_id = w.run_id AND c.k = w.k + 1)
SELECT c.run_id, bucket, CAST(pos AS INTEGER) AS pos, item, cost, chunk_id FROM cost c JOIN walk w ON c.run_id = w.run_id AND c.k = w.k""")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    return VA.pack(VA.unpivot(_runs(spark, d)), _AVAILABLE).select("run_id", "bucket", "pos", "item", "cost", "chunk_id")


def _verdict_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verdicts").select("run_id", "chunk_no", F.to_json(F.struct(*VA.CLASSES, "notes"), {"ignoreNullFields": "false"}).alias("text"))


@query(" UNION ALL ".join(f"SELECT run_id, chunk_no, '{c}' AS class, unnest({c}) AS name FROM verdicts" for c in VA.CLASSES))
def verdict_parse(spark: SparkSession, d: str) -> DataFrame:
    v = _verdict_text(spark, d).select("run_id", "chunk_no", VA.parse_verdict(F.col("text")).alias("v"))
    return v.select("run_id", "chunk_no", F.explode(F.array(*(F.struct(F.lit(c).alias("class"), F.col(f"v.{c}").alias("l")) for c in VA.CLASSES))).alias("x")).select("run_id", "chunk_no", "x.class", F.explode("x.l").alias("name"))


@query("SELECT run_id, chunk_no, " + ", ".join(f"CAST(coalesce(len({c}), 0) AS BIGINT) AS n_{c}" for c in VA.CLASSES) + " FROM verdicts")
def verdict_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verdicts").select("run_id", "chunk_no", *(F.coalesce(F.array_size(c), F.lit(0)).cast("long").alias(f"n_{c}") for c in VA.CLASSES))


def _ascii_json(x: str) -> str:
    """A JSON string with everything beyond ASCII escaped."""
    four = lambda n: f"'{chr(92)}u' || lpad(lower(to_hex({n})), 4, '0')"
    return f"""array_to_string(list_transform(string_split(CAST(to_json({x}) AS VARCHAR), ''), lambda ch: CASE WHEN ord(ch) > 65535 THEN {four("55296 + ((ord(ch) - 65536) >> 10)")} || {four("56320 + ((ord(ch) - 65536) & 1023)")}
      WHEN ord(ch) > 126 THEN {four("ord(ch)")} ELSE ch END), '')"""


def _json_lines(c: str) -> str:
    """A list as it stands in a rendering indented by two blanks."""
    return f"""CASE WHEN {c} IS NULL THEN 'null' WHEN len({c}) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform({c}, lambda x: '    ' || CASE WHEN x IS NULL THEN 'null' ELSE {_ascii_json('x')} END), ',' || chr(10)) || chr(10) || '  ]' END"""


@query("SELECT run_id, chunk_no, '{' || chr(10) || " + " || ',' || chr(10) || ".join([*(f"'  \"{c}\": ' || {_json_lines(c)}" for c in VA.CLASSES), "'  \"notes\": ' || CASE WHEN notes IS NULL THEN 'null' ELSE {} END".format(_ascii_json("notes"))]) + " || chr(10) || '}' AS text FROM verdicts")
def verdict_to_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verdicts").select("run_id", "chunk_no", RP.indented_json([*VA.CLASSES, "notes"]).alias("text"))


_MERGED = """base AS (SELECT run_id, count(*) AS chunk_count, count(*) FILTER (ok) AS successful_chunks,
  coalesce(string_agg(CASE WHEN ok AND notes <> '' THEN substr(notes, 1, greatest(length(notes) - 1, 0)) END, ' | ' ORDER BY chunk_no, notes), '') AS notes FROM
  (SELECT *, (confirmed IS NOT NULL OR uncertain IS NOT NULL OR rejected IS NOT NULL OR not_assessed IS NOT NULL OR notes IS NOT NULL) AND error IS NULL AS ok FROM verdicts) GROUP BY 1)"""


@query(f"WITH {_MERGED}, named AS (" + " UNION ALL ".join(f"SELECT run_id, '{c}' AS class, unnest({c}) AS name FROM verdicts WHERE error IS NULL" for c in VA.CLASSES) + """)
, lists AS (SELECT run_id, class, string_agg(DISTINCT name, '|' ORDER BY name) AS l FROM named WHERE name IS NOT NULL GROUP BY 1, 2)
SELECT base.run_id, chunk_count, successful_chunks, CASE WHEN notes = '' THEN 'Processed all chunks successfully.' ELSE notes END AS notes, """ + ", ".join(f"coalesce((SELECT l FROM lists WHERE lists.run_id = base.run_id AND class = '{c}'), '') AS {c}" for c in VA.CLASSES) + " FROM base")
def verdict_merge(spark: SparkSession, d: str) -> DataFrame:
    m = VA.merge(table(spark, d, "verdicts"), ("run_id",))
    return m.select("run_id", "chunk_count", "successful_chunks", "notes", *(F.array_join(c, "|").alias(c) for c in VA.CLASSES))


_STATUS = "st AS (SELECT run_id, name, min(rank) AS rank FROM (" + " UNION ALL ".join(f"SELECT run_id, {i + 1} AS rank, unnest({c}) AS name FROM verdicts" for i, c in enumerate(VA.CLASSES[:3])) + ") GROUP BY 1, 2)"
_STATUS_CASE = "CASE rank WHEN 1 THEN 'Confirmed' WHEN 2 THEN 'Uncertain' WHEN 3 THEN 'Rejected' ELSE 'Not assessed' END"


@query(f"WITH {_ITEMS}, {_STATUS} SELECT i.run_id, bucket, CAST(pos AS INTEGER) AS pos, i.item AS name, {_STATUS_CASE} AS status FROM items i LEFT JOIN st ON st.run_id = i.run_id AND st.name = CASE WHEN starts_with(bucket, 'variants') AND regexp_extract(item, '{V.GENE_IN_VARIANT}', 1) <> '' THEN regexp_extract(item, '{V.GENE_IN_VARIANT}', 1) ELSE item END")
def status_lookup(spark: SparkSession, d: str) -> DataFrame:
    items = VA.unpivot(_runs(spark, d)).withColumnRenamed("item", "name")
    return VA.with_status(items, table(spark, d, "verdicts"), ("run_id",), is_variant=F.startswith("bucket", F.lit("variants"))).select("run_id", "bucket", "pos", "name", "status")


_REPORT = f"upper(etype[1]) || etype[2:] AS \"Entity Type\", buck.name AS \"Entity Name\", CASE WHEN etype = 'gene' THEN '' WHEN regexp_extract(buck.name, '{V.GENE_IN_VARIANT}', 1) <> '' THEN regexp_extract(buck.name, '{V.GENE_IN_VARIANT}', 1) ELSE buck.name END AS \"Associated Gene\", source AS \"Source\", note AS \"Notes\", bucket_ord"


@query(f"WITH {_MENTIONS}, {_BUCKETS}, {_STATUS}, s1 AS (SELECT name, min(rank) AS rank FROM st GROUP BY 1) SELECT {_REPORT}, {_STATUS_CASE} AS \"Perplexity Status\" FROM buck LEFT JOIN s1 ON s1.name = CASE WHEN etype = 'variant' AND regexp_extract(buck.name, '{V.GENE_IN_VARIANT}', 1) <> '' THEN regexp_extract(buck.name, '{V.GENE_IN_VARIANT}', 1) ELSE buck.name END")
def report_labels(spark: SparkSession, d: str) -> DataFrame:
    return RP.report(RE.buckets(_mentions(spark, d)), table(spark, d, "verdicts"))


@query(f"WITH {_MENTIONS}, {_BUCKETS} SELECT {_REPORT} FROM buck")
def report_no_verdict(spark: SparkSession, d: str) -> DataFrame:
    return RP.report(RE.buckets(_mentions(spark, d)))


_MESSAGE = "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'HTTP 429' WHEN event_type = 'error' THEN 'HTTP 401' WHEN event_type = 'view' THEN 'Timeout' ELSE 'ok' END"


@query(f"SELECT event_id, lower({_MESSAGE}) SIMILAR TO '.*(rate limit|429|timeout|connection|503|502).*' AS retriable FROM events")
def retriable_classifier(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", TX.is_retriable(F.expr(_MESSAGE)).alias("retriable"))


@query("SELECT attempt, base, base * pow(2, attempt) AS delay FROM (SELECT unnest(range(0, 5)) AS attempt), (SELECT DISTINCT CAST(l_linenumber AS DOUBLE) AS base FROM lineitem)")
def backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Delays without the jitter, for each base delay, as the retry combinator makes them."""
    bases = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("base")).distinct()
    return bases.select("base", F.posexplode(RT.delay_columns(F.col("base"), 6)).alias("attempt", "delay")).select(F.col("attempt").cast("long").alias("attempt"), "base", "delay")


# --- problems 3 and 4 ---------------------------------------------------------------------------

#: Child tables of both generations of keys, by the last key of their path below the right parent.
CHILDREN = {
    "$.variation_set.variation_loc": "coordinate",
    "$.variation_set.coordinates": "coordinate",
    "$.genes": "gene",
    "$.germline_classification.trait_set": "trait",
    "$.clinical_significance.traits": "trait",
    "$.germline_classification.trait_set.trait_xrefs": "trait_xref",
    "$.clinical_significance.traits.trait_xrefs": "trait_xref",
}


def _each(relation: str, keep: str, items: str, name: str) -> str:
    """Rows of `relation` for every element of a list of JSON: kept columns, the element and its ordinal from 0."""
    return f"(SELECT {keep}, l[i + 1] AS {name}, i AS {name}_pos FROM (SELECT *, unnest(range(len(l))) AS i FROM (SELECT {keep}, {items} AS l FROM {relation})))"


def _list_of(node: str) -> str:
    return f"CASE json_type({node}) WHEN 'ARRAY' THEN CAST({node} AS JSON[]) WHEN 'OBJECT' THEN [{node}] ELSE CAST([] AS JSON[]) END"


_CHILD = "SELECT raw_id, '{}' AS child, CAST({} AS INTEGER) AS parent_pos, CAST({} AS INTEGER) AS child_pos, {} AS child_value FROM {} WHERE json_type({}) = 'OBJECT' AND len(json_keys({})) > 0"
_P3 = f"WITH {_DOC} " + " UNION ALL ".join(
    _CHILD.format(child, parent, f"{x}_pos", value, relation, x, x)
    for child, parent, x, value, relation in (
        ("coordinate", "v_pos", "c", "coalesce(json_extract_string(c, '$.assembly_name'), json_extract_string(c, '$.assembly'), '')",
         _each(_each("d1", "raw_id", _list_of("vs0"), "v"), "raw_id, v_pos", _list_of("coalesce(json_extract(v, '$.variation_loc'), json_extract(v, '$.coordinates'))"), "c")),
        ("gene", "0", "x", "coalesce(json_extract_string(x, '$.symbol'), '')", _each("d4", "raw_id", _list_of("ge"), "x")),
        ("trait", "0", "t", "coalesce(json_extract_string(t, '$.trait_name'), '')", _each("d4", "raw_id", _list_of("tr"), "t")),
        ("trait_xref", "t_pos", "x", "coalesce(json_extract_string(x, '$.db_source'), json_extract_string(x, '$.db'), '') || ':' || coalesce(json_extract_string(x, '$.db_id'), json_extract_string(x, '$.id'), '')",
         _each(_each("d4", "raw_id", _list_of("tr"), "t"), "raw_id, t_pos", _list_of("json_extract(t, '$.trait_xrefs')"), "x")),
    )
)


@query(_P3)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = NE.shred(table(spark, d, "assertions_nested"), "raw_id", "payload")
    kind = F.element_at(F.create_map(*(F.lit(x) for kv in CHILDREN.items() for x in kv)), F.col("child"))
    at = lambda *keys: F.coalesce(*(F.try_variant_get("node", f"$.{k}", "string") for k in keys), F.lit(""))
    value = (
        F.when(F.col("kind") == "coordinate", at("assembly_name", "assembly"))
        .when(F.col("kind") == "gene", at("symbol"))
        .when(F.col("kind") == "trait", at("trait_name"))
        .otherwise(F.concat(at("db_source", "db"), F.lit(":"), at("db_id", "id")))
    )
    found = rows.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    parent = F.when(F.col("kind").isin("coordinate", "trait_xref"), F.col("parent_pos")).otherwise(0)
    return found.select("raw_id", F.col("kind").alias("child"), parent.cast("int").alias("parent_pos"), F.col("child_pos").cast("int").alias("child_pos"), value.alias("child_value"))


# Forms of aliases that hold a comma: a deleted exon with its length; a gene with an old-style protein change.
ALIAS_FORMS = (r"EX\d+DEL, \d+(?:\.\d+)?-KB", r"[A-Z0-9-]{2,12}, [A-Z]{3}\d+(?:[A-Z]{2,3}|=|\*)")
PACKED = ("aliases", "trait_ids", "gene_ids", "trait_names")


#: Trait names the grammar takes from the canonical list; a longer list is an error, no name is left out.
MAX_NAMES = 100_000


def trait_grammar(spark: SparkSession, d: str) -> MV.Grammar:
    """Names with dividers in them are known from the canonical list, whose size is checked before it is collected."""
    names = table(spark, d, "trait_terms").select("trait_name").filter(F.col("trait_name").rlike(MV.DIVIDER.pattern)).distinct().limit(MAX_NAMES + 1).collect()
    if len(names) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} trait names hold dividers")
    return MV.Grammar(vocabulary=tuple(r[0] for r in names))


def split_packed(spark: SparkSession, d: str, fields: tuple[str, ...] = PACKED, flat: DataFrame | None = None) -> DataFrame:
    """One row a value of the packed columns of each assertion."""
    grammars = {"aliases": lambda: MV.Grammar(forms=ALIAS_FORMS), "trait_names": lambda: trait_grammar(spark, d)}
    if flat is None:  # a repeated delivery is the same but for loaded_at
        flat = AS.latest(table(spark, d, "assertions_flat").select("uid", *fields, "loaded_at"))
    return MV.split_cells(flat, ["uid"], {f: grammars.get(f, MV.Grammar)() for f in fields})


@query()
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(spark, d).select("uid", "field_name", "pos", "item")

