"""Queries of the training-data problems over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litengine.llm import canonical as CA
from litengine.llm import frequency as FR
from litengine.llm import linkage as LK
from litengine.llm.common import entries, runs_once
from litengine.plans.queries import ASCII_LENGTH, trait_grammar
from litengine.runtime import spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def gene_names(spark: SparkSession, d: str) -> DataFrame:
    return CA.vocabulary(table(spark, d, "gene_terms"), "term_id", ["symbol"], ["synonyms"], ["full_name"])


@query()
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    out = CA.map_entries(entries(spark, d), gene_names(spark, d), table(spark, d, "gene_terms").select("symbol"))
    return out.select("run_id", "bucket", "pos", "term_id")


_ENTRIES = """runs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY loaded_at DESC) AS rn FROM candidates WHERE run_id IS NOT NULL) WHERE rn = 1),
e AS (SELECT run_id, unnest(list_concat(coalesce(genes_only_abstract, []), coalesce(genes_only_full_text, []))) AS v FROM runs),
f AS (SELECT upper(trim(v, ' ')) AS item, count(*) AS n_entries, count(DISTINCT run_id) AS n_runs FROM e WHERE v IS NOT NULL AND regexp_replace(v, '\\s+', '', 'g') <> '' GROUP BY 1),
m AS (SELECT *, CASE WHEN n_runs > 0.05 * (SELECT count(*) FROM runs) AND n_runs >= 5 THEN 'common' WHEN n_runs <= 2 THEN 'rare' END AS mark FROM f)"""


def value_frequencies(spark: SparkSession, d: str) -> DataFrame:
    values = entries(spark, d).filter(F.regexp_replace("value", r"\s+", "") != "").select("run_id", F.upper(F.trim("value")).alias("item"))
    n = table(spark, d, "candidates").agg(F.count_distinct("run_id")).first()[0]
    return FR.marked(FR.frequencies(values, "item", "run_id"), n)


@query(f"WITH {_ENTRIES} SELECT item, n_entries, n_runs, mark FROM m WHERE mark IS NOT NULL")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return value_frequencies(spark, d).filter("mark is not null").select("item", "n_entries", "n_runs", "mark")


@query(f"WITH {_ENTRIES} SELECT item, n_entries, n_runs, mark FROM m")
def p6_all_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value, also those without a mark."""
    return value_frequencies(spark, d)


def variant_beliefs(spark: SparkSession, d: str, only_matches: bool = True) -> DataFrame:
    vocabulary = gene_names(spark, d).filter(F.size("tokens") == 1)
    names = vocabulary.groupBy(F.get("tokens", F.lit(0)).alias("name")).agg(F.min("term_id").alias("gene"))
    transcripts = table(spark, d, "gene_terms").select(F.regexp_replace("transcript", r"\.\d+$", "").alias("transcript"), F.col("term_id").alias("gene")).filter("transcript is not null").groupBy("transcript").agg(F.min("gene").alias("gene"))
    # deliveries of a record differ in loaded_at alone
    flat = table(spark, d, "assertions_flat").select("uid", "variation_name", "cdna_change", "protein_change", "genes", "trait_names").filter("uid is not null").distinct()
    records = LK.resolve_gene(LK.read_records(spread(flat), trait_grammar(spark, d)), ["uid"], names, transcripts)
    runs = runs_once(spark, d, "variants_only_text", "summary")
    said = runs.select("run_id", F.col("summary.disease_query").alias("trait"), F.posexplode("variants_only_text").alias("pos", "value"))
    return (LK.match if only_matches else LK.beliefs)(said, records, names, transcripts)


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_beliefs(spark, d).select("run_id", "pos", "uid")


@query()
def p5_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Every entry that has a candidate, with its likeliest record, the marginal probability, and whether the exact check holds."""
    return variant_beliefs(spark, d, only_matches=False)


def test_items(spark: SparkSession, d: str) -> list[tuple[int, str | None]]:
    return [(r[0], r[1]) for r in table(spark, d, "eval_items").select("item_id", "item_text").collect()]  # a fixed list of 240


@query()
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    from litengine.llm import leakage as LE

    return LE.leaks(table(spark, d, "documents"), test_items(spark, d)).select("doc_id", "item_id")


@query()
def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where the items stand in the documents."""
    from litengine.llm import leakage as LE

    return LE.spans(table(spark, d, "documents"), test_items(spark, d))


@query()
def p8_removed(spark: SparkSession, d: str) -> DataFrame:
    """The texts of documents that held items, without them."""
    from litengine.llm import leakage as LE

    return LE.remove_spans(table(spark, d, "documents"), test_items(spark, d))


@query()
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from litengine.llm import readability as RD

    docs = table(spark, d, "documents")
    return RD.bands(docs, RD.learn(docs, table(spark, d, "reading_labels"), RD.learn_language(docs)))


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of 512 characters: most abstracts are several, so boundaries come out of the composition."""
    from litengine.llm import sentences as SE

    arts = table(spark, d, "articles").filter("pmid is not null and abstract is not null").select("pmid", "abstract")
    once = arts.groupBy("pmid").agg(F.max("abstract").alias("abstract"))
    return SE.sentences(once, "pmid", "abstract", chunk=512, learned=SE.learn_abbreviations(once, "abstract"))


@query()
def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Entries of the runs for every budget, pieces of those that exceed it, each with its cost and its container."""
    from litengine.functions import tokens as TK
    from litengine.llm import packing as PK

    values = entries(spark, d).filter(F.regexp_replace("value", r"\s+", "") != "")
    values = values.withColumn("t", TK.estimate(TK.ascii_json_length(F.col("value"))))
    budgets = table(spark, d, "pack_budgets").filter("token_limit > 0").select("budget_id", "token_limit", F.coalesce("item_overhead", F.lit(0)))
    out = PK.pack(values, ["run_id"], "t", ["bucket", "pos"], [tuple(r) for r in budgets.collect()])  # a fixed list
    return out.select("run_id", "budget_id", "container", "bucket", "pos", "piece", "cost")


_TOTALS = f"""WITH {_ENTRIES}, items AS (SELECT v AS x FROM e WHERE v IS NOT NULL AND regexp_replace(v, '\\s+', '', 'g') <> ''), sized AS (SELECT CAST(greatest(1, ({ASCII_LENGTH}) // 4) AS BIGINT) AS t FROM items),
b AS (SELECT budget_id, coalesce(item_overhead, 0) AS o, token_limit - coalesce(item_overhead, 0) AS room FROM pack_budgets WHERE token_limit > coalesce(item_overhead, 0)),
cut AS (SELECT budget_id, t, o, greatest(1, (t + room - 1) // room) AS n FROM sized, b)
SELECT budget_id, count(*) AS items, CAST(sum(n) AS BIGINT) AS pieces, CAST(sum(t + n * o) AS BIGINT) AS used, count(*) FILTER (n > 1) AS divided, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS gaps FROM cut GROUP BY 1"""


@query(_TOTALS)
def p7_totals(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of any packing: no entry lost or divided without need, no container over its limit, none left out of the numbering."""
    limits = table(spark, d, "pack_budgets").select("budget_id", "token_limit")
    packed = p7_packed(spark, d)
    full = packed.groupBy("run_id", "budget_id", "container").agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("piece") == 0).alias("items"), F.count_if(F.col("piece") == 1).alias("divided"))
    each = full.join(F.broadcast(limits), "budget_id").groupBy("run_id", "budget_id").agg(
        *(F.sum(c).alias(c) for c in ("items", "pieces", "cost", "divided")), F.count_if(F.col("cost") > F.col("token_limit")).alias("overfull"), (F.max("container") + 1 - F.count(F.lit(1))).alias("gaps")
    )
    return each.groupBy("budget_id").agg(*(F.sum(c).alias(c) for c in ("items", "pieces")), F.sum("cost").alias("used"), *(F.sum(c).alias(c) for c in ("divided", "overfull", "gaps")))


@query()
def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """For each budget: containers, the least number that could do (by space alone), and how full they are."""
    limits = table(spark, d, "pack_budgets").select("budget_id", "token_limit")
    per = p7_packed(spark, d).groupBy("run_id", "budget_id").agg(F.count_distinct("container").alias("containers"), F.sum("cost").alias("used")).join(F.broadcast(limits), "budget_id")
    return per.groupBy("budget_id", "token_limit").agg(
        F.sum("containers").alias("containers"), F.sum(F.ceil(F.col("used") / F.col("token_limit"))).alias("least"), (F.sum("used") / F.sum(F.col("containers") * F.col("token_limit"))).alias("fill")
    )


@query()
def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    from litengine.llm import mixing as MX

    return MX.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


@query()
def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached."""
    from litengine.llm import mixing as MX

    return MX.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]
