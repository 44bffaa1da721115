"""Command line: one disease; remote sources, or tables, in; report out."""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable

from pyspark.sql import functions as F

from litengine.config import SIGNIFICANCE_LEVELS, VALIDATOR_MODELS, WARN_TEMPERATURE, MiningConfig, load_env, parse_bool, validator_key

log = logging.getLogger("litengine")


# Names and defaults of the options.
OPTIONS: tuple[tuple[tuple[str, ...], dict], ...] = (
    (("-q", "--query"), {"required": True, "help": "disease term"}),
    (("-e", "--email"), {"required": True, "help": "sent to remote sources"}),
    (("-o", "--output"), {"help": "report file; .csv for CSV, .csv/ for a folder of CSV files, else text"}),
    (("-s", "--score"), {"type": float, "default": 0.75, "help": "least score of a gene mention"}),
    (("-p", "--perplexity"), {"action": "store_true", "help": "have the candidates validated"}),
    (("--temperature",), {"type": float, "default": 0.2}),
    (("--model",), {"choices": VALIDATOR_MODELS, "default": "sonar-pro"}),
    (("--env-path",), {"help": "file of KEY=VALUE lines"}),
    (("-v", "--verbose"), {"action": "store_true"}),
    (("-r", "--retmax"), {"type": int, "default": 10}),
    (("-c", "--clinical-relevance"), {"nargs": "+", "default": ["Pathogenic", "Likely pathogenic"], "help": f"of {', '.join(SIGNIFICANCE_LEVELS)}"}),
    (("--enable-chunking",), {"type": parse_bool, "default": True}),
    (("--max-concurrent",), {"type": int, "default": 3}),
    (("--max-retries",), {"type": int, "default": 3}),
    (("--max-tokens",), {"type": int, "default": 2048}),
    (("--token-limit",), {"type": int, "default": 4096}),
)
#: Options of this engine alone.
OWN: tuple[tuple[tuple[str, ...], dict], ...] = (
    (("--tables",), {"help": "folder with articles.parquet and assertions_flat.parquet, instead of the remote sources"}),
    (("--transport",), {"help": "module:function that answers for the remote sources"}),
    (("--validator",), {"help": "module:function that judges a chunk, instead of the remote validator"}),
    (("--tagger",), {"default": "auto", "help": "model, pattern, or auto: the model where it is installed"}),
)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="litengine", description=__doc__)
    for names, how in OPTIONS + OWN:
        p.add_argument(*names, **how)
    return p


def config(argv: list[str] | None = None) -> tuple[MiningConfig, argparse.Namespace]:
    """Parsed and checked; a missing validator key is an error before any work is done."""
    a = parser().parse_args(argv)
    load_env(a.env_path)
    cfg = MiningConfig(
        disease_term=a.query, clinical_relevance=tuple(a.clinical_relevance), retmax=a.retmax, min_score=a.score, validate=a.perplexity, temperature=a.temperature, model=a.model,
        enable_chunking=a.enable_chunking, max_concurrent=a.max_concurrent, max_retries=a.max_retries, max_tokens=a.max_tokens, token_limit=a.token_limit,
    ).checked()
    if cfg.validate and not a.validator:
        validator_key()
    if cfg.validate:
        if cfg.temperature > WARN_TEMPERATURE:
            log.warning("a temperature of %s makes verdicts erratic", cfg.temperature)
    return cfg, a


def tagger_of(choice: str) -> Callable | None:
    """The factory of the gene tagger; None: acronyms by pattern."""
    from importlib.util import find_spec

    from litengine.operators import tagging as TG

    if choice == "model" or (choice == "auto" and find_spec("flair") is not None):
        return TG.model_tagger
    if choice == "auto":
        log.warning("no tagger model is installed: genes are acronyms by pattern")
    return None


def validator_of(a: argparse.Namespace, cfg: MiningConfig) -> Callable:
    from litengine.sources.entrez import load_transport
    from litengine.sources.validator import RemoteValidator

    if a.validator:
        return load_transport(a.validator)
    return RemoteValidator(cfg.model, cfg.temperature, cfg.max_tokens, validator_key())


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from litengine.operators import report as RP
    from litengine.operators import validate as VA
    from litengine.plans import pipeline as PL

    logging.basicConfig(level=logging.INFO, format="%(message)s")
    began = time.time()
    try:
        cfg, a = config(argv)
    except ValueError as e:
        log.error("%s", e)
        return 1
    spark = SparkSession.builder.appName("litengine").getOrCreate()
    log.info("searching for %s", cfg.disease_term)
    if a.tables:
        articles, assertions = PL.search(spark.read.parquet(f"{a.tables}/articles.parquet"), spark.read.parquet(f"{a.tables}/assertions_flat.parquet"), cfg)
    else:
        options = {"email": a.email} | ({"transport": a.transport} if a.transport else {})
        articles, assertions = PL.fetch_literature(spark, cfg, options), PL.fetch_assertions(spark, cfg, options)
    articles, assertions = articles.persist(), assertions.persist()  # at most retmax rows, and no remote answer is asked for twice
    found = articles.agg(F.count_distinct("pmid").alias("n"), F.count("pmc_xml").alias("full")).first()
    log.info("%d articles, %d of them with a full text; %d assertions", found["n"], found["full"], assertions.count())
    mined = PL.mine(articles, assertions, cfg, tagger_of(a.tagger))
    verdict, told = None, None
    if cfg.validate:
        try:
            verdict = PL.validated(mined, cfg, validator_of(a, cfg)).persist()
            told = verdict.first().asDict() if not verdict.isEmpty() else None
        except (ImportError, AttributeError, ValueError) as e:  # no validator, or no room for candidates: the report is written without it
            log.error("no verdict: %s", e)
            verdict, told = None, VA.error_verdict(str(e))
    RP.emit(PL.run_report(mined, cfg, verdict), cfg.disease_term, told, a.output, a.verbose)
    log.info("done in %.1f s", time.time() - began)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
