"""Remote literature and assertion sources as a Python data source.

The transport is a parameter: a callable (endpoint, parameters) → text, given by name as 'module:function', so that a reader can be
pickled and tests need no network. A partition is a batch of ids: N + 1 lookups become one request a batch. What is looked up for rows
that are there already (links, full texts) is a DataFrame operation over them, in Arrow batches.
"""

from __future__ import annotations

import importlib
import json
import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from litengine.functions.text import pmc_bare, shortened
from litengine.sources.retry import retrying
from litengine.sources.xmlshred import _parse, shred_article

log = logging.getLogger("litengine")
#: A parameter that is a list is sent once for each of its values.
Transport = Callable[[str, dict[str, str | list[str]]], str]
BASE = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"


def http_transport(endpoint: str, params: dict[str, str | list[str]]) -> str:
    from urllib.parse import urlencode
    from urllib.request import urlopen

    with urlopen(f"{BASE}/{endpoint}.fcgi?{urlencode(params, doseq=True)}", timeout=60) as r:
        return r.read().decode("utf-8")


def load_transport(name: str | None) -> Transport:
    if not name:
        return http_transport
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def search_ids(transport: Transport, db: str, term: str, retmax: int, common: dict[str, str], attempts: int = 5) -> list[str]:
    """Ids in the server's order; [] where it names none."""
    text = retrying(lambda: transport("esearch", common | {"db": db, "term": term, "retmax": str(retmax), "retmode": "json"}), attempts, base=2.0)
    return json.loads(text).get("esearchresult", {}).get("idlist", [])


class Batch(InputPartition):
    def __init__(self, ids: list[str], first_rank: int) -> None:
        self.ids, self.first_rank = ids, first_rank


class EntrezReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.o = {k.lower(): v for k, v in options.items()}
        self.transport = load_transport(self.o.get("transport"))
        self.common = {k: self.o[k] for k in ("email", "api_key", "tool") if k in self.o}
        self.attempts = int(self.o.get("max_retries", "5"))

    def partitions(self) -> list[Batch]:
        ids = search_ids(self.transport, self.o.get("db", "pubmed"), self.o.get("term", ""), int(self.o.get("retmax", "500")), self.common, self.attempts)
        n = int(self.o.get("batch", "100"))
        return [Batch(ids[a : a + n], a) for a in range(0, len(ids), n)] or [Batch([], 0)]


class ArticleReader(EntrezReader):
    def read(self, partition: Batch) -> Iterator[tuple]:
        """Whole answers that can't be parsed give no row, nor do records without an id."""
        if not partition.ids:
            return
        xml = retrying(lambda: self.transport("efetch", self.common | {"db": "pubmed", "id": ",".join(partition.ids), "retmode": "xml"}), self.attempts, base=2.0)
        root = _parse(xml)
        ranks = {x: partition.first_rank + i for i, x in enumerate(partition.ids)}
        for node in root.iter("PubmedArticle") if root is not None else ():
            got = shred_article(node, self.o.get("text_mode", "leading"))
            if got:
                yield (ranks.get(got[0]), *got)


class SummaryReader(EntrezReader):
    def read(self, partition: Batch) -> Iterator[tuple]:
        if not partition.ids:
            return
        text = retrying(lambda: self.transport("esummary", self.common | {"db": self.o.get("db", "clinvar"), "id": ",".join(partition.ids), "retmode": "json"}), self.attempts, base=2.0)
        docs = json.loads(text).get("result", {})
        for i, uid in enumerate(partition.ids):
            if uid in docs:
                yield (partition.first_rank + i, uid, json.dumps(docs[uid] | {"uid": uid}))


class ArticleSource(DataSource):
    """Options: term, retmax, email, api_key, tool, batch, max_retries, transport, text_mode."""

    @classmethod
    def name(cls) -> str:
        return "litengine_articles"

    def schema(self) -> str:
        return "rank int, pmid string, title string, abstract string"

    def reader(self, schema) -> ArticleReader:  # noqa: ANN001
        return ArticleReader(self.options)


class AssertionSource(DataSource):
    """As ArticleSource; a row is a raw nested record as JSON."""

    @classmethod
    def name(cls) -> str:
        return "litengine_assertions"

    def schema(self) -> str:
        return "rank int, uid string, payload string"

    def reader(self, schema) -> SummaryReader:  # noqa: ANN001
        return SummaryReader({"db": "clinvar"} | dict(self.options))


class RecordReader(EntrezReader):
    def read(self, partition: Batch) -> Iterator[tuple]:
        """One answer a record, as the server wrote it; one that can't be parsed gives a null record."""
        for i, uid in enumerate(partition.ids):
            xml = retrying(lambda uid=uid: self.transport("efetch", self.common | {"db": self.o.get("db", "clinvar"), "id": uid, "retmode": "xml"}), self.attempts, base=2.0)
            yield (partition.first_rank + i, uid, xml if _parse(xml) is not None else None)


class RecordSource(DataSource):
    """Full assertion records as XML, to be taken apart downstream. Options as ArticleSource."""

    @classmethod
    def name(cls) -> str:
        return "litengine_assertion_records"

    def schema(self) -> str:
        return "rank int, uid string, record_xml string"

    def reader(self, schema) -> RecordReader:  # noqa: ANN001
        return RecordReader({"db": "clinvar"} | dict(self.options))


SOURCES = (ArticleSource, AssertionSource, RecordSource)


def register(spark) -> None:  # noqa: ANN001
    for source in SOURCES:
        spark.dataSource.register(source)


# --- lookups for rows that are there ------------------------------------------------------------


def _lookup(df: DataFrame, key: str, schema: str, columns: list[str], options: dict[str, str], answer: Callable[[Transport, dict, list[str], int], list[tuple]]) -> DataFrame:
    """Rows of `answer` for the distinct keys, in batches; a batch that fails for good is logged and gives no row."""
    o = {k.lower(): v for k, v in options.items()}
    common = {k: o[k] for k in ("email", "api_key", "tool") if k in o}
    size, attempts, name = int(o.get("batch", "100")), int(o.get("max_retries", "5")), o.get("transport")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transport, done = load_transport(name), 0
        for pdf in batches:
            ids, rows = [x for x in pdf[key] if x], []
            for a in range(0, len(ids), size):
                part = ids[a : a + size]
                try:
                    rows += answer(transport, common, part, attempts)
                except Exception as e:
                    log.warning("%s %s: %s: %s", columns[-1], shortened(",".join(part)), type(e).__name__, shortened(str(e)))
                done += len(part)
                log.info("%s: %d looked up", columns[-1], done)
            yield pd.DataFrame(rows, columns=columns)

    return df.select(key).filter(F.col(key).isNotNull()).distinct().mapInPandas(run, schema)


def _links(transport: Transport, common: dict, ids: list[str], attempts: int) -> list[tuple]:
    text = retrying(lambda: transport("elink", common | {"dbfrom": "pubmed", "db": "pmc", "linkname": "pubmed_pmc", "id": ids, "retmode": "json"}), attempts, base=2.0)
    out = []
    for linkset in json.loads(text).get("linksets", []):
        found = [str(x) for group in linkset.get("linksetdbs", []) if group.get("linkname") == "pubmed_pmc" for x in group.get("links", [])]
        out += [(str(pmid), x, rank) for pmid in linkset.get("ids", []) for rank, x in enumerate(found)]
    return out


def links(articles: DataFrame, options: dict[str, str], key: str = "pmid") -> DataFrame:
    """(pmid, pmc_numeric_id, link_rank) of the articles that have a full text; those without have no row."""
    columns = ["pmid", "pmc_numeric_id", "link_rank"]
    return _lookup(articles.select(F.col(key).alias("pmid")), "pmid", "pmid string, pmc_numeric_id string, link_rank int", columns, options, _links)


def _full_texts(transport: Transport, common: dict, ids: list[str], attempts: int) -> list[tuple]:
    out = []
    for number in ids:  # a full text is an answer of its own
        try:
            xml = retrying(lambda number=number: transport("efetch", common | {"db": "pmc", "id": number, "rettype": "full", "retmode": "xml"}), attempts, base=3.0)
        except Exception as e:
            log.warning("full text %s: %s: %s", number, type(e).__name__, shortened(str(e)))
            continue
        if _parse(xml) is not None:
            out.append((f"PMC{number}", xml))
        else:
            log.warning("full text %s can't be parsed", number)
    return out


def full_texts(pmcids: DataFrame, options: dict[str, str], key: str = "pmcid") -> DataFrame:
    """(pmcid, pmc_xml); ids with or without their prefix; what fails or can't be parsed has no row."""
    numbers = pmcids.select(pmc_bare(F.col(key)).alias("number"))
    return _lookup(numbers, "number", "pmcid string, pmc_xml string", ["pmcid", "pmc_xml"], options, _full_texts)
