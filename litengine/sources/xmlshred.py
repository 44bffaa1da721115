"""Article XML to columns, in Arrow batches; what can't be parsed gives null or no row instead of failing the job."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parse(xml: str | None) -> ET.Element | None:
    if not xml or "<!ENTITY" in xml:  # no entity is ever expanded
        return None
    try:
        return ET.fromstring(xml)
    except ET.ParseError:
        return None


def _text(e: ET.Element | None, mode: str) -> str:
    if e is None:
        return ""
    return (e.text or "") if mode == "leading" else "".join(e.itertext())


def shred_article(node: ET.Element, mode: str = "leading") -> tuple[str, str, str | None] | None:
    """(pmid, title, abstract): sections that are not empty, joined by a blank; no pmid, no record."""
    pmid = node.findtext(".//PMID")
    if not pmid:
        return None
    parts = [_text(e, mode) for e in node.iterfind(".//AbstractText")]
    return pmid, _text(node.find(".//ArticleTitle"), mode), " ".join(p for p in parts if p).strip() or None


def article_fields(df: DataFrame, column: str, mode: str = "leading") -> DataFrame:
    """One row for each article element of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for xml in pdf["x"]:
                root = _parse(xml)
                if root is not None:
                    nodes = [root] if root.tag == "PubmedArticle" else root.iter("PubmedArticle")
                    rows += [r for n in nodes if (r := shred_article(n, mode))]
            yield pd.DataFrame(rows, columns=["pmid", "title", "abstract"])

    return df.select(F.col(column).alias("x")).mapInPandas(run, "pmid string, title string, abstract string")
