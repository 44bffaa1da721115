"""Gene mentions from a pluggable tagger; models are loaded once a worker, only the mentions come back."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litengine.functions import variants as V

LABELS = "array<struct<text:string,value:string,score:double>>"


class Tagger(Protocol):
    def __call__(self, text: str) -> list[tuple[str, str, float]]: ...


_loaded: dict[tuple, Tagger] = {}


def loaded(factory: Callable[[], Tagger]) -> Tagger:
    """The tagger of a factory, built at its first use in this worker. Factories are told apart by their function and its parameters."""
    f, args = (factory.func, (factory.args, tuple(sorted(factory.keywords.items())))) if isinstance(factory, functools.partial) else (factory, ())
    kept = tuple(repr(c.cell_contents) for c in (getattr(f, "__closure__", None) or ()))
    key = (f.__module__, f.__qualname__, repr(args), kept, repr(getattr(f, "__defaults__", None)))
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


def regex_tagger() -> Tagger:
    """Deterministic stand-in for a model: every acronym is a gene with full score."""
    import re

    token, acronym = re.compile(r"[A-Za-z0-9-]+"), re.compile(r"[A-Z0-9\-]{2,8}")
    return lambda text: [(t, "Gene", 1.0) for t in token.findall(text) if acronym.fullmatch(t)]


def model_tagger(name: str = "hunflair2") -> Tagger:
    """Adapter to an installed sequence tagger, which reads sentences; ImportError where there is none."""
    from flair.nn import Classifier
    from flair.splitter import SegtokSentenceSplitter

    model, splitter = Classifier.load(name), SegtokSentenceSplitter()

    def tag(text: str) -> list[tuple[str, str, float]]:
        sentences = splitter.split(text)
        model.predict(sentences)
        return [(x.data_point.text, x.value, float(x.score)) for s in sentences for x in s.get_labels()]

    return tag


def labels(df: DataFrame, text: str, factory: Callable[[], Tagger] = regex_tagger, min_score: float = 0.75) -> DataFrame:
    """The input's columns with name and score of each gene mention: exact label, inclusive score, acronym form; repeats kept."""

    @F.pandas_udf(LABELS)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = loaded(factory)
        for s in batches:
            yield s.map(lambda x: [{"text": t, "value": v, "score": p} for t, v, p in tagger(x)] if x else [])

    found = df.withColumn("__l", F.explode(tag(F.col(text))))
    ok = (F.col("__l.value") == "Gene") & V.is_acronym(F.col("__l.text")) & (F.col("__l.score") >= min_score)
    return found.filter(ok).select(*df.columns, F.col("__l.text").alias("name"), F.col("__l.score").alias("score"))
