"""Token-cost estimates for the validator's prompts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the cost model.
CHARS_PER_TOKEN = 4
ITEM_OVERHEAD = 50
LIST_FACTOR = 1.1
#: Characters of the prompt template without the query.
PROMPT_CHARS = 988


def ascii_json_length(text: Column) -> Column:
    """Length of the text as a JSON string with every character beyond ASCII written as an escape."""
    plain = F.length(F.to_json(F.array(text))) - 2
    bmp = F.length(F.regexp_replace(text, r"[^\x{7F}-\x{FFFF}]", ""))
    astral = F.length(F.regexp_replace(text, r"[^\x{10000}-\x{10FFFF}]", ""))
    return plain + 5 * bmp + 11 * astral


def estimate(chars: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(chars / CHARS_PER_TOKEN)).cast("int")


def item_cost(text: Column, overhead: int = ITEM_OVERHEAD) -> Column:
    return estimate(ascii_json_length(text)) + F.lit(overhead)


def list_cost(base: Column) -> Column:
    return (base * LIST_FACTOR).cast("int")


def prompt_tokens(query: str) -> int:
    return max(1, (PROMPT_CHARS + len(query)) // CHARS_PER_TOKEN)


def budget(token_limit: int, query: str, margin: float = 0.2) -> int:
    """Tokens left for items; ValueError where the prompt alone uses them up."""
    left = math.floor(token_limit * (1 - margin)) - prompt_tokens(query)
    if left <= 0:
        raise ValueError(f"a token limit of {token_limit} leaves nothing for candidates")
    return left
