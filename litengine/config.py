"""Run parameters and their validation."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# The significance levels a run may ask for.
SIGNIFICANCE_LEVELS = ("Pathogenic", "Likely pathogenic", "Uncertain significance", "Likely benign", "Benign")
VALIDATOR_MODELS = ("sonar", "sonar-pro")
TRUE_WORDS = ("true", "1", "yes", "on")
#: Above this temperature a run is warned that verdicts become erratic.
WARN_TEMPERATURE = 0.5


@dataclass(frozen=True)
class MiningConfig:
    """Parameters of one run; every default can be overridden."""

    disease_term: str = ""
    search_terms: str = " AND (genetics OR variant)"
    clinical_relevance: tuple[str, ...] = ("Pathogenic", "Likely pathogenic")
    retmax: int = 10
    min_score: float = 0.75
    full_text_mode: str = "serialized"  # or "plain": tags removed, entities resolved
    text_mode: str = "leading"  # or "full": inline markup kept
    normalize_hgvs: bool = False
    include_ids: bool = True
    validate: bool = False
    temperature: float = 0.2
    model: str = "sonar-pro"
    enable_chunking: bool = True
    max_concurrent: int = 3
    max_retries: int = 3
    max_tokens: int = 2048
    token_limit: int = 4096
    safety_margin: float = 0.2
    status_column: str = "Perplexity Status"
    warnings: tuple[str, ...] = field(default=(), compare=False)

    def checked(self) -> MiningConfig:
        """The same parameters, or ValueError naming what is out of its domain."""
        bad = [x for x in self.clinical_relevance if x not in SIGNIFICANCE_LEVELS]
        if bad:
            raise ValueError(f"unknown clinical relevance: {', '.join(bad)}")
        for name, value, domain in (
            ("full_text_mode", self.full_text_mode, ("serialized", "plain")),
            ("text_mode", self.text_mode, ("leading", "full")),
            ("model", self.model, VALIDATOR_MODELS),
        ):
            if value not in domain:
                raise ValueError(f"{name} must be one of {', '.join(domain)}")
        if not 0 <= self.min_score <= 1:
            raise ValueError("min_score must lie between 0 and 1")
        return self


def parse_bool(text: str) -> bool:
    return text.strip().lower() in TRUE_WORDS


def validator_key(variable: str = "PERPLEXITY_API_KEY") -> str:
    """The validator's key; checked before any work is done, so that a run never ends without its results."""
    key = os.environ.get(variable, "")
    if not key:
        raise ValueError(f"{variable} is not set")
    return key


def load_env(path: str | None) -> int:
    """Reads KEY=VALUE lines of an optional file into the environment; what is set already stays. Returns how many were set."""
    if not path or not os.path.exists(path):
        return 0
    n = 0
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, eq, value = line.strip().removeprefix("export ").partition("=")
            if eq and key and not key.startswith("#") and key not in os.environ:
                os.environ[key] = value.strip().strip("'\"")
                n += 1
    return n
