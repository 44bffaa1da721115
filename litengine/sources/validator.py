"""The remote validator: a chunk of candidates to the JSON text of a verdict, behind a pluggable transport."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass

from litengine.operators.validate import CLASSES
from litengine.sources.entrez import load_transport

#: A callable (body, headers, seconds) → answer as text, given by name as 'module:function'.
Post = Callable[[dict, dict[str, str], float], str]
URL = "https://api.perplexity.ai/chat/completions"

MEANINGS = {
    "confirmed": "strong published evidence of an association",
    "uncertain": "limited, indirect or conflicting evidence",
    "rejected": "no credible association at all",
    "not_assessed": "not assessed, for want of information or of room",
}


def answer_schema() -> dict:
    """The shape an answer must have: four lists of names and notes, nothing else."""
    names = {c: {"type": "array", "items": {"type": "string"}, "description": f"names with {MEANINGS[c]}" if c != "not_assessed" else f"names {MEANINGS[c]}"} for c in CLASSES}
    shape = {"type": "object", "properties": names | {"notes": {"type": "string", "description": "why the names were put where they are"}}, "required": [*CLASSES, "notes"], "additionalProperties": False}
    return {"type": "json_schema", "json_schema": {"name": "verdict", "strict": True, "schema": shape}}


def prompt(query: str, chunk: dict[str, list[str]]) -> str:
    kinds = "\n".join(f"- {c}: {MEANINGS[c]}" for c in CLASSES)
    return f"""As an expert in medical genetics, judge whether each of these genes and variants is associated with {query}. They were mined from articles and from curated assertions.

{json.dumps(chunk, indent=2)}

Put every name into exactly one list:
{kinds}
Answer in JSON only, and give your reasons under notes."""


def http_post(body: dict, headers: dict[str, str], seconds: float) -> str:
    from urllib.request import Request, urlopen

    with urlopen(Request(URL, json.dumps(body).encode(), headers | {"Content-Type": "application/json"}), timeout=seconds) as r:
        return r.read().decode("utf-8")


@dataclass(frozen=True)
class RemoteValidator:
    """Picklable; the key is read from the environment where the call is made, or carried along if it was given."""

    model: str = "sonar-pro"
    temperature: float = 0.2
    max_tokens: int = 2048
    api_key: str = ""
    transport: str | None = None
    seconds: float = 60.0  # a call that hangs is an error, and worth another attempt

    def __call__(self, query: str, chunk: dict[str, list[str]]) -> str:
        post = load_transport(self.transport) if self.transport else http_post
        body = {
            "model": self.model, "messages": [{"role": "user", "content": prompt(query, chunk)}], "temperature": self.temperature, "max_tokens": self.max_tokens,
            "response_format": answer_schema(),
        }
        answer = json.loads(post(body, {"Authorization": f"Bearer {self.api_key or os.environ.get('PERPLEXITY_API_KEY', '')}"}, self.seconds))
        text = answer["choices"][0]["message"]["content"].strip()
        json.loads(text)  # an answer that is no JSON is no verdict
        return text
