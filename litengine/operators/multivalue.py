"""Several values packed in one cell: one row a value, with its position.

A parsing expression grammar; at each place the alternatives are tried in order and the first that fits, up to a divider, is taken:

    cell     <- blank* (list / slots) blank* !.
    list     <- '[' blank* (value (blank* ',' blank* value)*)? blank* ']'          whole cell only
    slots    <- slot (divider slot)*
    slot     <- blank* (quoted / known / form / bare)? blank*
    quoted   <- q (escape / q' q' / !q' .)* q'  &(blank* (divider / end))          q, q': " " or ' ' or a pair of curly or angular quotes
    known    <- the longest name of the vocabulary  &(blank* (divider / end))
    form     <- a pattern whose values hold dividers  &(blank* (divider / end))
    bare     <- (escape / bracketed / !divider .)+
    bracketed<- '(' (bracketed / !')' .)* ')'  /  '[' … ']'  /  '{' … '}'
    escape   <- '\\' .
    divider  <- ',' / ';' / '|' / their full-width forms / ideographic comma / line end / blank '/' blank

A quote that is never closed, whose end is followed by more text, or inside which another of its kind opens, fails; the parser goes back
to its start and takes it as bare text, flagged 'quote'. A bracket without its mate is taken as text, flagged 'bracket'. Apostrophes inside a word never open a quote.

Defined cases: a null, empty or blank cell gives no value; empty slots in the middle take a position and give no value, those at the
end count for nothing; a value equal to the placeholder takes a position and gives no value; repeated values are kept; a cell of any
length is read in time linear in its length for well-formed text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = " \t\r ​﻿"
DIVIDER = re.compile(r"[,;|\n\uff0c\uff1b\uff5c\u3001]|(?<=[ \t])/(?=[ \t])")
QUOTES = {'"': '"', "'": "'", "\u201c": "\u201d", "\u2018": "\u2019", "\u00ab": "\u00bb"}
CLOSE = {"(": ")", "[": "]", "{": "}"}


@dataclass
class Grammar:
    """forms: patterns of values that hold dividers; vocabulary: names that may hold them; both are tried before bare text."""

    forms: tuple[str, ...] = ()
    vocabulary: tuple[str, ...] = ()
    placeholder: str | None = "None"
    _forms: re.Pattern | None = field(default=None, repr=False)
    _known: re.Pattern | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        if self.forms:
            self._forms = re.compile("|".join(f"(?:{f})" for f in self.forms))
        names = sorted({n for n in self.vocabulary if n and DIVIDER.search(n)}, key=lambda n: (-len(n), n))
        if names:  # longest first: an alternative never hides a longer one
            self._known = re.compile("|".join(map(re.escape, names)))


class Cell:
    """One parse. Positions are offsets in `s`."""

    def __init__(self, s: str, grammar: Grammar) -> None:
        self.s, self.n, self.g = s, len(s), grammar
        self.last_close: dict[str, int] = {}

    def blanks(self, i: int) -> int:
        while i < self.n and self.s[i] in BLANK:
            i += 1
        return i

    def divider(self, i: int) -> int:
        """Length of the divider at i, else 0."""
        return 1 if i < self.n and DIVIDER.match(self.s, i) else 0

    def ends(self, i: int) -> bool:
        """Blanks, then a divider or the end. A slash divides only between blanks."""
        j = self.blanks(i)
        return j >= self.n or bool(self.divider(j))

    def quoted(self, i: int) -> tuple[str, int] | None:
        q = QUOTES.get(self.s[i])
        if q is None:
            return None
        if q not in self.last_close:  # the last place where this quote could end a value; beyond it nothing is sought again
            self.last_close[q] = next((k for k in range(self.n - 1, -1, -1) if self.s[k] == q and self.ends(k + 1)), -1)
        if self.last_close[q] <= i:
            return None
        out, j = [], i + 1
        while j < self.n:
            c = self.s[j]
            if c == "\\" and j + 1 < self.n:
                out.append(self.s[j + 1])
                j += 2
            elif c != q:
                out.append(c)
                j += 1
            elif self.s.startswith(q, j + 1):
                out.append(q)
                j += 2
            elif self.ends(j + 1):
                return "".join(out), j + 1
            elif q in "'\u2019" and self.s[j - 1] not in BLANK and not self.divider(j - 1):  # an apostrophe
                out.append(c)
                j += 1
            else:
                return None
        return None

    def literal(self, i: int) -> tuple[str, int] | None:
        for p in (self.g._known, self.g._forms):
            if p and (m := p.match(self.s, i)) and self.ends(m.end()):
                return m.group(), m.end()
        return None

    def bracket_end(self, i: int) -> int | None:
        """Place after the mate of the bracket at i."""
        stack, j = [], i
        while j < self.n:
            c = self.s[j]
            if c == "\\":
                j += 1
            elif c in CLOSE:
                stack.append(CLOSE[c])
            elif stack and c == stack[-1]:
                stack.pop()
                if not stack:
                    return j + 1
            elif c == "\n":
                return None
            j += 1
        return None

    def bare(self, i: int) -> tuple[str, int, str | None]:
        out, j, flag, dead = [], i, None, -1
        while j < self.n and not self.divider(j):
            c = self.s[j]
            if c == "\\" and j + 1 < self.n:
                out.append(self.s[j + 1])
                j += 2
            elif c in CLOSE and j > dead:
                end = self.bracket_end(j)
                if end is None:  # no mate before the line's end: none of the brackets up to there needs another look
                    out.append(c)
                    flag, dead = "bracket", max(self.s.find("\n", j), self.n) if "\n" not in self.s[j:] else self.s.find("\n", j)
                    j += 1
                else:
                    out.append(re.sub(r"\\(.)", r"\1", self.s[j:end], flags=re.S))
                    j = end
            else:
                out.append(c)
                j += 1
        return "".join(out).strip(BLANK), j, flag

    def json_list(self) -> list[tuple[str | None, str | None]] | None:
        t = self.s.strip()
        if not (t.startswith("[") and t.endswith("]")):
            return None
        try:
            v = json.loads(t)
        except ValueError:
            v = None
        if isinstance(v, list) and not any(isinstance(x, list | dict) for x in v):
            return [(None if x is None else x.strip() if isinstance(x, str) else json.dumps(x), None) for x in v]
        if Cell(t, self.g).bracket_end(0) != len(t) or not t[1:-1].strip():
            return None
        got = Cell(t[1:-1], self.g).slots()  # quoted by other rules than JSON's, or not at all; one bare value is no list
        return got if all(f is None for _, f in got) and (len(got) > 1 or t[1:-1].lstrip()[0] in QUOTES) else None

    def slots(self) -> list[tuple[str | None, str | None]]:
        out: list[tuple[str | None, str | None]] = []
        i = 0
        while True:
            i = self.blanks(i)
            flag = None
            if i >= self.n or self.divider(i):
                out.append((None, None))
            else:
                got = self.quoted(i)
                if got is None and self.s[i] in QUOTES and (self.s[i] != "'" or "'" not in self.s[i + 1 : i + 2]):
                    flag = "quote"
                got = got or self.literal(i)
                if got is None:
                    value, i, other = self.bare(i)
                    flag = flag or other
                else:
                    value, i = got
                    value = value.strip()
                    i = self.blanks(i)
                out.append((value or None, flag))
            if i >= self.n:
                return out
            i += 1  # the divider

    def values(self) -> list[tuple[int, str, str | None]]:
        """(1-based position, value, flag) of the values that count."""
        if not self.s.strip():
            return []
        got = self.json_list()
        got = self.slots() if got is None else got
        return [(p, v, f) for p, (v, f) in enumerate(got, 1) if v is not None and v.strip() and v != self.g.placeholder]


def split_cells(df: DataFrame, keys: list[str], grammars: dict[str, Grammar]) -> DataFrame:
    """(keys…, field_name, pos, item, flag) for the named columns. One Arrow-batched pass, no shuffle; other columns are not read."""
    fields = list(grammars)
    schema = df.select(*keys).schema.simpleString()[len("struct<") : -1].replace(":", " ") if keys else ""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields) + ", field_name string, pos int, item string, flag string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, names, pos, items, flags = [], [], [], [], []
            for name in fields:
                g = grammars[name]
                for row, cell in enumerate(pdf[f"__{name}"]):
                    if cell:
                        for p, v, f in Cell(cell, g).values():
                            at.append(row)
                            names.append(name)
                            pos.append(p)
                            items.append(v)
                            flags.append(f)
            out = pdf[keys].take(at).reset_index(drop=True)
            yield out.assign(field_name=names, pos=pd.array(pos, dtype="int32"), item=items, flag=flags)

    return df.select(*keys, *(F.col(f).cast("string").alias(f"__{f}") for f in fields)).mapInPandas(run, schema)
