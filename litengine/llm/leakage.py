"""Held-out items inside a corpus (problem 8).

A generalised suffix automaton of the normalised items is built once, frozen into sorted arrays and broadcast. Every document's words
are streamed through it; where a longest match cannot be extended, the match and its places in the items are kept if it has LEAST words
or more. Matches of one document and item that lie side by side in both are joined: up to GAP words between them count
as changed in wording, unless a figure or a gene is among them that differs. An item has leaked into a document if its words
covered that way reach COVERAGE of all its words, among them at least SPECIFIC of its figures and genes, and no more of these differ
than half of those that agree: like wording about other genes and figures, and stock phrases, are no leaks.

Spans: the places of a leak in the document's own characters. remove_spans takes them out: those of items that leaked, and unbroken
matches of LENGTH words or more with any item.

One pass over the corpus without a shuffle; whole texts. Words that are in no item end a match at once, and runs of words are
looked for with one vectorised test a document, so the automaton sees only what can match. Items of more than A_PASS words together are
searched in as many passes as it takes, each with a broadcast of bounded size. In scripts without blanks every character is a word.

Defined cases: null and empty texts and items give no rows; an item of fewer than LEAST words can't leak; copies of a document are
each reported; repeated items are reported under each id; an item with fewer than
SPECIFIC figures and genes must show all it has, one with none is judged by COVERAGE alone.
"""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LEAST, GAP, COVERAGE, SPECIFIC, LENGTH = 3, 5, 0.4, 2, 25
#: Words of items in one automaton: about 100 bytes each when frozen, so a broadcast stays near 100 MB, and 1 KB each while it is built.
A_PASS = 1_000_000
#: Share of the words a leak needs that must stand in unchanged runs of LEAST words or more; the rest may be changed.
ANCHORED = 0.5
_DASHES = str.maketrans({c: "-" for c in "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"})
#: For the first look at a document: letters in lower case and figures stay, all else parts words.
_COARSE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_TAG = re.compile(r"<[^<>]{1,80}>|[\u200b-\u200f\u2060\ufeff\u00ad]")
#: Characters of scripts that are written without blanks: Thai to Burmese, Khmer, kana, ideographs.
_NO_BLANKS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff"
_WORD = re.compile(rf"\d+(?:[.,]\d+)*|[{_NO_BLANKS}]|[^\W\d_{_NO_BLANKS}]+\d*[^\W\d_{_NO_BLANKS}]?(?:-\d+)?")
_UNSPACED = re.compile(f"[{_NO_BLANKS}]")
_GENE = re.compile(r"[A-Z]{3,}\d*[A-Z]?(?:-\d+)?$")
#: What is composed with what stands before it: accents, vowel signs that join, Hangul syllables.
_JOINS = "\u0300-\u036f\u0483-\u0487\u0591-\u05c7\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed\u093c\u09bc\u09be\u09d7\u0b3e\u0b56\u0b57\u0bbe\u0bd7\u0c56\u0cc2\u0cd5\u0cd6\u0d3e\u0d57\u0dca\u0dcf\u0ddf\u102e\u3099\u309a"
_CLUSTER = re.compile(rf"(?:[\u1100-\u1112][\u1161-\u1175][\u11a8-\u11c2]?|.)[{_JOINS}]*", re.S)


def words(text: str) -> list[str]:
    """Words and figures; case kept (see is_specific)."""
    if "<" in text or not text.isascii():
        text = _TAG.sub("", text)
        if not text.isascii():
            text = unicodedata.normalize("NFKC", text).translate(_DASHES)
    return _WORD.findall(text)


def placed_words(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words in the text itself: what is dropped or rewritten on the way to them is followed a cluster at a time."""
    plain = text.isascii()
    if plain and "<" not in text:
        return [m.span() for m in _WORD.finditer(text)]
    gone = [m.span() for m in _TAG.finditer(text)] if not plain or "<" in text else []
    edges = [0, *(x for g in gone for x in g), len(text)]
    at = [i for a, b in zip(edges[::2], edges[1::2], strict=True) for i in range(a, b)]  # places of the characters that are left
    left = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    out, starts, ends = [], [], []
    for m in _CLUSTER.finditer(left):
        c = m.group()
        new = c if plain or (len(c) == 1 and c.isascii()) else unicodedata.normalize("NFKC", c).translate(_DASHES)
        out.append(new)
        starts += [at[m.start()]] * len(new)
        ends += [at[m.end() - 1] + 1] * len(new)
    return [(starts[m.start()], ends[m.end() - 1]) for m in _WORD.finditer("".join(out))]


def is_specific(word: str) -> bool:
    """A figure or a gene."""
    return any(map(str.isdigit, word)) or bool(_GENE.match(word))


class Automaton:
    """Generalised suffix automaton over word ids, frozen: transitions are one sorted array of state * words + word with their targets.

    Occurrences are kept once, in the order of a walk over the tree of suffix links: those of a state and of all below it are a range.
    """

    def __init__(self, items: list[list[int]], least: int) -> None:
        self.n_words = max((w for seq in items for w in seq), default=0) + 1
        self._one_word, self._one_target = array("i", [-1]), array("i", [-1])  # most states have one transition
        self._more: dict[int, dict[int, int]] = {}
        self.link, self.len = array("i", [-1]), array("i", [0])
        own: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(items):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                own.setdefault(last, []).append((k, i + 1))
        self._freeze(own)

    def _get(self, s: int, c: int) -> int:
        if self._one_word[s] == c:
            return self._one_target[s]
        return self._more[s].get(c, -1) if s in self._more else -1

    def _set(self, s: int, c: int, t: int) -> None:
        if self._one_word[s] in (-1, c):
            self._one_word[s], self._one_target[s] = c, t
        else:
            self._more.setdefault(s, {})[c] = t

    def _new(self, length: int) -> int:
        for a, x in ((self._one_word, -1), (self._one_target, -1), (self.link, -1), (self.len, length)):
            a.append(x)
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.len[p] + 1)
        self._one_word[clone], self._one_target[clone] = self._one_word[q], self._one_target[q]
        if q in self._more:
            self._more[clone] = dict(self._more[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self._get(p, c) == q:
            self._set(p, c, clone)
            p = self.link[p]
        return clone

    def _extend(self, p: int, c: int) -> int:
        q = self._get(p, c)
        if q != -1:  # a prefix that another item has already
            return q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        cur = self._new(self.len[p] + 1)
        while p != -1 and (q := self._get(p, c)) == -1:
            self._set(p, c, cur)
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def _freeze(self, own: dict[int, list[tuple[int, int]]]) -> None:
        n = len(self.len)
        one = np.array(self._one_word, dtype=np.int64)
        has = np.flatnonzero(one >= 0)
        more = [(s, c, t) for s, d in self._more.items() for c, t in d.items()]
        keys = np.r_[has * self.n_words + one[has], np.array([s * self.n_words + c for s, c, _ in more], dtype=np.int64)]
        to = np.r_[np.array(self._one_target, dtype=np.int64)[has], np.array([t for *_, t in more], dtype=np.int64)]
        order = np.argsort(keys)
        self.keys, self.to = array("q", keys[order].tobytes()), array("i", to[order].astype(np.int32).tobytes())
        del self._one_word, self._one_target, self._more
        # places of the occurrences in a walk over the link tree: children stand in lists by their parent
        link = np.array(self.link, dtype=np.int64)
        kids = np.argsort(link[1:], kind="stable") + 1
        first = np.searchsorted(link[kids], np.arange(n + 1))
        self.low, self.high = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        item, end = array("i"), array("i")
        stack = [0]
        while stack:
            s = stack.pop()
            if s < 0:
                self.high[~s] = len(item)
                continue
            self.low[s] = len(item)
            for k, e in own.get(s, ()):
                item.append(k)
                end.append(e)
            stack.append(~s)
            stack += kids[first[s] : first[s + 1]].tolist()
        self.item, self.end = item, end

    def step(self, s: int, c: int) -> int:
        if c >= self.n_words:
            return -1
        key = s * self.n_words + c
        i = bisect_left(self.keys, key)
        return self.to[i] if i < len(self.keys) and self.keys[i] == key else -1

    def places(self, s: int) -> Iterator[tuple[int, int]]:
        """(item, position after the end) of every occurrence of a state."""
        a, b = int(self.low[s]), int(self.high[s])
        return zip(self.item[a:b], self.end[a:b], strict=True)

    def matches(self, seq: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of the right-maximal matches of `least` words or more."""
        s = n = 0
        for i, c in enumerate(seq):
            t = self.step(s, c)
            if t >= 0:
                s, n = t, n + 1
                continue
            if n >= least:
                yield i, n, s
            while s > 0 and t < 0:
                s = self.link[s]
                n = self.len[s]
                t = self.step(s, c)
            s, n = (t, n + 1) if t >= 0 else (0, 0)
        if n >= least:
            yield len(seq), n, s


class Neighbours:
    """The pairs of words that stand side by side in an item: a sorted array, as large as the items."""

    def __init__(self, seqs: list[list[int]], n: int) -> None:
        self.n = n
        self.keys = np.unique(np.array([a * n + b for seq in seqs for a, b in zip(seq, seq[1:], strict=False)], dtype=np.int64))

    def hits(self, ids: np.ndarray) -> np.ndarray:
        pairs = ids[:-1] * self.n + ids[1:]
        out = np.zeros(len(pairs), dtype=bool)
        known = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        if len(known) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, pairs[known]), len(self.keys) - 1)
            out[known] = self.keys[at] == pairs[known]
        return out


class Finder:
    def __init__(self, items: list[tuple[int, str]], least: int = LEAST, gap: int = GAP, coverage: float = COVERAGE, specific: int = SPECIFIC) -> None:
        self.least, self.gap, self.coverage, self.specific = least, gap, coverage, specific
        self.ids = [i for i, _ in items]
        raw = [words(t) for _, t in items]
        self.spec = [[is_specific(w) for w in ws] for ws in raw]
        self.vocab: dict[str, int] = {}
        self.items = [[self.vocab.setdefault(w.lower(), len(self.vocab) + 1) for w in ws] for ws in raw]
        self.automaton = Automaton(self.items, least)
        self.neighbours = Neighbours(self.items, len(self.vocab) + 1)
        self._coarse(items)

    def _coarse(self, items: list[tuple[int, str]]) -> None:
        """Words and neighbours of the items under the coarse reading, and the least number of neighbours a leak must show."""
        self.cvocab: dict[bytes, int] = {}
        seqs = [[self.cvocab.setdefault(w, len(self.cvocab) + 1) for w in self.coarse(t)] for _, t in items]
        self.cneighbours = Neighbours(seqs, len(self.cvocab) + 1)
        self.unspaced = any(_UNSPACED.search(t) for _, t in items)  # such items show nothing under the coarse reading
        shortest = min(map(len, self.items), default=0)
        # matches must hold ANCHORED of the words that a leak needs; a match of LEAST words shows LEAST - 2 triples of neighbours
        self.fewest = max(1, math.ceil(ANCHORED * self.coverage * shortest / self.least) * (self.least - 2))

    @staticmethod
    def coarse(text: str) -> list[bytes]:
        if "<" in text:
            text = _TAG.sub("", text)
        if not text.isascii():
            text = unicodedata.normalize("NFKC", text)
        return text.encode("utf-8", "ignore").translate(_COARSE).split()

    def worth_it(self, text: str) -> bool:
        """False only for a text that has too few of the items' neighbouring words for any leak."""
        if self.unspaced and not text.isascii():
            return True
        ws = self.coarse(text)
        if len(ws) < self.least:
            return False
        hit = self.cneighbours.hits(np.fromiter(map(self.cvocab.get, ws, repeat(0)), dtype=np.int64, count=len(ws)))
        return np.count_nonzero(hit[:-1] & hit[1:]) >= self.fewest

    def found(self, text: str) -> dict[int, tuple[float, list[tuple[int, int]]]]:
        """Item's place in the list → (share of its words, (first, after last) word of every run in the document); share 0: no leak, the runs are
        its unbroken matches."""
        if not self.worth_it(text):
            return {}
        ws = words(text)
        if len(ws) < self.least:
            return {}
        low = " ".join(ws).lower().split(" ")
        hit = self.neighbours.hits(np.fromiter(map(self.vocab.get, low, repeat(0)), dtype=np.int64, count=len(low)))
        runs = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for a, b in zip(runs[::2].tolist(), runs[1::2].tolist(), strict=True):
            if b - a + 1 >= self.least:  # b - a pairs are one word more
                part = [self.vocab.get(w, 0) for w in low[a : b + 1]]
                for end, n, s in self.automaton.matches(part, self.least):
                    for k, e in self.automaton.places(s):
                        found[k].append((a + end - n, e - n, n))
        out = {}
        for k, ms in found.items():
            share, places = 0.0, [(d, d + n) for d, _, n in ms]
            if sum(n for *_, n in ms) >= ANCHORED * self.coverage * len(self.items[k]):
                got, joined = self._share(k, ms, ws, low)
                share, places = (got, joined) if got else (0.0, places)
            out[k] = share, places
        return out

    def find(self, text: str) -> list[tuple[int, float]]:
        """(item id, share of its words) of the items that leaked into the text."""
        return [(self.ids[k], share) for k, (share, _) in self.found(text).items() if share]

    def spans(self, text: str, length: int = LENGTH) -> list[tuple[int, int, int, float]]:
        """(item id, start, end, share) in characters of the text: the runs of leaked items, and others of `length` words or more (share 0)."""
        found = self.found(text)
        kept = [(k, share, [r for r in runs if share or r[1] - r[0] >= length]) for k, (share, runs) in found.items()]
        if not any(runs for *_, runs in kept):
            return []
        at, n = placed_words(text), len(words(text))
        if len(at) != n:  # characters composed in a way that can't be followed: the span is the text
            at = [(0, len(text))] * n
        return [(self.ids[k], at[a][0], at[b - 1][1], share) for k, share, runs in kept for a, b in _united(runs)]

    def _share(self, k: int, ms: list[tuple[int, int, int]], ws: list[str], low: list[str]) -> tuple[float, list[tuple[int, int]]]:
        item, spec = self.items[k], self.spec[k]
        covered = np.zeros(len(item), dtype=bool)
        differ, places = 0, []
        ms.sort()
        for i, (d, p, n) in enumerate(ms):
            covered[p : p + n] = True
            places.append((d, d + n))
            best = None
            for j in range(i + 1, len(ms)):  # sorted by place in the document: the nearest that goes on in the item
                d2, p2, n2 = ms[j]
                if d2 - (d + n) > self.gap:
                    break
                if d2 + n2 > d + n and p2 + n2 > p + n and 0 <= p2 - (p + n) <= self.gap and d2 >= d + n:
                    best = (d2, p2)
                    break
            if best:
                theirs = [x for x in range(p + n, best[1]) if spec[x]]
                ours = [x for x in range(d + n, best[0]) if is_specific(ws[x])]
                same = {item[x] for x in theirs} <= {self.vocab.get(low[x], 0) for x in ours}
                if same and len(ours) <= len(theirs) + 1:
                    covered[p + n : best[1]] = True
                    places.append((d + n, best[0]))
                elif theirs:
                    differ += len(theirs)
        # the words next to a match may be changed in their turn; figures and genes show whether the item is meant
        agree = int(np.count_nonzero(covered & np.array(spec)))
        share = float(covered.mean())
        return (share if share >= self.coverage and agree >= min(self.specific, sum(spec)) and differ <= agree / 2 else 0.0), places


def _united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges made one."""
    out: list[list[int]] = []
    for a, b in sorted(r for r in runs if r[1] > r[0]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def passes(items: list[tuple[int, str | None]], most: int = A_PASS) -> Iterator[list[tuple[int, str]]]:
    """The items that have a text, in lists of at most `most` words together (an item is never divided)."""
    part, n = [], 0
    for i, t in items:
        if t:
            k = len(words(t))
            if part and n + k > most:
                yield part
                part, n = [], 0
            part.append((i, t))
            n += k
    if part:
        yield part


def _over(docs: DataFrame, items: list[tuple[int, str | None]], doc_id: str, text: str, columns: str, answer, most: int = A_PASS) -> DataFrame:  # noqa: ANN001
    """answer(finder, doc, text) → rows, over all documents and all items: a pass for each part of the items, each with its finder broadcast once."""
    kind, sc = docs.schema[doc_id].dataType.simpleString(), docs.sparkSession.sparkContext
    schema = f"`{doc_id}` {kind}, {columns}"
    names = [doc_id, *(c.split()[0] for c in columns.split(", "))]
    read = docs.selectExpr(f"`{doc_id}` as d", f"`{text}` as t")
    out = docs.sparkSession.createDataFrame([], schema)
    for n, part in enumerate(passes(items, most)):
        shared = sc.broadcast(Finder(part))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            finder = shared.value
            for pdf in batches:
                yield pd.DataFrame([r for d, t in zip(pdf["d"], pdf["t"], strict=True) if t for r in answer(finder, d, t)], columns=names)

        got = read.mapInPandas(run, schema)
        out = got if n == 0 else out.unionByName(got)
    return out


def leaks(docs: DataFrame, items: list[tuple[int, str | None]], doc_id: str = "doc_id", text: str = "text", a_pass: int = A_PASS) -> DataFrame:
    """(doc_id, item_id, share). items: the list of test items."""
    return _over(docs, items, doc_id, text, "item_id long, share double", lambda f, d, t: [(d, i, s) for i, s in f.find(t)], a_pass)


def spans(docs: DataFrame, items: list[tuple[int, str | None]], doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, item_id, span_start, span_len, share), 1-based in characters of the text. share 0: a match of `length` words with an item that did not leak."""
    rows = lambda f, d, t: [(d, i, a + 1, b - a, s) for i, a, b, s in f.spans(t, length)]
    return _over(docs, items, doc_id, text, "item_id long, span_start int, span_len int, share double", rows)


def remove_spans(docs: DataFrame, items: list[tuple[int, str | None]], doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, removed, clean) of the documents that have spans: characters taken out, and the text without them; what a span stood between is parted by one blank.

    With more items than one pass takes, passes are made one after another over the text as the ones before left it.
    """
    parts = list(passes(items))

    def rows(finder: Finder, d: object, t: str) -> list[tuple]:
        runs = _united([(a, b) for _, a, b, _ in finder.spans(t, length)])
        if not runs:
            return []
        edges = [0, *(x for r in runs for x in r), len(t)]
        kept = [t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
        return [(d, sum(b - a for a, b in runs), " ".join(k.strip() for k in kept if k.strip()))]

    out = _over(docs, parts[0] if parts else [], doc_id, text, "removed int, clean string", rows)
    for part in parts[1:]:
        before = docs.select(doc_id, text).join(out, doc_id, "left").selectExpr(f"`{doc_id}`", f"coalesce(clean, `{text}`) as t", "coalesce(removed, 0) as r")
        again = _over(before, part, doc_id, "t", "removed int, clean string", rows).withColumnsRenamed({"removed": "r2", "clean": "c2"})
        out = before.join(again, doc_id, "left").selectExpr(f"`{doc_id}`", "cast(r + coalesce(r2, 0) as int) as removed", "coalesce(c2, t) as clean").filter("removed > 0")
    return out
