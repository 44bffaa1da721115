"""Sentence boundaries across languages and scripts (problem 2).

The rules are compiled into a transducer. Its input are the events of a text: openers and closers of quotes and brackets, line ends, places
where a sentence may end. Its state is the open quote (none or one of five kinds) and the depth of brackets; its output are the boundaries.
An event's effect is a state function of eight numbers (where each quote goes, and two for the depth), and these are closed under
composition. Whether a place can end a sentence is decided by what stands within MARGIN characters of it; whether an opener has a mate in
its line, however far, by a second scan from right to left.

Every text is cut into chunks of CHUNK characters, between two letters. A chunk is a function from the state it is entered in to the state
it is left in; functions are composed by a parallel prefix scan, and each chunk then emits its boundaries from its own entry state. Chunks
are rows, so one very long text is spread over many tasks; short texts take the same way.

Defined cases: null, empty and blank texts have no sentence; a text without any boundary is one sentence; every visible character
belongs to exactly one sentence; a sentence has no outer white space; unclosed quotes and brackets hold to the end of their line
only if their mate stands on it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litengine.runtime import checkpoint, parallelism

CHUNK, MARGIN = 4_096, 200

# Common abbreviations after which a sentence goes on, in lower case, of all languages together. learn_abbreviations() adds
# those of a corpus.
NEVER = frozenset(
    """dr dra prof mr mrs ms mt st sgt lt gen rev hon sra mme mlle pr fig figs tab tabs tabl abb sect sec ref refs ex chr no nos nr núm num vol vols p pp v ver
    cf vgl vs viz eg ie i.e e.g esp approx aprox ca env est incl excl fam suppl univ hosp dept ed eds max máx min resp bzw z.b z u d h med dipl ing ej
    omim cit op eq eqs var subsp sp spp cca см рис табл макс мин проф т.е т е напр стр ср акад доц им ул डॉ श्री प्रो มก ดร นพ พญ""".split()
)
# Abbreviations that may stand at the end of a sentence; after those of units a figure doesn't begin another.
MAYBE = frozenset("etc usw al a.m p.m u.k u.s u.s.a inc ltd corp co jr sr bros др гг vus".split())
UNITS = frozenset("yr yrs mo mos wk wks hr hrs sec wt het hom b.i.d t.i.d q.d кг мг".split())
MONTHS = "januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember"

_OPEN, _CLOSE = "([{（「『“„«《【‹", ")]}）」』”»》】›"
_EVENT = re.compile(
    r"(?P<line>[^\S\n]*(?:\r\n?|\n|\x0b|\x0c|\x85| | )\s*)"
    r"|(?P<stop>[.!?…。！？．।॥؟۔]+(?:\"(?=[\s,;:.)\[\]—–-]|$)|[)\]}）”’'»」』》*]|“(?=[\s,;:.)]|$)|[   ]»)*(?:\[\d+(?:[,–-] ?\d+)*\]|[¹²³⁰-⁹]+)*)"
    r"|(?P<mark>[(\[{（「『“„«《【)\]}）」』”»》】\"])"
    r"|(?P<gap>(?<=[฀-๿0-9A-Za-z)])[^\S\n]+(?=[฀-๿])|(?<=[぀-ヿ㐀-鿿）」』”])[^\S\n]+(?=\S))"
)
#: Words that open a Thai sentence; Thai writes blanks between sentences, and elsewhere too.
_THAI = re.compile("ดังนั้น|นอกจากนี้|อย่างไรก็ตาม|อย่างไรก็ดี|การ|ผล|ผู้ป่วย|ผู้วิจัย|ผู้เข้าร่วม|อายุ|แต่|เพราะ|เนื่องจาก|จากการ|ในการ|ทั้งนี้|สรุป|เมื่อ|โดยสรุป|เรา|คณะ|วัตถุประสงค์|วิธีการ|บทนำ")
_CJK = re.compile("[぀-ヿ㐀-鿿]")
_VARIANT = re.compile(r"[cgmnp]\.[\d(*A-Z\[-]|rs\d|(?:si|m|mi|lnc|sh|t|r)RNA")
_SUBJECT = re.compile(r"(?:an? )?[a-z-]{1,25}(?: [a-z-]{1,25}){0,2} (?:found|showed|revealed|identified|detected) ")
_ORDINAL = re.compile(rf"(?:^|\s)(?:Die|Der|Das|Am|Im|Vom|Zum|Zur|Ab der|Seit dem|der|die|das|dem|den|am|im|vom|zum|zur|beim) \d{{1,2}}$")
_GERMAN_DAY = re.compile(rf"\s(?:{MONTHS})\b", re.I)
_BEFORE = re.compile(r"[^\s()\[\]{}\"“”„«»,;:/—!?。！？।…]*$")
_QUOTES = frozenset("\"”’»」』“")

def _starts_sentence(s: str, i: int) -> bool:
    """What follows, at i, can begin a sentence after an abbreviation."""
    c = s[i]
    if c in "([（":
        return i + 1 < len(s) and s[i + 1].isupper() and not s[i + 1 : i + 3].isupper()
    if c in "\"“„«¿¡":
        return True
    return c.isupper() or bool(_VARIANT.match(s, i)) or bool(_SUBJECT.match(s, i))


def _can_end(s: str, a: int, stop: str, b: int, never: frozenset[str] = NEVER) -> bool:
    """Whether the stop at a, whose marks and closers end at b, can end a sentence, outside quotes and brackets."""
    marks = stop[: len(stop) - len(stop.lstrip(".!?…。！？．।॥؟۔"))]
    closers = stop[len(marks) :]
    quoted = any(c in _QUOTES for c in closers)
    i = b
    while i < len(s) and s[i].isspace() and s[i] != "\n":
        i += 1
    if i >= len(s) or s[i] == "\n":
        return True
    spaced, nxt = i > b, s[i]
    last = marks[-1]
    if last in "。！？．।॥۔" or (last in "!?" and not spaced and nxt not in ",;:)."):
        if not quoted:
            return True
        return spaced and not _caseless(nxt) and not nxt.islower()
    if "…" in marks or marks.startswith(".."):
        return spaced and (not nxt.islower() or bool(_VARIANT.match(s, i) or _SUBJECT.match(s, i))) and not _caseless_cjk(nxt) and nxt not in ",;:)—-"
    if nxt in ",;:)]—–-" and not (nxt in "-" and spaced):
        return False
    if last in "!?؟":
        return spaced and (not quoted or not (nxt.islower() and not _VARIANT.match(s, i)) and not _caseless(nxt))
    word = _BEFORE.search(s, max(0, a - 60), a).group()
    head, dot, tail = word.rpartition(".")
    if dot and len(tail) > 1 and len(head.rpartition(".")[2]) > 2:  # the word before ended with a stop that has no blank after it
        word = tail
    if not spaced and s[a - 1 : a] in "cgmnp" and not (s[a - 2 : a - 1].isascii() and s[a - 2 : a - 1].isalpha()):
        return False  # the prefix of a variant
    if not spaced:  # a stop without a blank after it
        if len(word) < 2 or not (word[-1].islower() or word[-1].isdigit() or s[a - 1] in ")]%" or closers):
            return s[a - 1 : a] in ")]" and bool(re.match(r"[A-Z][a-z]|[A-Z]{3}", s[i : i + 3]))
        if word.lower() in never or re.fullmatch(r"[cgmnp]|\w(?:\.\w)+", word):
            return False
        return bool(re.match(r"[A-ZÀ-ÞА-Я][a-zß-ÿа-я]|[A-Z] [a-z]|[A-Z]{3}|[cp]\.[\d(A-Z]", s[i : i + 4])) and (word[-1].isdigit() or len(word) > 2 or bool(closers))
    if quoted:
        return not (nxt.islower() and not _VARIANT.match(s, i) and not _SUBJECT.match(s, i)) and not _caseless(nxt)
    if closers and nxt.islower() and not _VARIANT.match(s, i) and not _SUBJECT.match(s, i):
        return False
    if s[a - 1 : a] in ")]%°" or not word:
        return True
    low = word.lower().lstrip("'’")
    if low == "г":  # a year, or a town before its name
        return _starts_sentence(s, i) and s[a - 3 : a - 2].isdigit()
    if low in never or (len(word) == 1 and word.isalpha() and s[a - 2 : a - 1] != "/"):
        return False
    if low == "sr" and re.match(r"[A-Z]\w+ (?:y|dijo|fue|tiene)\b", s[i : i + 40]):
        return False
    if low in MAYBE:
        return _starts_sentence(s, i) or nxt.isdigit()
    if low in UNITS:
        return _starts_sentence(s, i)
    if word.isdigit() and len(word) <= 2 and (_GERMAN_DAY.match(s, b) or _ORDINAL.search(s, max(0, a - 24), a)):
        return False
    return True


def _caseless_cjk(c: str) -> bool:
    return bool(_CJK.match(c))


def _caseless(c: str) -> bool:
    """A letter of a script without capitals."""
    return c.isalpha() and c.lower() == c.upper()


# --- the transducer -----------------------------------------------------------------------------

# State: the open quote (0 none, 1 straight, 2 curly, 3 low-high, 4 guillemets, 5 corner) and the depth of brackets, which has no bound.
KINDS = 6
_QOPEN = {"“": 2, "„": 3, "«": 4, "《": 4, "「": 5, "『": 5}
_QCLOSE = {"”": (2, 3), "“": (3,), "»": (4,), "》": (4,), "」": (5,), "』": (5,)}
_MATES = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "“": "”", "„": "“”", "«": "»", "《": "》", "「": "」", "『": "』", '"': '"'}
_CLOSERS = {c: 1 << i for i, c in enumerate(dict.fromkeys("".join(_MATES.values())))}
#: An opener's closers as bits: it opens something only if one of them stands further on in its line.
_WANTS = {c: sum(_CLOSERS[m] for m in ms) for c, ms in _MATES.items()}
_LINE_END = re.compile("[\n\r\x0b\x0c\x85  ]")
_AHEAD = re.compile("[" + re.escape("".join(_CLOSERS)) + "\n\r\x0b\x0c\x85  ]")

#: A state function: where each quote goes, and the depth d → max(d + a, b). Such functions are closed under composition, so a chunk of any
#: length is KINDS + 2 numbers.
Function = tuple[tuple[int, ...], int, int]
FAR = -(10**9)
IDENTITY: Function = (tuple(range(KINDS)), 0, 0)
RESET: Function = ((0,) * KINDS, FAR, 0)


def _quote(q: int, c: str) -> int:
    """The open quote after a mark."""
    if c == '"':
        return 1 if q == 0 else 0 if q == 1 else q
    if c in _QCLOSE and q in _QCLOSE[c]:
        return 0
    return q or _QOPEN.get(c, 0)


#: The compiled transition table: mark → state function.
TABLE: dict[str, Function] = {c: (IDENTITY[0], 1, 0) for c in "([{（【"} | {c: (IDENTITY[0], -1, 0) for c in ")]}）】"}
TABLE |= {c: (tuple(_quote(q, c) for q in range(KINDS)), 0, 0) for c in '"“”„«»《》「」『』'}
#: What an opener does that has no mate: a straight quote and the end of a low-high one can still close.
ALONE: dict[str, Function] = {'"': ((0, 0, 2, 3, 4, 5), 0, 0), "“": ((0, 1, 2, 0, 4, 5), 0, 0)}


def then(f: Function, g: Function) -> Function:
    """f, then g."""
    return tuple(g[0][q] for q in f[0]), max(f[1] + g[1], FAR), max(f[2] + g[1], g[2])


def events(s: str, start: int, end: int, ahead: int, never: frozenset[str] = NEVER) -> Iterator[tuple[Function, int, int, bool, int]]:
    """(function, where the sentence ends, where the next begins, can be a boundary, closers that would change the function) of the events
    that begin in [start, end). ahead: the closers that stand after `end` in the line that is open there."""
    closers: list[tuple[int, int]] = []  # (place, bit; 0 a line end), to know what is ahead of an opener
    for m in _AHEAD.finditer(s, start, end):
        closers.append((m.start(), _CLOSERS.get(m.group(), 0)))
    mask, masks = ahead, []
    open_end = True
    for _, bit in reversed(closers):
        masks.append((mask, open_end))
        mask, open_end = (0, False) if bit == 0 else (mask | bit, open_end)
    masks.reverse()  # masks[i]: closers after the i-th place in its line, and whether the line goes on beyond `end`
    masks.append((ahead, True))
    first, last = (mask, open_end), 0
    for m in _EVENT.finditer(s, start):
        a, b = m.span()
        if a >= end:
            break
        kind = m.lastgroup
        if kind == "line":
            yield RESET, a, b, True, 0
        elif kind == "stop":
            move = IDENTITY
            for c in m.group():
                if c in TABLE and c not in "[]":
                    move = then(move, TABLE[c])
            yield move, b, b, _can_end(s, a, m.group(), b, never), 0
        elif kind == "mark":
            c = s[a]
            if c not in _MATES:
                yield TABLE[c], a, a, False, 0
                continue
            while last < len(closers) and closers[last][0] <= a:
                last += 1
            have, on = masks[last - 1] if last else first
            # what stands at `a` itself is behind it
            if last == 0 and closers:
                have, on = first
            if have & _WANTS[c]:
                here = have & ~ahead & _WANTS[c]
                yield TABLE[c], a, a, False, 0 if here or not on else _WANTS[c]
            else:
                yield ALONE.get(c, IDENTITY), a, a, False, _WANTS[c] if on else 0
        else:
            cjk = not "฀" <= s[b] <= "๿" or _CJK.match(s[a - 1])
            yield IDENTITY, a, b, bool(cjk) or bool(_THAI.match(s, b)), 0


def cuts(s: str, chunk: int) -> list[int]:
    """Where chunks begin: between two letters, at or after every multiple of the size. No event lies across such a place."""
    out, at = [0], chunk
    while at < len(s):
        while at < len(s) and not (s[at].isalpha() and s[at - 1].isalpha()):
            at += 1
        if at < len(s):
            out.append(at)
        at += chunk
    return out


def summary(s: str, start: int, end: int) -> tuple[bool, int]:
    """(a line ends in the chunk, closers before the first line end)"""
    m = _LINE_END.search(s, start, end)
    stop = m.start() if m else end
    return m is not None, sum({_CLOSERS[x.group()] for x in _AHEAD.finditer(s, start, stop)})


def variant(s: str, start: int, end: int, ahead: int, never: frozenset[str] = NEVER) -> tuple[Function, list[Function], list[tuple[int, int, int]], int]:
    """(the chunk's function, functions up to its possible boundaries, (trimmed end, next start, number of that function) of these, closers
    further on that matter)"""
    f, matter, at, found = IDENTITY, 0, {}, []
    for move, a, b, possible, wants in events(s, start, end, ahead, never):
        if move is not IDENTITY:
            f = then(f, move)
        matter |= wants
        if possible:
            e = a
            while e > 0 and s[e - 1].isspace():
                e -= 1
            while b < len(s) and s[b].isspace():
                b += 1
            found.append((e, b, at.setdefault(f, len(at))))
    return f, list(at), found, matter


def variants(s: str, start: int, end: int, never: frozenset[str] = NEVER) -> tuple[int, list[tuple[int, Function, list[Function], list[tuple[int, int, int]]]]]:
    """(closers ahead that matter, a variant for each combination of them). There is one, unless an opener near the end awaits its mate."""
    f, fs, found, matter = variant(s, start, end, 0, never)
    out = [(0, f, fs, found)]
    bits = [b for b in _CLOSERS.values() if b & matter]
    for k in range(1, 1 << len(bits)):
        key = sum(b for i, b in enumerate(bits) if k >> i & 1)
        out.append((key, *variant(s, start, end, key, never)[:3]))
    return matter, out


def compose(q: np.ndarray, a: np.ndarray, b: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(open quote, depth) in which every chunk is entered. Rows are chunks of many texts, in order: q (n, KINDS), a, b; text: whose they are.

    A parallel prefix scan by doubling: after round k every row holds the composition of the last 2^k chunks of its text; all rows of a
    round are computed side by side.
    """
    q, a, b, step, n = q.copy(), a.astype(np.int64), b.astype(np.int64), 1, len(a)
    while step < n:
        i = np.flatnonzero(text[step:] == text[:-step]) + step
        if not len(i):
            break
        j = i - step
        q[i], a[i], b[i] = np.take_along_axis(q[i], q[j], axis=1), np.maximum(a[j] + a[i], FAR), np.maximum(b[j] + a[i], b[i])
        step *= 2
    quote, depth = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    later = np.flatnonzero(text[1:] == text[:-1]) + 1
    quote[later], depth[later] = q[later - 1, 0], np.maximum(a[later - 1], b[later - 1])
    return quote, depth


def closers_ahead(ends_line: np.ndarray, mask: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The closers after every chunk in the line that is open at its end: the same scan from right to left, over (a line ends, bits)."""
    stop, bits, step, n = ends_line.copy(), mask.copy(), 1, len(mask)
    while step < n:
        i = np.flatnonzero(text[step:] == text[:-step])
        if not len(i):
            break
        j = i + step
        bits[i], stop[i] = np.where(stop[i], bits[i], bits[i] | bits[j]), stop[i] | stop[j]
        step *= 2
    out = np.zeros(n, dtype=np.int64)
    more = np.flatnonzero(text[1:] == text[:-1])
    out[more] = bits[more + 1]
    return out


def _enter(chunks: list[tuple[int, bool, int, int, list]]) -> list[tuple[int, int, int]]:
    """(ahead, quote, depth) for the chunks (text, ends_line, mask, matter, [(key, q, a, b)]) of many texts, in order."""
    text = np.array([c[0] for c in chunks])
    ahead = closers_ahead(np.array([c[1] for c in chunks], dtype=bool), np.array([c[2] for c in chunks], dtype=np.int64), text)
    keys = [int(x) & c[3] for x, c in zip(ahead, chunks, strict=True)]
    fs = [next(v[1:] for v in c[4] if v[0] == k) for k, c in zip(keys, chunks, strict=True)]
    quote, depth = compose(np.array([f[0] for f in fs], dtype=np.int64), np.array([f[1] for f in fs]), np.array([f[2] for f in fs]), text)
    return list(zip(keys, quote.tolist(), depth.tolist(), strict=True))


def split(s: str, chunk: int = CHUNK, learned: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """(start, length) of the sentences of one text; positions from 0. The same for any chunk size."""
    at, never = cuts(s, chunk), NEVER | learned
    pieces = [(a, b, *variants(s, a, b, never)) for a, b in zip(at, [*at[1:], len(s)], strict=True)]
    entry = _enter([(0, *summary(s, a, b), matter, [(k, *f) for k, f, *_ in vs]) for a, b, matter, vs in pieces])
    out, open_at = [], len(s) - len(s.lstrip())
    for (*_, vs), (key, quote, depth) in zip(pieces, entry, strict=True):
        _, _, fs, found = next(v for v in vs if v[0] == key)
        outside = [q[quote] == 0 and max(depth + a, b) == 0 for q, a, b in fs]
        for e, b, i in found:
            if outside[i]:
                if e > open_at:
                    out.append((open_at, e - open_at))
                open_at = max(open_at, b)
    if len(s.rstrip()) > open_at:
        out.append((open_at, len(s.rstrip()) - open_at))
    return out


_FN = "struct<q:array<int>,a:int,b:int>"
_VARIANTS = f"array<struct<key:int,f:{_FN},fs:array<{_FN}>,found:array<struct<e:int,b:int,i:int>>>>"


def sentences(df: DataFrame, key: str, text: str, chunk: int = CHUNK, learned: frozenset[str] = frozenset()) -> DataFrame:
    """(key, sent_start, sent_len), positions from 1. df: one row a key. learned: see learn_abbreviations().

    Every text, long or short, is cut once into chunks; what is kept of a chunk are its function and its possible boundaries, so no text
    travels. A text's functions, a few numbers each, are scanned together; chunks then find their boundaries from their own entry state,
    and only the start of the sentence that is open at a chunk's edge is carried over it.
    """
    kind, never = df.schema[key].dataType.simpleString(), NEVER | learned
    base = df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.col("t").isNotNull())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, s in zip(pdf["k"], pdf["t"], strict=True):
                at = cuts(s, chunk)
                for c, (a, b) in enumerate(zip(at, [*at[1:], len(s)], strict=True)):
                    left = max(0, a - MARGIN)
                    rows.append((k, c, left, a - left, b - left, b == len(s), s[left : b + MARGIN]))
            yield pd.DataFrame(rows, columns=["k", "c", "at", "a", "b", "final", "part"])

    # a chunk with its margins is a row: those of a long text are dealt over all tasks
    parts = base.mapInPandas(cut, f"k {kind}, c int, at int, a int, b int, final boolean, part string").repartition(parallelism(df.sparkSession), "k", "c")

    def fn(f: Function) -> dict:
        return {"q": f[0], "a": f[1], "b": f[2]}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, c, at, a, b, final, s in pdf.itertuples(index=False, name=None):
                matter, vs = variants(s, a, b, never)
                vs = [{"key": v[0], "f": fn(v[1]), "fs": [fn(f) for f in v[2]], "found": [{"e": at + e, "b": at + n, "i": i} for e, n, i in v[3]]} for v in vs]
                lead, full = len(s) - len(s.lstrip()) if c == 0 else None, at + len(s[:b].rstrip()) if final else None
                rows.append((k, c, *summary(s, a, b), matter, vs, lead, full))
            yield pd.DataFrame(rows, columns=["k", "c", "ends_line", "mask", "matter", "vs", "lead", "full"]).astype({"lead": "Int32", "full": "Int32"})

    pieces = checkpoint(parts.mapInPandas(read, f"k {kind}, c int, ends_line boolean, mask int, matter int, vs {_VARIANTS}, lead int, full int"))
    # a text has at most 2^31 characters, so its functions are a row of some megabytes at most
    narrow = F.transform("vs", lambda v: F.struct(v["key"].alias("key"), v["f"]["q"].alias("q"), v["f"]["a"].alias("a"), v["f"]["b"].alias("b")))
    gathered = pieces.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c", "ends_line", "mask", "matter", narrow.alias("fs")))).alias("x"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, k, x) for i, (k, xs) in enumerate(zip(pdf["k"], pdf["x"], strict=True)) for x in xs]
            entry = _enter([(i, x["ends_line"], x["mask"], x["matter"], [(v["key"], v["q"], v["a"], v["b"]) for v in x["fs"]]) for i, _, x in rows]) if rows else []
            yield pd.DataFrame([(k, x["c"], *e) for (_, k, x), e in zip(rows, entry, strict=True)], columns=["k", "c", "key", "quote", "depth"])

    states = gathered.mapInPandas(scan, f"k {kind}, c int, key int, quote int, depth int")
    met = pieces.join(states, ["k", "c"])
    v = F.get(F.filter("vs", lambda x: x["key"] == F.col("key")), F.lit(0))
    outside = F.transform("v.fs", lambda f: (F.get(f["q"], F.col("quote")) == 0) & (F.greatest(F.col("depth") + f["a"], f["b"]) == 0))
    met = met.withColumn("v", v).withColumn("outside", outside)
    ends = F.transform(F.filter("v.found", lambda x: F.get(F.col("outside"), x["i"])), lambda x: F.struct(x["e"].alias("e"), x["b"].alias("b")))
    last = F.filter(F.array(F.struct(F.col("full").alias("e"), F.col("full").alias("b"))), lambda x: x["e"].isNotNull())
    met = met.select("k", "c", "lead", F.concat(ends, last).alias("ends"))
    before = W.partitionBy("k").orderBy("c").rowsBetween(W.unboundedPreceding, -1)
    open_at = F.greatest(F.coalesce(F.max(F.array_max(F.transform("ends", lambda x: x["b"]))).over(before), F.lit(0)), F.coalesce(F.max("lead").over(W.partitionBy("k")), F.lit(0)))
    met = met.withColumn("open", open_at)
    # a sentence begins where the boundary before it says; starts never go back
    starts = F.concat(F.array("open"), F.transform("ends", lambda x: F.greatest(x["b"], F.col("open"))))
    found = F.transform("ends", lambda x, i: F.struct(F.get(starts, i).alias("s"), x["e"].alias("e")))
    found = F.filter(found, lambda x: x["e"] > x["s"])
    return met.select(F.col("k").alias(key), F.inline(found)).select(key, (F.col("s") + 1).alias("sent_start"), (F.col("e") - F.col("s")).alias("sent_len"))


# --- abbreviations of a corpus ------------------------------------------------------------------

#: An abbreviation is written with its stop at least OFTEN times, in WITH_STOP of all its places, and goes on in lower case in GOES_ON of those.
OFTEN, WITH_STOP, GOES_ON, LONGEST = 10, 0.9, 0.9, 6
MOST_LEARNED = 100_000
_SHORT = re.compile(rf"(?:(?<=[\s(\[\"'\u201c\u201e\u00ab])|^)([^\W\d_]{{2,{LONGEST}}})(\.?)(?:[,;:]|)(?=\s+(\S))")


def learn_abbreviations(df: DataFrame, text: str, often: int = OFTEN) -> frozenset[str]:
    """Words that stand before a stop in the midst of sentences, from counts over all texts: how often a word is written with a stop, how often
    without, and how often a small letter, or a figure, follows the stop. One aggregate over short words; what comes back are the abbreviations alone."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        for pdf in batches:
            for t in pdf["t"]:
                for word, stop, follows in _SHORT.findall(t):
                    n = seen.setdefault(word.lower(), [0, 0, 0])
                    n[0] += 1
                    if stop:
                        n[1] += 1
                        n[2] += follows.islower() or follows.isdigit()
            if len(seen) > 1_000_000:  # counts are summed below, so a task may send what it has at any time
                yield pd.DataFrame([(w, *n) for w, n in seen.items()], columns=["w", "n", "stop", "on"])
                seen = {}
        yield pd.DataFrame([(w, *n) for w, n in seen.items()], columns=["w", "n", "stop", "on"])

    texts = df.select(F.col(text).alias("t")).filter(F.col("t").isNotNull())
    counts = texts.mapInPandas(count, "w string, n long, stop long, on long").groupBy("w").agg(*(F.sum(c).alias(c) for c in ("n", "stop", "on")))
    found = counts.filter((F.col("stop") >= often) & (F.col("stop") >= WITH_STOP * F.col("n")) & (F.col("on") >= GOES_ON * F.col("stop"))).select("w").limit(MOST_LEARNED + 1).collect()
    if len(found) > MOST_LEARNED:
        raise ValueError(f"more than {MOST_LEARNED} abbreviations: the texts are no sentences")
    return frozenset(r["w"] for r in found) - MAYBE - UNITS  # of these it is known that they may end a sentence
