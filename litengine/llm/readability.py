"""Reading level of documents (problem 10).

Every sentence is classified by a regularised linear model over words and the character n-grams of words; a document's level is the
mean of its sentences' level distributions, weighted by the root of their length and calibrated on labelled documents.

A sentence's features are those of its words, so each distinct word has a vector of level scores, computed once a task and looked up
after that. The model is fitted to all labelled documents; raters err, so labels of one document are averaged, and sentences of other
levels inside a document are relabelled between the rounds of the fit. The calibration is fitted to documents that the sentence model had
not seen: two models are fitted, each to half of the documents, and judge the other half. Gradients are sums over blocks of documents:
up to ON_DRIVER labelled documents they are summed on the driver, beyond that by the executors, which hold the blocks.

English is told from other languages by the character n-grams of the words, over the whole text: naive Bayes on all documents, labelled at
first by a handful of function words, then by the model itself until no label changes. The texts are read once and kept as word numbers.

Defined cases: null and empty texts, texts under MIN_WORDS words and texts in other languages give no row; without any labels
there are no rows; ties go to the lower band.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litengine.runtime import checkpoint

BANDS = (1, 2, 3, 4)
MIN_WORDS = 40
ON_DRIVER = 4_000  # labelled documents that are fitted on the driver; of more, the executors hold the texts
BROADCAST = 200_000  # labelled documents whose votes are broadcast; more are joined
WORDS_A_BLOCK, LABELLED_WORDS = 1_000_000, 100_000  # size of a block: texts of the language model, labelled documents
TEMPLATE = 1 / 60  # a word counts at most so often a text
BUCKETS = 1 << 14  # hashed features
ROUNDS, STEPS, L2 = 5, 25, 1e-5

# Frequent function words of English and of other languages in Latin letters, with which the language model begins.
ENGLISH = frozenset("the of and to in is was were that for with on are by from this be as at have has had not or which they we it you can will i he she his her their our my but if when who what do did so an".split())
FOREIGN = frozenset("der die das und ist nicht mit von den dem ein eine einer wurde wurden bei zu im auf für auch sich nach aus le la les des du et est dans une un par pour sur avec que qui ont été el los las del y en se con una por para al fue il di che della per non sono è het een van de o os dos da das em não uma com".split()) - {"a", "an", "i", "die", "was", "on", "in", "so", "at", "do"}
_TAG = re.compile(r"<[^<>]{1,80}>")
_EDGE = ".,;:!?()[]{}\"'*#_-\u2018\u2019\u201c\u201d\u2022\u2026"
BREAK = "\u00b6"  # stands for a line end


_UPPER, _LOWER = (bytes(range(ord(a), ord(a) + 26)) for a in "Aa")


def mostly_capitals(text: str) -> bool:
    """More than half of the letters of the whole text are capitals."""
    if text.isascii():
        b = text.encode()
        rest = len(b.translate(None, _UPPER))
        upper, letters = len(b) - rest, len(b) - len(b.translate(None, _UPPER + _LOWER))
    else:
        upper, letters = sum(map(str.isupper, text)), sum(map(str.isalpha, text))
    return upper > 0.5 * letters


def raw_tokens(text: str) -> list[str]:
    """What stands between white space, markup removed; line ends as BREAK. A text all in capitals is read in lower case."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if mostly_capitals(text):
        text = text.lower()
    return text.replace("\n", f" {BREAK} ").split()


def read_token(raw: str) -> tuple[str | None, bool]:
    """The word in lower case, if it is one (figures and names in capitals are none), and whether a sentence ends here."""
    ends = raw == BREAK or raw.rstrip("\"')]}\u2019\u201d*")[-1:] in tuple(".!?;\u2026")
    core = raw.strip(_EDGE)
    word = core and not any(map(str.isdigit, core)) and not (len(core) > 2 and core.isupper())
    return (core.lower() if word else None), ends


def is_foreign_script(text: str) -> bool:
    """Letters beyond Latin script take two bytes or more."""
    return not text.isascii() and len(text.encode("utf-8", "ignore")) > 1.25 * len(text)


def sentences(text: str) -> list[list[str]]:
    """Lists of words in lower case."""
    out: list[list[str]] = [[]]
    for raw in raw_tokens(text):
        word, ends = read_token(raw)
        if word:
            out[-1].append(word)
        if ends:
            out.append([])
    return [s for s in out if s]


@lru_cache(maxsize=200_000)
def features(word: str) -> list[int]:
    """Hashed features of a word: itself, its character 3- and 4-grams, its length."""
    w = f"<{word}>"
    grams = {word, f"#{min(len(word), 16)}", *(w[i : i + n] for n in (3, 4) for i in range(len(w) - n + 1))}
    return [zlib.crc32(g.encode()) % BUCKETS for g in grams]


def looks_english(words: list[str]) -> bool:
    """Function words of English outnumber those of other languages: a first guess."""
    e, f = sum(w in ENGLISH for w in words), sum(w in FOREIGN for w in words)
    return e > f and e >= 0.02 * len(words)


class Words:
    """A block of texts as word numbers; texts without words are left out."""

    def __init__(self, words: list[str], ids: np.ndarray, n: np.ndarray) -> None:
        self.words, self.ids, self.n = words, ids, n
        self.owner = np.repeat(np.arange(len(n)), n)
        feats = [features(w) for w in words]
        self.feats, self.fn = np.array([f for x in feats for f in x], dtype=int), np.array([len(x) for x in feats])

    @staticmethod
    def blocks(texts: Iterable[str | None], most: int = WORDS_A_BLOCK) -> Iterator[Words]:
        """Blocks of `most` words and what the last text has beyond that."""
        raws: dict[str, int] = {}
        vocab: dict[str, int] = {}
        ids, n, size = [], [], 0

        def number(raw: str) -> int:
            word = read_token(raw)[0]
            raws[raw] = vocab.setdefault(word, len(vocab)) if word else -1
            return raws[raw]

        def block() -> Words:
            return Words(list(vocab), np.concatenate(ids), np.array(n))

        for text in texts:
            if not text:
                continue
            get = raws.get
            i = np.array([k if (k := get(t)) is not None else number(t) for t in raw_tokens(text)], dtype=np.int32)
            i = i[i >= 0]
            if len(i):
                ids.append(i)
                n.append(len(i))
                size += len(i)
            if size >= most:
                yield block()
                raws, vocab, ids, n, size = {}, {}, [], [], 0
        if n:
            yield block()

    def pack(self) -> tuple[str, bytes, bytes]:
        """No word holds white space."""
        return " ".join(self.words), self.ids.astype(np.uint16 if len(self.words) < 1 << 16 else np.uint32).tobytes(), self.n.astype(np.uint32).tobytes()

    @staticmethod
    def unpack(words: str, ids: bytes, n: bytes) -> Words:
        ws = words.split(" ")
        return Words(ws, np.frombuffer(ids, np.uint16 if len(ws) < 1 << 16 else np.uint32).astype(np.int32), np.frombuffer(n, np.uint32).astype(int))

    def _sums(self, of: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=of[self.ids], minlength=len(self.n))

    def english(self, weights: np.ndarray | None) -> np.ndarray:
        """Which texts are English under the weights; without any, by looks_english() and the script."""
        if weights is not None:
            return self._sums(np.bincount(np.repeat(np.arange(len(self.fn)), self.fn), weights=weights[self.feats]) / self.fn) / self.n > 0
        e, f = (self._sums(np.array([float(w in known) for w in self.words])) for known in (ENGLISH, FOREIGN))
        chars, size = (self._sums(np.array([float(len(x)) for x in xs])) + self.n - 1 for xs in (self.words, [w.encode("utf-8", "ignore") for w in self.words]))
        return (e > f) & (e >= 0.02 * self.n) & (size <= 1.25 * chars)  # is_foreign_script()

    def tally(self, before: np.ndarray | None, weights: np.ndarray | None) -> tuple[pd.DataFrame, int, int]:
        """How often each word stands in texts of both sides under the weights; texts that are English; labels that are not those of before."""
        now = self.english(weights)
        all_, en = (np.bincount(i, minlength=len(self.words)) for i in (self.ids, self.ids[now[self.owner]]))
        return pd.DataFrame({"word": self.words, "other": all_ - en, "english": en}), int(now.sum()), int((now != self.english(before)).sum())


def _gram_counts(words: Iterable[str], counts: np.ndarray, most: float) -> np.ndarray:
    """Counts of the hashed n-grams on both sides; no word of a template outweighs the rest."""
    feats = [features(w) for w in words]
    held = np.repeat(np.minimum(counts, most), [len(f) for f in feats], axis=0)
    gram = np.array([g for f in feats for g in f], dtype=int)
    return np.column_stack([np.bincount(gram, weights=held[:, side], minlength=BUCKETS) for side in (0, 1)])


def _language(tally: Callable[[np.ndarray | None, np.ndarray | None], tuple[np.ndarray, int, int]], rounds: int) -> np.ndarray:
    """tally: (weights before, weights) -> counts of n-grams on both sides, English texts, changed labels; see Words.tally()."""
    before = weights = None
    for i in range(rounds):
        grams, english, changed = tally(before, weights)
        if i and not changed:
            break
        if not english:
            return np.zeros(BUCKETS)
        logs = np.log((1 + grams) / (1 + grams).sum(axis=0))
        before, weights = weights, logs[:, 1] - logs[:, 0]
    return weights


def most_of_a_word(texts: int) -> float:
    """What a word may count on one side: 50, and in more than 3,000 texts as large a share of them."""
    return max(50.0, TEMPLATE * texts)


def fit_language(texts: list[str], rounds: int = 10) -> np.ndarray:
    """How much each hashed n-gram speaks for English (log odds, smoothed); all zeros, which is not English, without English texts."""
    docs = next(Words.blocks(texts, 1 << 62), None)
    if docs is None:
        return np.zeros(BUCKETS)

    def tally(before: np.ndarray | None, weights: np.ndarray | None) -> tuple[np.ndarray, int, int]:
        counts, english, changed = docs.tally(before, weights)
        return _gram_counts(counts["word"], counts[["other", "english"]].to_numpy(), most_of_a_word(len(docs.n))), english, changed

    return _language(tally, rounds)


def learn_language(docs: DataFrame, rounds: int = 10) -> np.ndarray:
    """fit_language() of all texts. They are read once; every round counts over the blocks, adds up words, then n-grams."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in Words.blocks(t for pdf in batches for t in pdf["text"]):
            yield pd.DataFrame([(*b.pack(), len(b.n))], columns=["words", "ids", "n", "texts"])

    blocks = checkpoint(docs.filter("text <> ''").select("text").mapInPandas(pack, "words string, ids binary, n binary, texts long"))
    texts = blocks.agg(F.sum("texts")).first()[0]
    if not texts:
        return np.zeros(BUCKETS)
    most = most_of_a_word(texts)

    def tally(before: np.ndarray | None, weights: np.ndarray | None) -> tuple[np.ndarray, int, int]:
        def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for r in zip(pdf["words"], pdf["ids"], pdf["n"], strict=True):
                    counts, english, changed = Words.unpack(*r).tally(before, weights)
                    yield counts
                    yield pd.DataFrame({"word": [None], "other": [changed], "english": [english]})  # about the block itself

        def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out, english, changed = np.zeros((BUCKETS, 2)), 0, 0
            for pdf in batches:
                about = pdf["word"].isna()
                english, changed = english + int(pdf["english"][about].sum()), changed + int(pdf["other"][about].sum())
                if not about.all():
                    out += _gram_counts(pdf["word"][~about], pdf[["other", "english"]][~about].to_numpy(), most)
            yield pd.DataFrame({"grams": [out.tobytes()], "english": [english], "changed": [changed]})

        counted = blocks.mapInPandas(words, "word string, other long, english long").groupBy("word").agg(F.sum("other").alias("other"), F.sum("english").alias("english"))
        rows = counted.mapInPandas(grams, "grams binary, english long, changed long").collect()  # one row of 256 kB a task
        return sum(np.frombuffer(r["grams"]).reshape(BUCKETS, 2) for r in rows), sum(r["english"] for r in rows), sum(r["changed"] for r in rows)

    return _language(tally, rounds)


@dataclass
class Model:
    weights: np.ndarray  # features x bands
    bias: np.ndarray
    prior: np.ndarray  # calibration: log weight of each band
    temperature: float
    language: np.ndarray  # features

    def english(self, w: str) -> float:
        """How much a word speaks for English."""
        return float(self.language[features(w)].mean())

    def word(self, w: str) -> np.ndarray:
        x = features(w)
        return self.weights[x].sum(axis=0) / np.sqrt(len(x))


class Scorer:
    """Documents to bands, a batch at a time. One row of numbers for every distinct token: level scores, is a word, ends a sentence,
    English. All are forgotten at CACHE tokens, so memory has a bound."""

    CACHE = 300_000

    def __init__(self, model: Model) -> None:
        self.m = model
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.zeros((4096, len(BANDS) + 3))

    def _add(self, raw: str) -> int:
        i = self.ids[raw] = len(self.ids)
        if i == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        word, ends = read_token(raw)
        k = len(BANDS)
        if word:
            self.table[i, :k] = self.m.word(word)
            self.table[i, k], self.table[i, k + 2] = 1, self.m.english(word)
        self.table[i, k + 1] = ends
        return i

    def bands(self, texts: list[str]) -> list[int | None]:
        out: list[int | None] = [None] * len(texts)
        todo, tokens, lengths = [], [], []
        for at, text in enumerate(texts):
            if not text or is_foreign_script(text):
                continue
            t = raw_tokens(text)
            if len(t) < MIN_WORDS or len(t) - t.count(BREAK) < MIN_WORDS:
                continue
            todo.append(at)
            tokens += t
            lengths.append(len(t))
        if not todo:
            return out
        if len(self.ids) > self.CACHE:
            self._forget()
        get = self.ids.get
        ids = [i if (i := get(t)) is not None else self._add(t) for t in tokens]
        rows = self.table[ids]
        k = len(BANDS)
        first = np.r_[0, np.cumsum(lengths)[:-1]]
        totals = np.add.reduceat(rows[:, k:], first, axis=0)
        english = totals[:, 2]
        # a sentence starts after an end and at each document's first token
        start = np.r_[True, rows[:-1, k + 1] > 0]
        start[first] = True
        starts = np.flatnonzero(start)
        sums = np.add.reduceat(rows[:, : k + 1], starts, axis=0)
        owner = np.searchsorted(first, starts, side="right") - 1
        real = sums[:, k] > 0
        sums, owner = sums[real], owner[real]
        p = _softmax(sums[:, :k] / np.sqrt(sums[:, k])[:, None] + self.m.bias) * np.sqrt(sums[:, k])[:, None]
        mean = np.column_stack([np.bincount(owner, weights=p[:, j], minlength=len(todo)) for j in range(k)])
        mean /= np.maximum(mean.sum(axis=1, keepdims=True), 1e-9)
        level = np.argmax(np.round(np.log(mean + 1e-6) * self.m.temperature + self.m.prior, 9), axis=1)
        for j, at in enumerate(todo):
            if english[j] > 0:
                out[at] = BANDS[level[j]]
        return out


class _Batch:
    """Sentences as word numbers, words as feature numbers; sums over both by segments, so that a step is a few array operations."""

    def __init__(self, rows: list[list[str]]) -> None:
        vocab: dict[str, int] = {}
        self.tokens = np.array([vocab.setdefault(w, len(vocab)) for s in rows for w in s])
        self.n = np.array([len(s) for s in rows])
        self.starts = np.r_[0, np.cumsum(self.n)[:-1]]
        feats = [features(w) for w in vocab]
        self.feats = np.array([f for x in feats for f in x])
        self.fn = np.array([len(x) for x in feats])
        self.fstarts = np.r_[0, np.cumsum(self.fn)[:-1]]
        self.fword = np.repeat(np.arange(len(feats)), self.fn)
        self.row = np.repeat(np.arange(len(rows)), self.n)

    def logits(self, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        words = np.add.reduceat(w[self.feats], self.fstarts, axis=0) / np.sqrt(self.fn)[:, None]
        return np.add.reduceat(words[self.tokens], self.starts, axis=0) / np.sqrt(self.n)[:, None] + b

    def gradient(self, g: np.ndarray) -> np.ndarray:
        g = g / np.sqrt(self.n)[:, None]
        out = np.empty((BUCKETS, g.shape[1]))
        for k in range(g.shape[1]):
            words = np.bincount(self.tokens, weights=g[self.row, k], minlength=len(self.fn)) / np.sqrt(self.fn)
            out[:, k] = np.bincount(self.feats, weights=words[self.fword], minlength=BUCKETS)
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class _Labelled:
    """A block of documents as sentences, with the raters' votes, and for each model that is fitted to it the sentences' bands as they are held."""

    batch: _Batch
    owner: np.ndarray
    votes: np.ndarray
    half: int
    targets: dict[int, np.ndarray]

    @staticmethod
    def blocks(docs: Iterable[tuple[list[list[str]], np.ndarray, int]], most: int = LABELLED_WORDS) -> Iterator[_Labelled]:
        """Blocks of one half each, of `most` words and what the last document has beyond that."""
        held: tuple[list, list] = ([], [])
        size = [0, 0]
        for sents, votes, half in docs:
            held[half].append((sents, votes))
            size[half] += sum(map(len, sents))
            if size[half] >= most:
                yield _Labelled.of(held[half], half)
                held[half].clear()
                size[half] = 0
        for half in (0, 1):
            if held[half]:
                yield _Labelled.of(held[half], half)

    @staticmethod
    def of(docs: list[tuple[list[list[str]], np.ndarray]], half: int) -> _Labelled:
        owner, votes = np.repeat(np.arange(len(docs)), [len(s) for s, _ in docs]), np.array([v for _, v in docs])
        return _Labelled(_Batch([s for sents, _ in docs for s in sents]), owner, votes, half, {m: votes[owner] for m in (0, 1 + half)})

    def sizes(self) -> list[np.ndarray]:
        """Documents of each half; summed weight of the sentences of each model."""
        docs, weight = np.zeros(2), np.zeros(3)
        docs[self.half] = len(self.votes)
        weight[list(self.targets)] = np.sqrt(self.batch.n).sum()
        return [docs, weight]

    def means(self, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The documents' level distributions under a sentence model."""
        out = np.zeros_like(self.votes)
        np.add.at(out, self.owner, _softmax(self.batch.logits(w, b)) * np.sqrt(self.batch.n)[:, None])
        return out / out.sum(axis=1, keepdims=True)

    def gradient(self, w: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Of all models, weights and bias, not yet divided by the summed weight."""
        gw, gb = np.zeros_like(w), np.zeros_like(b)
        for m, target in self.targets.items():
            g = (_softmax(self.batch.logits(w[m], b[m])) - target) * np.sqrt(self.batch.n)[:, None]
            gw[m], gb[m] = self.batch.gradient(g), g.sum(axis=0)
        return [gw, gb]

    def relabelled(self, w: np.ndarray, b: np.ndarray) -> _Labelled:
        """Each sentence by what its words say and what its document's label makes likely: its own band, less often a neighbouring one,
        hardly another."""
        far = np.abs(np.subtract.outer(np.arange(len(BANDS)), np.arange(len(BANDS))))
        near = np.choose(np.minimum(far, 2), (0.7, 0.14, 0.02))
        targets = {}
        for m in self.targets:
            belief = self.votes * self.means(w[m], b[m])
            belief /= belief.sum(axis=1, keepdims=True)
            target = _softmax(self.batch.logits(w[m], b[m])) ** 1.5 * (belief @ near)[self.owner]
            targets[m] = target / target.sum(axis=1, keepdims=True)
        return replace(self, targets=targets)

    def judged(self, w: np.ndarray, b: np.ndarray, model: int) -> tuple[np.ndarray, np.ndarray]:
        """Logs of the documents' level distributions, votes."""
        return np.log(self.means(w[model], b[model]) + 1e-6), self.votes


def _plus(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b, strict=True)]


class _Here:
    """Blocks on the driver."""

    def __init__(self, blocks: Iterable) -> None:
        self.blocks = list(blocks)

    def map(self, f: Callable) -> _Here:
        return _Here(map(f, self.blocks))

    def total(self, f: Callable, *state: object) -> list[np.ndarray] | None:
        """Sum of f(block, *state), a list of arrays, over all blocks."""
        return reduce(_plus, (f(b, *state) for b in self.blocks)) if self.blocks else None

    def drop(self) -> None:
        pass


class _There:
    """Blocks on the executors; only sums, one a task, reach the driver."""

    def __init__(self, blocks: RDD) -> None:
        self.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks.foreach(lambda _: None)

    def map(self, f: Callable) -> _There:
        return _There(self.blocks.map(f))

    def total(self, f: Callable, *state: object) -> list[np.ndarray] | None:
        sent = self.blocks.context.broadcast(state)

        def run(blocks: Iterator) -> Iterator[list[np.ndarray]]:
            sums = None
            for b in blocks:
                s = f(b, *sent.value)
                sums = _plus(sums, s) if sums else s
            return iter([sums] if sums else [])

        out = self.blocks.mapPartitions(run).collect()
        sent.destroy()
        return reduce(_plus, out) if out else None

    def drop(self) -> None:
        self.blocks.unpersist()


def _sentence_models(docs: _Here | _There, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Here | _There]:
    """Weights and bias of three models, of all documents and of each half: multinomial logistic regression with an L2 penalty (Adam, full
    batch). Between rounds the sentences are relabelled. Also the blocks as they are then."""
    k = len(BANDS)
    w, b = np.zeros((3, BUCKETS, k)), np.zeros((3, k))
    m1, v1, mb, vb, step = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b), 0
    weight = np.maximum(weight, 1e-9)[:, None]
    for i in range(ROUNDS):
        for _ in range(STEPS):
            step += 1
            gw, gb = docs.total(_Labelled.gradient, w, b)
            gw, gb = gw / weight[:, :, None] + L2 * w, gb / weight
            m1, v1 = 0.9 * m1 + 0.1 * gw, 0.99 * v1 + 0.01 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            c1, c2 = 1 - 0.9**step, 1 - 0.99**step
            w = w - 0.05 * (m1 / c1) / (np.sqrt(v1 / c2) + 1e-8)
            b = b - 0.05 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        if i < ROUNDS - 1:
            before, docs = docs, docs.map(_Relabel(w, b))
            before.drop()
    return w, b, docs


@dataclass
class _Relabel:
    w: np.ndarray
    b: np.ndarray

    def __call__(self, docs: _Labelled) -> _Labelled:
        return docs.relabelled(self.w, self.b)


@dataclass
class _Judge:
    """The model of the other half, or that of all documents."""

    w: np.ndarray
    b: np.ndarray
    crossed: bool

    def __call__(self, docs: _Labelled) -> tuple[np.ndarray, np.ndarray]:
        return docs.judged(self.w, self.b, 2 - docs.half if self.crossed else 0)


TEMPERATURES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0)


def _missed(judged: tuple[np.ndarray, np.ndarray], prior: np.ndarray) -> list[np.ndarray]:
    """For every temperature: votes beyond what is expected, by band; loss."""
    logs, votes = judged
    q = [_softmax(logs * t + p) for t, p in zip(TEMPERATURES, prior, strict=True)]
    return [np.array([(votes - x).sum(axis=0) for x in q]), np.array([-(votes * np.log(x + 1e-9)).sum() for x in q])]


def _calibrate(judged: _Here | _There, n: float) -> tuple[np.ndarray, float]:
    """Band weights and temperature under which the raters' labels are likeliest."""
    t = np.array(TEMPERATURES)[:, None]
    prior = np.zeros((len(t), len(BANDS)))
    for _ in range(60):
        missed, loss = judged.total(_missed, prior)
        prior = np.clip(prior + 0.5 * missed / n, -0.3 * t, 0.3 * t)
    best = int(np.argmin(loss))
    return prior[best] - prior[best].mean(), TEMPERATURES[best]


def _fit(docs: _Here | _There, language: np.ndarray) -> Model | None:
    sizes = docs.total(_Labelled.sizes)
    if sizes is None:
        return None
    (n, weight), crossed = sizes, sizes[0].sum() > 3 and sizes[0].all()
    w, b, docs = _sentence_models(docs, weight)
    judged = docs.map(_Judge(w, b, crossed))
    docs.drop()
    prior, temperature = _calibrate(judged, n.sum())
    judged.drop()
    return Model(w[0], b[0], prior, temperature, language)


def _usable(labelled: Iterable[tuple[str | None, dict[int, int], int]], language: np.ndarray) -> Iterator[tuple[list[list[str]], np.ndarray, int]]:
    """Sentences and smoothed votes of the English texts; what comes third stays."""
    speaks: dict[str, float] = {}
    for text, votes, half in labelled:
        sents = sentences(text or "")
        for w in {w for s in sents for w in s if w not in speaks}:
            speaks[w] = float(language[features(w)].mean())
        if sents and votes and sum(speaks[w] for s in sents for w in s) > 0:
            v = np.array([votes.get(b, 0) for b in BANDS], dtype=float)
            yield sents, (v + 0.05) / (v + 0.05).sum(), half


def fit(labelled: list[tuple[str, dict[int, int]]], language: np.ndarray | None = None) -> Model | None:
    """labelled: text and the raters' counts a band. language: see fit_language(); fitted to the labelled texts where it is not given."""
    language = fit_language([t for t, _ in labelled if t]) if language is None else language
    docs = ((s, v, i % 2) for i, (s, v, _) in enumerate(_usable(((t, v, 0) for t, v in labelled), language)))
    return _fit(_Here(_Labelled.blocks(docs)), language)


def learn(docs: DataFrame, labels: DataFrame, language: np.ndarray, on_driver: int = ON_DRIVER) -> Model | None:
    """fit() of all labelled documents. Beyond `on_driver` of them the texts stay on the executors, and the halves are by hash of the id."""
    votes = _votes(labels)
    n = votes.count()
    if n <= on_driver:
        return fit(labelled_texts(docs, labels), language)
    sc = docs.sparkSession.sparkContext
    tasks = max(1, min(sc.defaultParallelism, 64))  # each sends sums of 1.5 MB a step
    rows = docs.select("doc_id", "text").join(F.broadcast(votes) if n <= BROADCAST else votes, "doc_id")
    rows = rows.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")).repartition(tasks, "doc_id").sortWithinPartitions("doc_id", "text")

    def blocks(part: Iterator) -> Iterator[_Labelled]:
        return _Labelled.blocks(_usable(((r["text"], {x["band"]: x["n"] for x in r["v"]}, r["half"]) for r in part), language))

    return _fit(_There(rows.rdd.mapPartitions(blocks)), language)


def sample_texts(docs: DataFrame, most: int) -> list[str]:
    """At most `most` texts to look at, by hash of the id, so the choice is the same in every run; no model rests on it. Only ids are sorted; the
    texts of those chosen follow."""
    ids = docs.filter("text <> '' and doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return [r["text"] for r in sorted(docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text").collect(), key=lambda r: (r["doc_id"], r["text"] or ""))]


def _votes(labels: DataFrame) -> DataFrame:
    """(doc_id, v): the raters' counts a band."""
    votes = labels.filter(F.col("band").isin(*BANDS) & F.col("doc_id").isNotNull()).groupBy("doc_id", "band").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("doc_id").agg(F.collect_list(F.struct("band", "n")).alias("v"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> list[tuple[str, dict[int, int]]]:
    """Texts of all labelled documents with their votes, on the driver; see learn() for many."""
    rows = docs.select("doc_id", "text").join(F.broadcast(_votes(labels)), "doc_id").collect()
    return [(r["text"], {x["band"]: x["n"] for x in r["v"]}) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))]


def bands(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, band) of the English documents; one pass, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model) if model else None
        for pdf in batches:
            found = [b for a in range(0, len(pdf), 512) for b in scorer.bands(pdf["text"].iloc[a : a + 512].tolist())] if scorer else []
            rows = [(d, b) for d, b in zip(pdf["doc_id"], found, strict=False) if b]
            yield pd.DataFrame(rows, columns=["doc_id", "band"]).astype({"band": "int32"})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, band int")
