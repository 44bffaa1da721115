"""Entities of two sources matched without a common key (problem 5).

1. Both sides are read by the same expressions: transcript, cDNA change, protein change (one- and three-letter, old and new styles
   in one canonical form) and what is left, among it the gene, which is resolved through the canonical names.
2. Candidates are blocked on the gene (named, or that of the transcript) and on keys of the change, so that a change meets those at the
   same place, those one slip of a digit away and those counted from the other end of a repeat, on any isoform. Where a description names
   no gene, the change alone is the key. Joined are distinct changes, not entries and records.
3. The odds of a pair come from what agrees: the change, the notation, gene and trait, the transcript. How much each counts is estimated
   from all pairs by expectation maximisation over the counts of agreement patterns.
4. Loopy belief propagation over the pairs of each run. Factors: a description speaks of at most one record; one notation of a record is
   spoken of by at most one description (descriptions that name a gene and those that do not are told apart). Repeats within a run are
   merged first. Messages are odds, exchanged through aggregates per description and per notation until they settle; marginals are the
   confidence.
5. Exact check: a match must hold the very change; an entry without a gene must be left with a single record that has the run's trait.

Defined cases: null and blank entries, entries without a readable change or whose gene is not in the list have no pair; repeated
rows of a record count once; ties keep marginals of 1/2 or less each and fall below the threshold; empty tables give no rows.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litengine.functions.text import name_key
from litengine.llm.canonical import folded, joined
from litengine.llm.common import spread_join
from litengine.operators.multivalue import Cell, Grammar
from litengine.runtime import checkpoint

log = logging.getLogger("litengine")

# The amino acids and a stop.
AMINO = dict(zip("ala arg asn asp cys gln glu gly his ile leu lys met phe pro ser thr trp tyr val ter".split(), "ARNDCQEGHILKMFPSTWYV*", strict=True))
_A3, _A1 = "(?:" + "|".join(AMINO) + ")", "ARNDCQEGHILKMFPSTWYV"
_TRANSCRIPT = re.compile(r"\b([NX][MR]_\d+)(?:\.\d+)?")
_P3 = re.compile(rf"(?i)(?<![a-z])({_A3})-?(\d+)(?:(fs)(?:\*|x|ter)?\d*|-?>?({_A3})|(=)|([*X])(?![a-z]))")
_CDNA = re.compile(r"(?<![\w.])(?:c\. ?)?\[?(\d+(?:[+-]\d+)?(?:_\d+(?:[+-]\d+)?)?) ?(?:([ACGT])[>/]([ACGT])\b|(delins|ins)([ACGT]*)|(del|dup|inv)[ACGT]*)(?![a-z])")
_CDNA_OLD = re.compile(r"(?<![\w.])(\d+(?:[+-]\d+)?)([ACGT])-([ACGT])\b")
_P1 = re.compile(rf"(?<![A-Za-z0-9])(?:p\.\(?)?([{_A1}])(\d+)(?:(fs)(?:[*X]\d*|Ter\d*)?|(Ter|[{_A1}*X=]))(?![A-Za-z0-9])")

_SPLIT, _PREFIX = re.compile(r"[\s():,;\[\]]+"), re.compile(r"\b[cp]\.(?=\W|$)")

ROUNDS, STRIDE, SETTLED = 300, 5, 1e-4
NO_GENE = -1
#: What makes two entries of a run one description.
DESCRIPTION = ("g", "kind", "change", "trait")
_PLACE, _RANGE = re.compile(r"\d+(?:[+-]\d+)?(?:_\d+(?:[+-]\d+)?)?"), re.compile(r"(\d+)_(\d+)")
STOP_WORDS = {"gene", "variant", "of", "in", "mutation", "protein", "the", "allele", "change"}
READ = "transcript string, cdna string, protein string, words array<string>"


def _one_letter(x: str) -> str:
    return AMINO.get(x.lower(), "*" if x in "xX*" else x.upper())


def read_text(text: str) -> tuple[str | None, str | None, str | None, list[str]]:
    """(transcript, cDNA change, protein change, words left) in canonical form: position and ref>alt or the operation, without what was
    deleted or doubled; one-letter codes, 'fs' without its length, '=' and '*'. Each reading is cut out before the next is sought."""
    s = text
    for a, b in (("&gt;", ">"), ("\u2192", ">"), ("-->", ">"), ("->", ">"), ("\u2011", "-")):
        s = s.replace(a, b)
    s = " ".join(s.split())
    transcript = cdna = protein = None
    if m := _TRANSCRIPT.search(s):
        transcript, s = m[1], f"{s[: m.start()]} {s[m.end() :]}"
    if m := _P3.search(s):
        alt = "fs" if m[3] else _one_letter(m[4]) if m[4] else "=" if m[5] else "*"
        protein, s = f"{_one_letter(m[1])}{m[2]}{alt}", f"{s[: m.start()]} {s[m.end() :]}"
    if m := _CDNA.search(s):
        op = f"{m[2]}>{m[3]}" if m[2] else f"{m[4]}{m[5]}" if m[4] else m[6]
        cdna, s = m[1] + op, f"{s[: m.start()]} {s[m.end() :]}"
    elif m := _CDNA_OLD.search(s):
        cdna, s = f"{m[1]}{m[2]}>{m[3]}", f"{s[: m.start()]} {s[m.end() :]}"
    if protein is None and (m := _P1.search(s)):
        protein, s = f"{m[1]}{m[2]}{'fs' if m[3] else _one_letter(m[4])}", f"{s[: m.start()]} {s[m.end() :]}"
    words = (w.strip("-.") for w in _SPLIT.split(_PREFIX.sub(" ", s)))
    return transcript, cdna, protein, [w for w in words if len(w) > 1 and w.lower() not in STOP_WORDS]


def read_description(df: DataFrame, column: str) -> DataFrame:
    """Adds transcript, cdna, protein and words. Reading one notation takes it out of the text before the next is sought, which
    native expressions can only say by repeating each other; so it runs in Arrow batches, over distinct texts where many repeat."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + READ

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [read_text(x) if x else (None, None, None, []) for x in pdf[column]]
            yield pdf.assign(**{n: [g[i] for g in got] for i, n in enumerate(("transcript", "cdna", "protein", "words"))})

    return df.mapInPandas(run, schema)


def read_records(df: DataFrame, grammar: Grammar) -> DataFrame:
    """(uid, transcript, words, kinds, traits) of the curated side in one pass. kinds: array<struct<kind, change>>, c and p, and q for a
    protein change on another isoform. A record without a gene in its name has that of the first gene listed.

    df: (uid, variation_name, cdna_change, protein_change, genes, trait_names), each uid once; grammar: that of the packed trait_names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for uid, name, dna, aa, genes, traits in pdf.itertuples(index=False):
                transcript, cdna, protein, words = read_text(name) if name else (None, None, None, [])
                first = genes.split(",")[0].strip() if genes else ""
                kinds = [("c", cdna), ("p", protein), ("c", read_text(dna)[1] if dna else None), *(("q", read_text(x)[2]) for x in (aa or "").split(",") if x.strip())]
                if not any(k == "p" and c for k, c in kinds):  # nothing in the name: the isoforms listed are all there is
                    kinds = [("p" if k == "q" else k, c) for k, c in kinds]
                kinds = [{"kind": k, "change": c} for k, c in dict.fromkeys(kinds) if c]
                out.append((uid, transcript, [*words, first] if first else words, kinds, [v for _, v, _ in Cell(traits, grammar).values()] if traits else []))
            yield pd.DataFrame(out, columns=["uid", "transcript", "words", "kinds", "traits"])

    cols = df.select("uid", "variation_name", "cdna_change", "protein_change", "genes", "trait_names")
    return cols.mapInPandas(run, "uid string, transcript string, words array<string>, kinds array<struct<kind:string,change:string>>, traits array<string>")


def resolve_gene(df: DataFrame, keys: list[str], names: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Adds gene: that of the first word that names one, else the transcript's; null if none. names: (name, gene), transcripts: (transcript, gene)."""
    df = checkpoint(df)  # asked for its words, then for the rest: what was read in Python is not read twice
    said = F.transform("words", lambda w: joined(folded(w)))
    said = F.concat(F.coalesce(said, F.array().cast("array<string>")), F.array(F.concat(F.lit("transcript:"), F.col("transcript"))))
    known = names.select("name", "gene").unionByName(transcripts.select(F.concat(F.lit("transcript:"), F.col("transcript")).alias("name"), "gene"))
    found = df.select(*keys, F.posexplode(said).alias("at", "name")).join(known, "name").groupBy(*keys).agg(F.min(F.struct("at", "gene")).alias("b"))
    return df.join(found.select(*keys, F.col("b.gene").alias("gene")), keys, "left")


def keys_of(change: str) -> list[str]:
    """Blocking keys of a change: its place, and what it does with its place less any one character. Two changes share a key if they
    stand at one place, or if a single digit was typed, left out, doubled or swapped."""
    place, rest = parts_of(change)
    keys = ["@" + place]
    keys += [f"{rest}|{p}" for p in dict.fromkeys([place, *(place[:i] + place[i + 1 :] for i in range(len(place)))])]
    if m := _RANGE.fullmatch(place):  # a deletion in a repeat may be counted from its other end
        keys.append(f"{rest}~{int(m[2]) - int(m[1])}~{int(m[1]) // 4}")
    return keys


def parts_of(change: str) -> tuple[str, str]:
    """(place, what happens there)"""
    place = "".join(_PLACE.findall(change)[:1])
    return place, change.replace(place, " ", 1)


def agreement(a: str, b: str) -> str | None:
    """same; residue: another residue or operation at the same place; digit: one slip in the place; shift: the same length, up to 3 aside;
    null for changes that have nothing to do with each other."""
    if a == b:
        return "same"
    (p, x), (q, y) = parts_of(a), parts_of(b)
    if p == q:
        return "residue"
    if x != y:
        return None
    if _one_slip(p, q):
        return "digit"
    m, n = _RANGE.fullmatch(p), _RANGE.fullmatch(q)
    return "shift" if m and n and int(m[2]) - int(m[1]) == int(n[2]) - int(n[1]) and abs(int(m[1]) - int(n[1])) <= 3 else None


def _one_slip(p: str, q: str) -> bool:
    if abs(len(p) - len(q)) > 1:
        return False
    i = next((k for k, (c, d) in enumerate(zip(p, q, strict=False)) if c != d), min(len(p), len(q)))
    return p[i + 1 :] == q[i + 1 :] or p[i:] == q[i + 1 :] or p[i + 1 :] == q[i:] or (p[i : i + 2] == q[i : i + 2][::-1] and p[i + 2 :] == q[i + 2 :])


def alike(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(gene, kind, change, rchange, level) of the changes that agree or nearly do within a gene; both sides are (gene, kind, change), distinct.

    An equi-join on blocking keys; a change has as many partners as there are slips of it, whatever the number of records.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                pdf["key"] = [keys_of(c) for c in pdf["change"]]
                yield pdf

        return df.mapInPandas(run, "gene long, kind string, change string, key array<string>").select("gene", "kind", F.col("change").alias(name), F.explode("key").alias("key"))

    pairs = keyed(asked, "change").join(keyed(known, "rchange"), ["gene", "kind", "key"]).select("gene", "kind", "change", "rchange").distinct()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["level"] = [agreement(a, b) for a, b in zip(pdf["change"], pdf["rchange"], strict=True)]
            yield pdf[pdf["level"].notna()]

    return pairs.mapInPandas(judge, "gene long, kind string, change string, rchange string, level string")


# --- odds ---------------------------------------------------------------------------------------

#: What is compared of a pair, with the share of true and of false pairs expected to show each value. The data count for more:
#: the expectations weigh as much as WEIGHT pairs of each class, those of the change itself and of the share of true pairs (one half) as much
#: as all pairs: that slips are rarer among true pairs is no finding but what is meant by one. What is not known of a pair (null) says nothing for or against it.
FEATURES: dict[str, dict[str, tuple[float, float]]] = {
    "level": {"same": (0.80, 0.02), "isoform": (0.10, 0.02), "residue": (0.03, 0.58), "digit": (0.05, 0.30), "shift": (0.02, 0.08)},
    "disease": {"shared": (0.50, 0.20), "not": (0.50, 0.80)},
    "bare": {"shared": (0.95, 0.05), "not": (0.05, 0.95)},
    "tx": {"same": (0.90, 0.30), "other": (0.10, 0.70)},
}
WEIGHT, EM_ROUNDS = 20.0, 500


def estimate(patterns: dict[tuple[str | None, ...], int]) -> dict[tuple[str | None, ...], float]:
    """Odds of a match for every agreement pattern, by expectation maximisation over the patterns' counts."""
    names = list(FEATURES)
    m, u = ({f: {v: x[side] for v, x in FEATURES[f].items()} for f in names} for side in (0, 1))
    lam, n = 0.5, sum(patterns.values())

    def odds(p: tuple[str | None, ...]) -> float:
        out = lam / (1 - lam)
        for f, v in zip(names, p, strict=True):
            out *= m[f][v] / u[f][v] if v is not None else 1.0
        return out

    for _ in range(EM_ROUNDS):
        post = {p: (o := odds(p)) / (1 + o) for p in patterns}
        for i, f in enumerate(names):
            for table, side in ((m, 0), (u, 1)):
                weight = max(WEIGHT, n) if f == "level" else WEIGHT
                got = {v: weight * x[side] for v, x in FEATURES[f].items()}
                for p, k in patterns.items():
                    if p[i] is not None:
                        got[p[i]] += k * (post[p] if side == 0 else 1 - post[p])
                total = sum(got.values())
                table[f] = {v: x / total for v, x in got.items()}
        before, lam = lam, (sum(post[p] * k for p, k in patterns.items()) + max(WEIGHT, n) / 2) / (n + max(WEIGHT, n))
        if abs(lam - before) < 1e-9:
            break
    return {p: odds(p) for p in patterns}


def with_odds(pairs: DataFrame) -> DataFrame:
    """Adds odds. What comes to the driver is one count for each pattern of FEATURES, at most 135 rows."""
    names = list(FEATURES)
    found = {tuple(r[f] for f in names): r["n"] for r in pairs.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(*p, float(o)) for p, o in estimate(found).items()]
    table = pairs.sparkSession.createDataFrame(rows, ", ".join(f"{f} string" for f in names) + ", odds double")
    same = [pairs[f].eqNullSafe(table[f]) for f in names]
    return pairs.join(F.broadcast(table), same).select(*(pairs[c] for c in pairs.columns), "odds")


# --- belief propagation -------------------------------------------------------------------------


def _at_most_one(pairs: DataFrame, by: list[str], incoming: str, out: str) -> DataFrame:
    """Message of an at-most-one factor to each of its pairs: 1 / (1 + the other pairs' odds)."""
    total = F.sum(F.col("odds") * F.col(incoming)).over(W.partitionBy(*by))
    return pairs.withColumn(out, 1 / (1 + F.greatest(total - F.col("odds") * F.col(incoming), F.lit(0.0))))


def propagate(pairs: DataFrame, entry: list[str], slot: list[str], rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """pairs (entry…, slot…, odds) with confidence: the marginals under both at-most-one factors, for every pair.

    A pair that shares neither its entry nor its slot with another has odds / (1 + odds) at once, which is what the messages would
    give it. All others exchange damped messages, through aggregates over entries and over slots, until none changes by more than
    `settled`; the rounds and the largest change are logged, as a warning where `rounds` ended it.
    """
    n = pairs.withColumn("__e", F.count(F.lit(1)).over(W.partitionBy(*entry))).withColumn("__s", F.count(F.lit(1)).over(W.partitionBy(*slot)))
    n = checkpoint(n.withColumn("__tied", (F.col("__e") > 1) | (F.col("__s") > 1)).drop("__e", "__s"))
    alone = n.filter("not __tied").withColumn("confidence", F.col("odds") / (1 + F.col("odds"))).drop("__tied")
    tied = n.filter("__tied").drop("__tied").withColumn("b", F.lit(1.0))
    change, done = 0.0, 0
    while done < rounds:
        for _ in range(STRIDE):
            step = _at_most_one(_at_most_one(tied.withColumn("__old", F.col("b")), entry, "b", "a"), slot, "a", "__new")
            tied = step.withColumn("b", 0.5 * F.col("__old") + 0.5 * F.col("__new")).withColumn("__d", F.abs(F.col("__new") - F.col("__old"))).drop("__new", "__old", "a")
        tied, done = checkpoint(tied), done + STRIDE
        change = tied.agg(F.max("__d")).first()[0] or 0.0
        tied = tied.drop("__d")
        if change < settled:
            break
    log.log(logging.WARNING if change >= settled else logging.INFO, "messages: %d rounds, largest change %.2g", done, change)
    tied = _at_most_one(tied, entry, "b", "a")
    belief = F.col("odds") * F.col("a") * F.col("b")
    return alone.unionByName(tied.withColumn("confidence", belief / (1 + belief)).drop("a", "b"))


# --- the whole ----------------------------------------------------------------------------------


def candidates(entries: DataFrame, records: DataFrame, names: DataFrame, transcripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the entries with their description (run_id, pos, g, kind, change), the pairs of descriptions and records with what agrees)."""
    said = entries.filter(F.col("value").isNotNull() & (F.trim("value") != "")).withColumn("trait", F.coalesce(name_key(F.col("trait")), F.lit("")))
    read = resolve_gene(read_description(said.select("value").distinct(), "value"), ["value"], names, transcripts)
    # the DNA change is the more exact of the two: it alone is asked where both are written; what names something that is no gene is foreign
    kind = F.when(F.col("cdna").isNotNull(), "c").otherwise("p")
    read = read.withColumn("change", F.coalesce("cdna", "protein")).withColumn("kind", kind).filter("change is not null and not (gene is null and (size(words) > 0 or transcript is not null))")
    read = read.select("value", F.coalesce("gene", F.lit(NO_GENE)).alias("g"), "transcript", "kind", "change")
    said = checkpoint(said.join(read, "value").select("run_id", "pos", "trait", "g", "transcript", "kind", "change"))

    records = records.withColumn("traits", F.filter(F.array_distinct(F.transform("traits", name_key)), lambda x: x.isNotNull()))
    known = records.select("uid", "gene", F.col("transcript").alias("rtx"), "traits", F.explode("kinds").alias("k")).filter("gene is not null")
    known = known.select("uid", "gene", "rtx", "traits", F.when(F.col("k.kind") == "c", "c").otherwise("p").alias("kind"), F.col("k.kind").alias("rkind"), F.col("k.change").alias("rchange"))
    known = checkpoint(known)  # asked for its changes, then for its records

    asked = said.select("g", "kind", "change").distinct()
    have = known.select("gene", "kind", F.col("rchange").alias("change")).distinct()
    near = alike(asked.filter(F.col("g") != NO_GENE).withColumnRenamed("g", "gene"), have).withColumn("g", F.col("gene"))
    bare = asked.filter(F.col("g") == NO_GENE).join(have, ["kind", "change"]).select("gene", "kind", "change", F.col("change").alias("rchange"), F.lit("same").alias("level"), "g")
    pairs = near.unionByName(bare).join(known, ["gene", "kind", "rchange"]).drop("gene")

    # descriptions of the runs, repeats merged
    described = said.groupBy("run_id", *DESCRIPTION).agg(F.max("transcript").alias("transcript"))
    pairs = spread_join(described, pairs, ["g", "kind", "change"], F.col("run_id"))
    named, shared = F.col("g") != NO_GENE, F.when(F.array_contains("traits", F.col("trait")), "shared").otherwise("not")
    told = (F.col("trait") != "") & (F.size("traits") > 0)
    tx = F.when(F.col("transcript").isNull() | F.col("rtx").isNull(), None).when(F.col("transcript") == F.col("rtx"), "same").otherwise("other")
    pairs = pairs.select("run_id", *DESCRIPTION, "uid", "rkind", "rchange", "level", F.when(named & told, shared).alias("disease"), F.when(~named & told, shared).alias("bare"), tx.alias("tx"))
    # a record that has one change by several notations is one candidate for it
    pairs = pairs.groupBy("run_id", *DESCRIPTION, "uid", "rchange", "level", "disease", "bare", "tx").agg(F.min("rkind").alias("rkind"))
    level = F.when((F.col("level") == "same") & (F.col("rkind") == "q"), "isoform").otherwise(F.col("level"))
    return said, checkpoint(pairs.withColumn("level", level).drop("rkind"))


def beliefs(entries: DataFrame, records: DataFrame, names: DataFrame, transcripts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(run_id, pos, uid, confidence, exact): every entry that has a candidate, with its likeliest record. exact: it holds the very change,
    and, for an entry that names no gene, is the only one of those to have the run's trait.

    entries: (run_id, pos, value, trait); records: (uid, gene, transcript, traits array, kinds array<struct<kind, change>>).
    """
    said, pairs = candidates(entries, records, names, transcripts)
    entry = ["run_id", *DESCRIPTION]
    believed = propagate(with_odds(pairs).withColumn("__named", F.col("g") != NO_GENE), entry, ["run_id", "uid", "kind", "rchange", "__named"], rounds)
    fits = F.col("level").isin("same", "isoform") & ((F.col("g") != NO_GENE) | F.coalesce(F.col("bare") == "shared", F.lit(False)))
    each = believed.groupBy(*entry, "uid").agg(F.sum("confidence").alias("confidence"), F.bool_or(fits).alias("fits"))
    best = each.groupBy(*entry).agg(F.max(F.struct(F.round("confidence", 9).alias("confidence"), "uid", "fits")).alias("m"), F.count_if("fits").alias("n"))
    exact = F.col("m.fits") & ((F.col("g") != NO_GENE) | (F.col("n") == 1))
    return said.join(best, entry).select("run_id", "pos", F.col("m.uid").alias("uid"), F.col("m.confidence").alias("confidence"), exact.alias("exact"))


def match(entries: DataFrame, records: DataFrame, names: DataFrame, transcripts: DataFrame, least: float = 0.6, rounds: int = ROUNDS) -> DataFrame:
    """(run_id, pos, uid, confidence) of the entries that speak of a record; at most one record each: beliefs() of at least `least`, then the exact check."""
    found = beliefs(entries, records, names, transcripts, rounds)
    return found.filter(F.col("exact") & (F.col("confidence") >= least)).drop("exact")
