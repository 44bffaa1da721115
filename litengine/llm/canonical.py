"""Free-entered values to the entry of a canonical list (problem 1).

Token-level repair with soft TF-IDF, as joins:

1. The distinct values are folded (full-width and look-alike letters, invisible characters, hyphens, case), freed of the affixes
   that name a product or an origin rather than another entry, and cut into views: the whole value, its parts in brackets and
   between slashes, each once as words and once run together.
2. The distinct tokens of all views are joined with the vocabulary's tokens by edit distance: both sides are keyed by what is left
   when one character is dropped, so that the join is an equi-join, and each pair is verified (one insertion, deletion,
   substitution or swap of neighbours; digits never change: they tell members of a family apart).
3. A view's corrected tokens are combined with soft TF-IDF against the complete names that share its rarest corrected token. Every
   token of the view has to be matched, and every token of the name; of a name of LONG_NAME words or more one word without a figure may
   be missing, if what is left has PARTIAL of the name's weight and no other entry comes within MARGIN. The best score wins.

The rarest token of a view is in every name it can match, so blocking on it loses nothing. The work is done for distinct values only;
the way back to the entries is a join salted against values that hold a large part of all rows.

Defined cases: null and blank values are no entries; a value equal to a canonical name is left out where `skip_exact` asks so;
empty lists and tables give no rows; a value with a part of more words than any name is text and names none; at equal scores a symbol goes before a synonym
and that before a full name, then the smaller id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.llm.common import spread_join
from litengine.runtime import checkpoint

#: Least soft TF-IDF score of a match. One edit in a three-letter token scores 0.67.
LEAST_SCORE = 0.6
#: A name that one word may be missing from, the share of its weight that must be left, and the lead over every other entry.
LONG_NAME, PARTIAL, MARGIN = 4, 0.7, 0.15

# Letters of other scripts that look like Latin ones, and what they look like.
LOOK_ALIKES = "АВЕКМНОРСТУХІЈЅаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧο"
LOOKED_LIKE = "ABEKMHOPCTYXIJSaeopcyxijsABEZHIKMNOPTYXo"
#: Full-width forms of the printable ASCII characters, by rule.
FULL_WIDTH = "".join(chr(0xFEE0 + i) for i in range(0x21, 0x7F))
ASCII = "".join(map(chr, range(0x21, 0x7F)))
#: Greek letters written out or as such, and the letter a symbol has for them.
GREEK = (("alpha", "\u03b1", "a"), ("beta", "\u03b2", "b"), ("gamma", "\u03b3", "g"), ("delta", "\u03b4", "d"))
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")


def folded(c: Column) -> Column:
    """One way of writing for each character; outer white space and quotes gone; case kept."""
    c = F.translate(F.translate(c, FULL_WIDTH, ASCII), LOOK_ALIKES, LOOKED_LIKE)
    c = F.regexp_replace(c, r"[\x{200B}-\x{200F}\x{2060}\x{FEFF}\x{00AD}]", "")
    c = F.regexp_replace(c, r"[\x{2010}-\x{2015}\x{2212}]", "-")
    c = F.regexp_replace(c, r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]+", " ")
    return F.regexp_replace(c, r"^[ \"'.,;:]+|[ \"'.,;:]+$", "")


def without_affixes(c: Column) -> Column:
    """What stands before or after a name without making it another: species, product, antibody, genotype, isoform."""
    c = F.regexp_replace(c, r"^(?:(?i:human|murine|mouse|anti)[ -]+|h(?=[A-Z][A-Z0-9-])|[\x{0394}\x{03B4}]-?)", "")
    tail = r"(?:[ -]+(?i:genes?|proteins?|mrna|cdna|transcript|locus|human|isoform)|-2\d\d| ?\((?:\+|-|(?i:human))\))+$"
    return F.regexp_replace(F.regexp_replace(c, tail, ""), r"^[ .\"']+|[ .\"']+$", "")


def unroman(c: Column) -> Column:
    """A Roman number at the end, after a hyphen or blank, as digits; null where there is none."""
    out = F.lit(None).cast("string")
    for i, r in enumerate(ROMAN, 1):
        out = F.when(c.rlike(rf"(?i)[-_ ]{r}[a-z]?$"), F.regexp_replace(c, rf"(?i)[-_ ]{r}([a-z]?)$", f"{i}$1")).otherwise(out)
    return F.when(c.rlike("(?i)[-_ ][ivx]+[a-z]?$"), out)


def ungreek(c: Column) -> Column:
    """A Greek letter at the end, after a digit or a hyphen, as the letter of a symbol; null where there is none."""
    out = F.lit(None).cast("string")
    for name, sign, letter in GREEK:
        tail = rf"(?i)(?:(?<=[0-9])|[-_ ])(?:{name}|{sign})$"
        out = F.when(c.rlike(tail), F.regexp_replace(c, tail, letter)).otherwise(out)
    return F.when(c.rlike("(?i)(?:alpha|beta|gamma|delta|[\u03b1-\u03b4])$"), out)


def joined(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def without_one(c: Column) -> Column:
    """The token and what is left of it when any one character is dropped."""
    drop = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.array_distinct(F.concat(F.array(c), F.when(F.length(c) > 2, drop).otherwise(F.array().cast("array<string>"))))


def one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion or substitution, or one swap of neighbours."""
    swaps = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))),
    )
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & F.array_contains(swaps, b))


def vocabulary(terms: DataFrame, term_id: str, single: list[str], many: list[str], phrases: list[str]) -> DataFrame:
    """(term_id, rank, tokens): every name of every term. single, many: columns and arrays of names written as one token; phrases: names of words."""
    one = [F.struct(F.lit(0).alias("rank"), F.array(joined(folded(F.col(c)))).alias("tokens")) for c in single]
    empty = F.array().cast("array<string>")
    more = [F.transform(F.coalesce(F.col(c), empty), lambda s: F.struct(F.lit(1).alias("rank"), F.array(joined(folded(s))).alias("tokens"))) for c in many]
    text = [F.struct(F.lit(2).alias("rank"), words(folded(F.col(c))).alias("tokens")) for c in phrases]
    names = terms.select(F.col(term_id).alias("term_id"), F.inline(F.concat(F.array(*one, *text), *more)))
    return names.filter((F.size("tokens") > 0) & ~F.exists("tokens", lambda t: F.coalesce(t, F.lit("")) == "")).distinct()


def weighted(names: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Vocabulary tokens with their idf, and the names with a weight for each token. n: how many names there are."""
    exploded = names.select("term_id", "rank", "tokens", F.explode("tokens").alias("vt"))
    df = exploded.groupBy("vt").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("vt", "df", F.log(1 + F.lit(n) / F.col("df")).alias("idf"))
    with_idf = exploded.join(idf, "vt").groupBy("term_id", "rank", "tokens").agg(F.map_from_entries(F.collect_set(F.struct("vt", "idf"))).alias("w"))
    return idf, with_idf


def repair(tokens: DataFrame, idf: DataFrame) -> DataFrame:
    """(token, vt, sim, idf): the vocabulary tokens within one edit of each distinct token, digits equal."""
    left = tokens.select("token", F.explode(without_one(F.col("token"))).alias("key"))
    right = idf.select("vt", "idf", "df", F.explode(without_one(F.col("vt"))).alias("key"))
    pairs = left.join(right, "key").filter((digits(F.col("token")) == digits(F.col("vt"))) & one_edit(F.col("token"), F.col("vt"))).select("token", "vt", "idf", "df").distinct()
    exact = F.col("token") == F.col("vt")
    sim = F.when(exact, 1.0).otherwise(1 - 1 / F.greatest(F.length("token"), F.length("vt")))
    return pairs.filter(exact | (F.least(F.length("token"), F.length("vt")) >= 3)).withColumn("sim", sim)


def views(values: DataFrame, most_words: int) -> DataFrame:
    """(value, view, tokens) of the distinct values."""
    base = values.withColumn("f", folded(F.col("value"))).withColumn("parts", F.split(F.col("f"), r"[()\[\]{}/]"))
    base = base.filter(~F.exists("parts", lambda p: F.size(words(without_affixes(p))) > most_words))
    whole, parts = F.array(F.col("f")), F.col("parts")
    texts = F.transform(F.concat(whole, F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>"))), lambda p: without_affixes(p))
    texts = F.array_distinct(F.filter(F.concat(texts, whole), lambda p: p != ""))
    shapes = F.transform(texts, lambda p: F.array(F.array(joined(p)), words(p), F.array(joined(unroman(p))), F.array(joined(ungreek(p)))))
    shapes = F.filter(F.array_distinct(F.flatten(shapes)), lambda t: (F.size(t) > 0) & (F.size(t) <= most_words) & ~F.exists(t, lambda x: F.coalesce(x, F.lit("")) == ""))
    return base.select("value", F.posexplode(shapes).alias("view", "tokens"))


def match_values(values: DataFrame, names: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """(value, term_id, score) for the distinct values that name a term. names: see vocabulary()."""
    longest, most_words, n = names.agg(F.coalesce(F.max(F.length(F.array_join("tokens", " "))), F.lit(0)), F.coalesce(F.max(F.size("tokens")), F.lit(0)), F.count(F.lit(1))).first()
    names = checkpoint(names)  # a small table that the plan reads in several places
    idf, with_idf = weighted(names, n)
    v = views(values, most_words)
    tokens = checkpoint(v.select("value", "view", F.size("tokens").alias("n"), F.posexplode("tokens").alias("at", "token")))  # read twice
    fixed = repair(tokens.filter(F.length("token") <= longest + 1).select("token").distinct(), idf)
    by_view = tokens.join(fixed, "token").groupBy("value", "view", "n").agg(F.collect_list(F.struct("at", "token", "vt", "sim", "df")).alias("c"))
    # all tokens of the view have a correction; the rarest one leads to the names
    complete = by_view.filter(F.size(F.array_distinct(F.transform("c", lambda x: x["at"]))) == F.col("n"))
    rarest = F.array_min(F.transform("c", lambda x: F.struct(x["df"].alias("df"), x["at"].alias("at"))))["at"]
    keyed = complete.withColumn("r", rarest).select("value", "view", "n", "c", F.explode(F.array_distinct(F.transform(F.filter("c", lambda x: x["at"] == F.col("r")), lambda x: x["vt"]))).alias("key"))
    postings = with_idf.select("term_id", "rank", "tokens", "w", F.explode(F.array_distinct("tokens")).alias("key"))
    short = F.size("tokens") - F.col("n")
    pairs = keyed.join(postings, "key").filter((short == 0) | ((short == 1) & (F.size("tokens") >= LONG_NAME)))

    def best(t: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(F.filter("c", lambda x: x["vt"] == t), lambda x: x["sim"])), F.lit(0.0))

    pairs = pairs.withColumn("s", F.transform("tokens", lambda t: F.struct(best(t).alias("sim"), F.element_at("w", t).alias("w"), t.rlike("[0-9]").alias("figure"))))
    unmet = F.filter("s", lambda x: x["sim"] == 0)
    pairs = pairs.filter((F.size(unmet) == short) & ~F.exists(unmet, lambda x: x["figure"])).filter(F.forall(F.array_distinct(F.transform("c", lambda x: x["at"])), lambda i: F.exists("c", lambda x: (x["at"] == i) & F.array_contains("tokens", x["vt"]))))
    norm = F.aggregate("s", F.lit(0.0), lambda a, x: a + x["w"] * x["w"])
    score = F.aggregate("s", F.lit(0.0), lambda a, x: a + x["sim"] * x["w"] * x["w"]) / norm
    pairs = pairs.withColumn("score", F.round(score, 9)).filter(F.col("score") >= F.when(short > 0, PARTIAL).otherwise(least_score))
    # for each value and entry its best name, then the best entry; where that lacks a word, the runner-up has to be well behind
    each = pairs.groupBy("value", "term_id").agg(F.max(F.struct("score", (-F.col("rank")).alias("r"), (short == 0).alias("whole"))).alias("b"))
    top = F.max(F.struct(F.col("b.score").alias("score"), F.col("b.r").alias("r"), (-F.col("term_id")).alias("t"), F.col("b.whole").alias("whole")))
    out = each.groupBy("value").agg(top.alias("b"), F.sort_array(F.collect_list("b.score"), asc=False).alias("all"))
    clear = F.col("b.whole") | (F.col("b.score") - F.coalesce(F.get("all", F.lit(1)), F.lit(0.0)) >= MARGIN)
    return out.filter(clear).select("value", (-F.col("b.t")).alias("term_id"), F.col("b.score").alias("score"))


def map_entries(entries: DataFrame, names: DataFrame, exact: DataFrame | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """entries (…, value) with term_id, 0 where the value names no term, and the score. exact: one column of canonical names whose entries are left out; a table of fixed size."""
    real = entries.filter(F.col("value").isNotNull() & (F.length(F.regexp_replace("value", r"[\s\x{A0}]+", "")) > 0))
    if exact is not None:
        real = real.join(exact.select(F.col(exact.columns[0]).alias("value")).filter("value is not null").distinct(), "value", "left_anti")
    counts = checkpoint(real.groupBy("value").agg(F.count(F.lit(1)).alias("n")))  # the distinct values, and how hot they are
    answers = match_values(counts.select("value"), names, least_score)
    keys = [c for c in entries.columns if c != "value"]
    out = spread_join(real, answers, ["value"], F.struct(*keys) if keys else F.lit(0), "left", counts)
    return out.withColumn("term_id", F.coalesce("term_id", F.lit(0)).cast("long"))
