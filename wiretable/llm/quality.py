"""Quality rules by distribution divergence, in DataFrame functions only.

Each document gives two histograms: code points by character class, and words by
common word (all others in one bin).  Both are compared with language references
by the Jensen-Shannon distance (base 2, 0 to 1).  Everything is learned from the
documents that pass the base rules: a language with enough of them is a reference,
its common words are its most frequent short words, its histograms their sums.  A
document is rejected if it is far from every language, by characters or by words.

Far by words is meant for each reference relative to the distance that a text
without any common word has from it, so the rule works whatever share of a
language its common words have.  Short texts scatter more: below ``STEADY_WORDS``
words the limits widen, in squares (the divergence) with 1 / words.  Below the base
rule's number of words there is no verdict but the base rule's.  A text whose language
is given but has too few documents to be a reference is compared by characters only.

The text is read once: counts, character classes and short words are written under
``spark.checkpoint.dir``.  Words and histograms are then summed per language by
partial aggregations, so a language that holds most documents costs no task more
than its distinct short words.

Defined results: null and empty texts have no words and fail the base rules;
rows with a null language are judged but are not part of a reference; without any
reference no distance is taken; repeated rows are judged one by one; an empty
table gives an empty result; other columns are ignored.  Three-word windows are
compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretable.llm.frames import stored

BASE_WORDS = 50
#: Largest distance by characters, and largest share of the distance of a text without common words.
CHAR_LIMIT = 0.24
WORD_SHARE = 0.95
#: From this number of words on the limits do not depend on the length; below, squares grow by slack / words.
STEADY_WORDS = 100
CHAR_SLACK = 30.0
WORD_SLACK = 10.0
#: Common words of a language: its most frequent words of at most so many letters.
COMMON_WORDS = 25
COMMON_LETTERS = 5
#: Documents that pass the base rules and make a language a reference; the most languages (those with most documents).
REFERENCE_DOCUMENTS = 20
MOST_LANGUAGES = 200

BLANKS = " \t\n\u000b\f\r"
BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, whatever the optimizer does."""
    return F.transform(F.array(value), use)[0]


def only(text: Column, members: str) -> Column:
    """How many code points of the text are in a character class."""
    return F.length(F.regexp_replace(text, f"[^{members}]+", ""))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows found twice or more."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def among(sorted_: Column) -> Column:
        # Neighbours with the same hash, then the places that they cover, in order.
        same = F.filter(sorted_, lambda s, k: (s["h"] == F.get(sorted_, k - 1)["h"]) | (s["h"] == F.get(sorted_, k + 1)["h"]))
        places = F.sort_array(F.transform(same, lambda s: s["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(F.coalesce(F.get(p, k + 1) - at, F.lit(3)), F.lit(3))),
            F.lit(0), lambda total, size: total + size))

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(pairs), among))

    return F.when(n >= 3, let(windows, counted)).otherwise(F.lit(0))


def common_counts(short: Column, n_words: Column, common: list[str]) -> Column:
    """Counts of the common words, in order, then of all other words."""
    if not common:
        return F.array(n_words)
    # Every word keeps a blank of its own at both ends, so taking one out leaves the others as they are.
    held = F.concat(F.lit(" "), F.array_join(F.filter(short, lambda w: w.isin(common)), "  "), F.lit(" "))

    def times(text: Column, pattern: Column) -> Column:
        return ((F.octet_length(text) - F.octet_length(F.replace(text, pattern, F.lit("")))) / F.octet_length(pattern)).cast("bigint")

    patterns = F.array(*[F.lit(f" {w} ") for w in common])
    counts = let(held, lambda text: F.transform(patterns, lambda p: times(text, p)))
    return let(counts, lambda c: F.concat(c, F.array(n_words - F.aggregate(c, F.lit(0).cast("bigint"), lambda a, b: a + b))))


def measures(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, character histogram, short words and base rules of every row: one pass over the texts, nothing shuffled."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counts = F.struct(
        F.length(text).alias("n"), only(text, "A-Z").alias("upper"), only(text, "0-9").alias("digit"),
        F.length(F.regexp_replace(text, BLANK, "")).alias("solid"), only(text, r"#*$%&|<>").alias("symbol"),
        only(text, r"^\x00-\x7F").alias("wide"), only(text, r".,;:!?'\"()\-").alias("mark"))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK))

    def counted(w: Column) -> Column:
        short = F.transform(F.filter(w, lambda x: F.length(x) <= COMMON_LETTERS), lambda x: F.lower(x))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).cast("bigint").alias("n_repeat_words"),
                        short.alias("short"))

    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), counts.alias("c"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        let(words, counted).alias("w"))
    c, n, repeated = F.col("c"), F.col("w.n_words"), F.col("w.n_repeat_words")
    other = c["solid"] - c["upper"] - c["digit"] - c["symbol"] - c["wide"] - c["mark"]
    classes = [other, c["upper"], c["digit"], c["n"] - c["solid"], c["symbol"], c["wide"], c["mark"]]
    return rows.select(
        "doc_id", "lang", n.alias("n_words"), c["solid"].cast("bigint").alias("word_chars"),
        c["symbol"].cast("bigint").alias("n_symbols"), "n_dup_lines", repeated.alias("n_repeat_words"),
        ((n < BASE_WORDS) | (100 * repeated > 50 * n)).alias("base_failed"),
        F.array(*[x.cast("bigint") for x in classes]).alias("chars"), F.col("w.short").alias("short"))


def reference_rows(measured: DataFrame, least: int = REFERENCE_DOCUMENTS) -> tuple[DataFrame, list[str]]:
    """The rows that references are summed over, and their languages."""
    rows = measured.where("not base_failed and lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    langs = [r.lang for r in counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()]
    return rows.where(F.col("lang").isin(langs)), langs


def common_words(rows: DataFrame, most: int = COMMON_WORDS) -> list[str]:
    """The most frequent short words of each language, sorted; at most ``most`` for each."""
    found = rows.select("lang", F.explode("short").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    # Spark keeps the first ``most`` of each language in every task before it shuffles them.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = found.withColumn("place", place).where(F.col("place") <= most)
    return sorted(r.word for r in top.select("word").distinct().collect())


def references(rows: DataFrame, common: list[str]) -> list[tuple[list[float], list[float]]]:
    """Shares of both histograms (``chars`` and ``words``) summed over each language's rows; one small row per language."""
    sums = [F.sum(F.col("chars")[k]).alias(f"c{k}") for k in range(7)]
    sums += [F.sum(F.col("words")[k]).alias(f"w{k}") for k in range(len(common) + 1)]

    def shares(values):
        return [v / sum(values) for v in values]

    return [(shares(list(r)[1:8]), shares(list(r)[8:])) for r in rows.groupBy("lang").agg(*sums).orderBy("lang").collect()]


def without_common(share: list[float]) -> float:
    """Distance to a reference of a text that has only words of its last bin (1 if the reference has none of these)."""
    other = share[-1]
    m = (1 + other) / 2
    rest = sum(share[:-1])  # each such bin adds its share, as the text has nothing there
    return math.sqrt((math.log2(1 / m) + (other * math.log2(other / m) if other else 0.0) + rest) / 2)


def nearest(histogram: Column, shares: list[list[float]], scales: list[float] | None = None) -> Column:
    """Least Jensen-Shannon distance of a histogram to the references, each divided by its scale (null without
    counts or references)."""
    if not shares:
        return F.lit(None).cast("double")
    refs = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in r]).alias("q"), F.lit(float(s)).alias("scale"))
                     for r, s in zip(shares, scales or [1.0] * len(shares))])

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def distance(p: Column, q: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))

    def least(counts: Column, total: Column) -> Column:
        return let(F.transform(counts, lambda x: x / total), lambda own: F.array_min(
            F.transform(refs, lambda r: distance(own, r["q"]) / r["scale"])))

    def judged(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b)
        return let(total, lambda n: F.when(n > 0, least(counts, n)))

    return let(histogram, judged)


def limit(base: float, slack: float, n_words: Column) -> Column:
    """The limit of a text: ``base``, wider below ``STEADY_WORDS`` words."""
    return F.sqrt(base * base + slack * F.greatest(1 / F.greatest(n_words, F.lit(1)) - 1 / STEADY_WORDS, F.lit(0.0)) * base * base)


def judge(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          char_limit: float = CHAR_LIMIT, word_share: float = WORD_SHARE, least: int = REFERENCE_DOCUMENTS) -> DataFrame:
    """doc_id, the base counts, base_failed, char_distance, word_distance (a share) and kept of every row."""
    measured = stored(measures(documents, id_col, text_col, lang_col))
    rows, langs = reference_rows(measured, least)
    common = common_words(rows) if langs else []
    measured = stored(measured.withColumn("words", common_counts(F.col("short"), F.col("n_words"), common)).drop("short"))
    # Without a common word there is nothing to compare words by.
    rows = measured.where(~F.col("base_failed") & F.col("lang").isin(langs))
    refs = [r for r in references(rows, common) if r[1][-1] < 1] if common else []
    chars = nearest(F.col("chars"), [r[0] for r in refs])
    words = nearest(F.col("words"), [r[1] for r in refs], [without_common(r[1]) for r in refs])
    n = F.col("n_words")
    # Other languages' common words say nothing about a text in a language without a reference.
    comparable = F.col("lang").isNull() | F.col("lang").isin(langs)
    far = (F.coalesce(F.col("char_distance") > limit(char_limit, CHAR_SLACK, n), F.lit(False))
           | F.coalesce(comparable & (F.col("word_distance") > limit(word_share, WORD_SLACK, n)), F.lit(False)))
    judged = measured.withColumns({"char_distance": chars, "word_distance": words})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
