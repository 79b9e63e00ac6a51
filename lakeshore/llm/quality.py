"""Quality rules: base counts of a text, and its divergence from a language's reference.

A text's histograms of character classes and of common function words are compared with
the reference of its language (the mean histogram of every text of that language that passes
the base rules) by the Jensen-Shannon distance.  Texts and histograms that are too short for a
stable estimate are not judged by it.  Only built-in column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, work_folder
from lakeshore.sources.tables import read_table

#: White space of the contract, as a character class body.
SPACE = r"\x20\x09-\x0D"
#: Character classes counted by pattern, besides white space, lower case and the rest.
CLASSES = (r"[#*$%&|<>]+", r"[0-9]+", r"""[.,;:!?'"()\-]+""", r"\p{Lu}+")
CHAR_BINS = len(CLASSES) + 3
#: Lower case and white space: Latin-1 only, which the pattern engine looks up in a table.
USUAL = rf"[{SPACE}a-z\u00df-\u00f6\u00f8-\u00ff]+"
#: Frequent function words of the languages compared.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for"),
    "de": ("der", "die", "und", "den", "von", "ist", "nicht", "ein"),
    "fr": ("le", "la", "les", "et", "des", "que", "dans", "du"),
    "es": ("el", "los", "en", "que", "una", "por", "con", "se"),
}
WORD_BINS = 8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Repeated windows of a text that are looked up one by one.
FEW_REPEATED = 48
#: Guards: fewer words, or fewer common words, than these are not judged by divergence.
GUARD_WORDS = 50
GUARD_COMMON = 40
#: Jensen-Shannon distances (base 2, 0 to 1) above which a text is rejected.
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.5


def base_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and the two histograms as arrays.

    A null text counts as empty; every column of ``docs`` that clashes with an added one
    is replaced.  Each step is a column of its own, so that nothing is computed twice.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    out = docs.withColumns({
        "__words": F.array_remove(F.split(body, f"[{SPACE}]+"), ""),
        "__lines": lines,
        # what is neither lower case nor white space: a tenth of a usual text, so that
        # the counts by class run over little
        "__marked": F.regexp_replace(body, USUAL, ""),
        "__chars": F.length(body).cast("long"),
    })
    out = out.withColumns({
        "__classes": F.array(*[(F.length("__marked") - F.length(F.regexp_replace("__marked", c, ""))).cast("long") for c in CLASSES]),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.col("__classes")[0],
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
    })
    out = _repeat_words(out).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    out = _histograms(out, lang)
    return out.drop(*[c for c in out.columns if c.startswith("__") and c not in docs.columns])


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside three-word windows that occur twice or more.

    The windows' hashes are sorted as plain numbers; equal neighbours are the repeated
    ones.  Their places are found by looking each window up among the repeated values, or,
    where those are many, by sorting (hash, place) pairs.
    """
    hashes, windows, repeated, ordered = (F.col(c) for c in ("__hashes", "__windows", "__repeated", "__ordered"))
    n = F.size(hashes) - 2
    df = df.withColumn("__windows", F.when(n > 1, F.transform(
        F.slice(hashes, 1, n), lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))))
    df = df.withColumn("__sorted", F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(windows)))
    df = df.withColumn("__repeated", F.array_distinct(F.filter("__sorted", lambda h, i: h == F.get("__sorted", i - 1))))
    few = F.size(repeated) <= FEW_REPEATED
    df = df.withColumn("__ordered", F.when(~few, F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    by_value = F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i)), lambda i: i.isNotNull())
    by_order = F.transform(
        F.filter(ordered, lambda p, i: (p["h"] == F.get(ordered, i - 1)["h"]) | (p["h"] == F.get(ordered, i + 1)["h"])),
        lambda p: p["i"])
    df = df.withColumn("__places", F.when(few, by_value).otherwise(by_order))
    covered = F.array_distinct(F.flatten(F.transform("__places", lambda i: F.array(i, i + 1, i + 2))))
    return df.withColumn("n_repeat_words", F.when(repeated.isNotNull(), F.size(covered)).otherwise(0).cast("long"))


def _histograms(df: DataFrame, lang: str) -> DataFrame:
    """Adds ``char_bins`` (white space, lower case, the classes, the rest) and ``word_bins``
    (each common word of the text's language; null for a language without common words), as integer counts."""
    marked = F.length("__marked").cast("long")
    rest = F.aggregate("__classes", marked, lambda left, x: left - x)
    spaces = F.col("__chars") - F.col("word_chars")
    char_bins = F.concat(F.array(spaces, F.col("word_chars") - marked), "__classes", F.array(rest))
    size = F.size("__words")
    word_bins = F.lit(None).cast("array<bigint>")
    for name, words in COMMON_WORDS.items():
        counts = [(size - F.size(F.array_remove("__words", w))).cast("long") for w in words]
        word_bins = F.when(F.col(f"`{lang}`") == name, F.array(*counts)).otherwise(word_bins)
    return df.withColumns({"char_bins": char_bins, "word_bins": word_bins})


def references(counted: DataFrame, lang: str = "lang") -> DataFrame:
    """One row per language (a null language is one): the summed shares, in millionths, of
    the bins of each text that passes the base rules.  Every text weighs alike, so that a
    few long ones do not make the reference."""
    def sums(name, n):
        total = _total(F.col(name))
        shares = [F.when(total > 0, F.expr(f"1000000 * {name}[{i}]") / total).cast("long") for i in range(n)]
        return F.array(*[F.coalesce(F.sum(x), F.lit(0)) for x in shares]).alias(f"r_{name}")

    return (counted.where(~F.col("base_failed")).groupBy(F.col(f"`{lang}`").alias("r_lang"))
            .agg(sums("char_bins", CHAR_BINS), sums("word_bins", WORD_BINS)))


def _total(bins: Column) -> Column:
    return F.aggregate(bins, F.lit(0).cast("long"), lambda a, b: a + b)


def _distance(name: str) -> Column:
    """Jensen-Shannon distance in base 2 between a text's bins and the reference's; null
    where either histogram is empty."""
    mine, theirs = _total(F.col(name)), _total(F.col(f"r_{name}"))

    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(
        F.transform(name, lambda x: x / mine), F.transform(f"r_{name}", lambda x: x / theirs),
        lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.when((mine > 0) & (theirs > 0), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def judge(counted: DataFrame, lang: str = "lang") -> DataFrame:
    """``counted`` (of :func:`base_counts`) with ``char_distance``, ``word_distance`` and
    ``kept``.  The references are a row per language, joined as Spark sizes them."""
    joined = counted.join(references(counted, lang), F.col(f"`{lang}`").eqNullSafe(F.col("r_lang")), "left")
    judged = joined.withColumns({
        "char_distance": F.when(F.col("n_words") >= GUARD_WORDS, _distance("char_bins")),
        "word_distance": F.when(_total(F.col("word_bins")) >= GUARD_COMMON, _distance("word_bins")),
    })
    far = ((F.coalesce(F.col("char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE)
           | (F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).drop("r_lang", "r_char_bins", "r_word_bins")


OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every document.

    Null or empty text: all counts 0, ``base_failed``.  Rows that repeat are judged alike;
    a null language is a language of its own; an empty table gives an empty result.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counted = saved(base_counts(docs).drop("text"), work_folder(spark, "quality"))
    return judge(counted).select("doc_id", *OUTPUT)
