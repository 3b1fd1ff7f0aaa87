"""Quality rules: divergence of a document's character-class and common-word histograms from those of its language.

Everything is a Spark expression on the row. A first pass counts in how many documents of each language a word stands; the
commonest are that language's common words. A second pass writes the counts of each document; the references are the mean
histograms of the corpus by language (a handful of rows); the verdict compares each document with its language's
reference by Jensen-Shannon distance. A language with too few documents has no reference and is not judged by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

#: Common words of a language, and the share of its documents (one in so many) that a candidate stands in at least.
COMMON_WORDS, CANDIDATE_SHARE = 32, 20
#: A language has a reference with so many judged documents, and one in LANGUAGE_SHARE of all: so many languages at most.
MIN_LANGUAGE_DOCS, LANGUAGE_SHARE = 20, 1000
#: Classes in the order in which they are stripped from the text; what is left is the class "other".
CLASSES = {
    "lower": r"\p{Ll}+",
    "upper": r"[\p{Lu}\p{Lt}]+",
    "space": r"\s+",
    "digit": r"\p{Nd}+",
    "mark": r"""[.,;:'"?()\-]+""",
    "letter": r"[\p{L}\p{M}]+",
}
CLASS_NAMES = (*CLASSES, "other")
#: Fewest words for a base pass, for the class histogram, and for the common-word histogram to be judged.
MIN_WORDS, MIN_WORDS_CLASSES, MIN_WORDS_COMMON = 50, 50, 60
#: Limits by language: of the class distance as a multiple of the median, of the word distance as a share of what a text without common words has.
CLASS_LIMIT, WORD_LIMIT = 2.0, 0.85

WORD_BREAK = r"[\x20\x09-\x0D]+"


def _base(text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {"n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")}


def _repeated_starts(keys: Column, words: Column) -> Column:
    """Of sorted (hash, place) keys: the sorted places of windows that have an equal neighbour, the three words compared."""

    def same(k: Column, other: Column) -> Column:
        alike = k["h"] == other["h"]
        for j in range(3):
            alike = alike & (F.get(words, k["i"] + j) == F.get(words, other["i"] + j))
        return alike

    found = F.filter(keys, lambda k, n: F.coalesce(same(k, F.get(keys, n + 1)), F.lit(False)) | F.coalesce(same(k, F.get(keys, n - 1)), F.lit(False)))
    return F.sort_array(F.transform(found, lambda k: k["i"].cast("long")))


def _reach(starts: Column) -> Column:
    """Words covered by the three-word windows at ``starts``: each counts up to the next start, three at most."""
    steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _occurrences(joined: Column, word: Column) -> Column:
    """How often ``word`` stands in a string of words that have a blank of their own on both sides."""
    lost = F.octet_length(joined) - F.octet_length(F.replace(joined, F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))
    return lost / (F.octet_length(word) + 2)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def common_words(texts: DataFrame, size: int = COMMON_WORDS) -> DataFrame:
    """``lang`` and ``ref_words``: the lower-case words of letters that stand in most documents of the language, sorted.

    ``texts`` has lang and text. A candidate stands in one in CANDIDATE_SHARE of a language's documents, so few are ranked;
    one in LANGUAGE_SHARE of all documents makes a language, so the result has LANGUAGE_SHARE rows at most.
    """
    words = texts.where("lang is not null").select("lang", _words(F.lower("text")).alias("words")).where(F.size("words") >= MIN_WORDS_COMMON)
    # A document counts under the word "", which none has: both figures come from one pass.
    each = words.select("lang", F.explode(F.concat(F.array(F.lit("")), F.array_distinct("words"))).alias("word"))
    found = materialize(each.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("docs")), "word-counts")
    sizes = found.where("word = ''").select("lang", F.col("docs").alias("of"))
    total = sizes.agg(F.sum("of")).first()[0] or 0
    large = sizes.where((F.col("of") >= MIN_LANGUAGE_DOCS) & (F.col("of") * LANGUAGE_SHARE >= total))
    candidates = found.join(F.broadcast(large), "lang").where((F.col("docs") * CANDIDATE_SHARE >= F.col("of")) & F.col("word").rlike(r"^\p{L}+$"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "word"))
    best = candidates.withColumn("rank", rank).where(F.col("rank") <= size)
    return best.groupBy("lang").agg(F.sort_array(F.collect_list("word")).alias("ref_words"))


def counts(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang", carry: bool = False) -> DataFrame:
    """Counts of each row; with ``carry`` the whole input row stays under ``_row``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col else F.lit(None).cast("string")
    lists = materialize(common_words(df.select(lang.alias("lang"), text.alias("text"))), "common-words")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if carry or c != text_col]).alias("_row")
    t = df.select(row, lang.alias("lang"), text.alias("text")).join(F.broadcast(lists), "lang", "left")  # LANGUAGE_SHARE rows at most
    # The words are used by several expressions: cross an optimiser barrier so that each split happens once.
    t = t.withColumn("words", _words(F.col("text")))
    t = t.withColumns(_base(F.col("text")))
    n = F.size("words")
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    # A byte search of the whole text for each common word: looking every word up in their list takes many times as long.
    joined = F.concat(F.lit(" "), F.lower(F.array_join("words", "  ")), F.lit(" "))
    t = t.withColumns({"windows": windows, "joined": joined})
    keys = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    t = t.withColumn("keys", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), keys))
    t = t.withColumn("starts", _repeated_starts(F.col("keys"), F.col("words")))
    t = t.withColumn("n_repeat_words", F.when(F.col("keys").isNull(), F.lit(0).cast("long")).otherwise(_reach(F.col("starts"))))
    # One column for each stage of stripping, so that no pattern runs twice.
    names, prev = [], "text"
    for name, pattern in CLASSES.items():
        t = t.withColumn(f"left_{name}", F.regexp_replace(prev, pattern, ""))
        names.append((name, prev, f"left_{name}"))
        prev = f"left_{name}"
    # Symbols are in no class, so all of them are left.
    t = t.withColumn("no_symbols", F.regexp_replace(prev, r"[#*$%&|<>]+", ""))
    classes = [(F.length(a) - F.length(b)).alias(name) for name, a, b in names] + [F.length(prev).alias("other")]
    return t.select(
        "_row",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length(prev) - F.length("no_symbols")).cast("long").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        F.length("text").cast("long").alias("n_chars"),
        F.array(*[c.cast("double") for c in classes]).alias("class_counts"),
        F.transform("ref_words", lambda w: _occurrences(F.col("joined"), w)).alias("common_counts"),
    )


def _proportions(counts_col: str, total: Column) -> Column:
    return F.transform(counts_col, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def histograms(counted: DataFrame) -> DataFrame:
    """Adds ``class_hist`` (shares of the text) and ``common_hist`` (shares of the words, the last bin all other words)."""
    words = F.col("n_words").cast("double")
    hits = _proportions("common_counts", words)
    rest = F.aggregate("common_counts", words, lambda acc, x: acc - x)
    return counted.withColumns(
        {
            "class_hist": _proportions("class_counts", F.col("n_chars").cast("double")),
            "common_hist": F.concat(hits, F.array(F.when(words > 0, rest / words).otherwise(F.lit(0.0)))),
        }
    )


def references(hists: DataFrame) -> DataFrame:
    """Mean histograms of each language that has common words over its judged documents: LANGUAGE_SHARE rows at most."""
    fit = hists.where(F.col("common_hist").isNotNull() & (F.col("n_words") >= MIN_WORDS_COMMON))
    mean = lambda col, size: F.array(*[F.avg(F.get(col, F.lit(i))) for i in range(size)])
    sums = fit.groupBy("lang").agg(mean("class_hist", len(CLASS_NAMES)).alias("class_ref"), mean("common_hist", COMMON_WORDS + 1).alias("common_ref"))
    # A language with fewer common words leaves the last bins empty.
    return sums.withColumn("common_ref", F.filter("common_ref", lambda x: x.isNotNull()))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms, 0 to 1."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)))


def limits(judged: DataFrame) -> DataFrame:
    """class_limit of each language: CLASS_LIMIT times the median class distance of its judged documents."""
    fit = judged.where(F.col("class_distance").isNotNull() & (F.col("n_words") >= MIN_WORDS_COMMON))
    return fit.groupBy("lang").agg(F.round(CLASS_LIMIT * F.percentile_approx("class_distance", 0.5, 100_000), 3).alias("class_limit"))


def score_quality(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang", carry: bool = False, word_limit: float = WORD_LIMIT) -> DataFrame:
    """``_row`` (the input row, with its text if ``carry``), counts, distances, base_failed and kept for each row.

    A null or blank text has no words and fails the base rule. A document below a minimum length skips that
    histogram's rule; one without a language, or whose language has no reference, is judged by the base rule alone.
    Very long texts are handled whole within their row; ties and repeated rows are judged alike; an empty table gives
    no rows; other columns are carried and never read.
    """
    counted = materialize(counts(df, text_col, lang_col, carry), "quality-counts")
    hists = histograms(counted)
    means = materialize(references(hists.drop("_row")), "quality-references")
    # What a text without common words would have: all its words in the last bin.
    none = F.transform("common_ref", lambda x, i: F.when(i == F.size("common_ref") - 1, 1.0).otherwise(0.0))
    means = means.withColumn("word_limit", word_limit * js_distance(none, F.col("common_ref")))
    judged = hists.join(F.broadcast(means), "lang", "left").withColumns(
        {"class_distance": js_distance(F.col("class_hist"), F.col("class_ref")), "word_distance": js_distance(F.col("common_hist"), F.col("common_ref"))}
    )
    bounds = materialize(limits(judged.drop("_row")), "quality-limits")
    judged = judged.join(F.broadcast(bounds), "lang", "left")
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    far = ((n >= MIN_WORDS_CLASSES) & (F.col("class_distance") > F.col("class_limit"))) | (
        (n >= MIN_WORDS_COMMON) & (F.col("word_distance") > F.col("word_limit"))
    )
    return judged.select(
        "_row",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"),
        failed.alias("base_failed"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document, as ``score_quality`` defines them; null and empty texts have no words and fail."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return score_quality(docs).select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
