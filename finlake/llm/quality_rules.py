"""Quality rules: base counts and distribution divergence, built-in functions only.

For every text, the distribution of its characters over ``CLASSES`` and of its
words over the common words of its language is compared with the language's
reference by the Jensen-Shannon distance (the root of the divergence, base 2,
so 0..1).  The references are the pooled counts of all documents of the
language with at least ``MIN_WORDS`` words, for every value of ``lang`` that
the corpus holds: one aggregate, written as a table and joined by language.

Guards: a text under ``MIN_WORDS`` words fails the base rules and is not
compared; a language with under ``REFERENCE_WORDS`` words in all is judged by
the base rules only; words are compared only for languages with a word list;
limits widen for short texts, whose histograms are noisy.

Defined results: null or empty text has no words and fails the base rules;
rows without a ``lang`` are a language of their own; a language without a word
list is compared by characters only; repeated rows give repeated results; texts
of any length are read whole; an empty table gives an empty one; other columns
do not matter and are kept in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import SPACE_CLASS, materialise, text_of, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REFERENCE_WORDS = 1000
CLASSES = ["lower", "upper", "letter", "digit", "space", "point", "symbol"]
SYMBOLS = r"[#*$%&|<>]"
# Removed from the text one after another, the most frequent class first, so that later patterns see a short rest;
# a class counts the code points that its removal takes away, and what is left at the end counts as symbols.
CLASS_RUNS = {"lower": "[a-z]+", "space": f"[{SPACE_CLASS}]+", "letter": r"[\p{L}\p{M}&&[^A-Za-z]]+",
              "upper": "[A-Z]+", "point": r"[.,;:!?'\"()\-]+", "digit": r"\p{N}+"}

# Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "una"],
}
SLOTS = 16

# The limits: distance <= sqrt(LIMIT + NOISE / n_words), as a short text's histogram strays further.
CHAR_LIMIT, CHAR_NOISE = 0.04, 2.0
WORD_LIMIT, WORD_NOISE = 0.03, 4.5




def _features(docs: DataFrame, full: bool) -> DataFrame:
    """``docs`` as a struct ``row`` with the histograms and, if ``full``, the base counts."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                     F.col("lang").alias("lang"), text_of().alias("text"))
    df = df.withColumn("words", words_of(F.col("text")))
    df = df.withColumn("rest0", F.col("text"))
    for i, pattern in enumerate(CLASS_RUNS.values()):
        df = df.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", pattern, ""))
    lengths = [F.length(f"rest{i}").cast("long") for i in range(len(CLASS_RUNS) + 1)]
    df = (df.withColumns({f"c_{n}": lengths[i] - lengths[i + 1] for i, n in enumerate(CLASS_RUNS)}
                         | {"c_symbol": lengths[-1]})
          .drop(*[f"rest{i}" for i in range(len(lengths))]))

    lists = F.lit(None).cast("array<string>")
    for lang, ws in COMMON_WORDS.items():
        lists = F.when(F.col("lang") == lang, F.array(*[F.lit(w) for w in ws])).otherwise(lists)
    every = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    df = (df.withColumn("list", lists)
          .withColumn("hits", F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(every)))
          .withColumn("n_words", F.size("words").cast("long")))
    df = df.withColumns({f"w_{i}": F.coalesce(
        F.size("hits") - F.size(F.array_remove("hits", F.get("list", F.lit(i)))), F.lit(0)).cast("long")
        for i in range(SLOTS)}).drop("hits", "list")
    if not full:
        return df.drop("words", "text")

    lines = F.split("text", "\n", -1)
    said = lambda c: F.filter(c, lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    df = (df.withColumn("lines", said(lines))
          .withColumns({
              "word_chars": F.length(F.array_join("words", "")).cast("long"),
              "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
              "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
          .drop("lines", "text"))
    n_win = F.greatest(F.size("words") - 2, F.lit(0))
    df = df.withColumn("wins", F.slice(F.transform("words", lambda w, i: F.xxhash64(
        w, F.get("words", i + 1), F.get("words", i + 2))), F.lit(1), n_win)).drop("words")
    # only texts with a repeated window pay for sorting (window, position) pairs
    repeats = F.size("wins") > F.size(F.array_distinct("wins"))
    df = df.withColumn("pairs", F.when(repeats, F.sort_array(F.transform(
        "wins", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("wins")
    df = df.withColumn("at", F.sort_array(F.transform(F.filter("pairs", lambda p, i: (
        F.coalesce(F.get("pairs", i - 1)["h"] == p["h"], F.lit(False))
        | F.coalesce(F.get("pairs", i + 1)["h"] == p["h"], F.lit(False)))), lambda p: p["i"]))).drop("pairs")
    covered = F.aggregate(F.transform("at", lambda p, i: F.when(i == 0, F.lit(3)).otherwise(
        F.least(F.lit(3), p - F.get("at", i - 1)))), F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def language_references(docs: DataFrame) -> DataFrame:
    """(language, ref_chars, ref_words): pooled distributions of every language with enough text."""
    sums = {c: F.sum(c).cast("double") for c in [*(f"c_{c}" for c in CLASSES), *(f"w_{i}" for i in range(SLOTS)), "n_words"]}
    rows = (_features(docs, full=False).where(F.col("n_words") >= MIN_WORDS)
            .groupBy(F.coalesce("lang", F.lit("")).alias("language")).agg(*[v.alias(c) for c, v in sums.items()])
            .where(F.col("n_words") >= REFERENCE_WORDS))
    hits = [F.col(f"w_{i}") for i in range(SLOTS)]
    rows = rows.withColumns({"chars": F.array(*[F.col(f"c_{c}") for c in CLASSES]),
                             "hits": F.array(*hits, F.greatest(F.col("n_words") - sum(hits[1:], hits[0]), F.lit(0.0)))})

    def shares(column: str) -> Column:
        total = F.greatest(F.aggregate(column, F.lit(0.0), lambda a, x: a + x), F.lit(1.0))
        return F.transform(column, lambda x: x / total)
    return rows.select("language", shares("chars").alias("ref_chars"), shares("hits").alias("ref_words"))


def _divergence(counts: list[Column], total: Column, ref: list[Column]) -> Column:
    """Jensen-Shannon divergence in bits of counts / total against ``ref``."""
    def part(x: Column, m: Column) -> Column:
        return F.when((x > 0) & (m > 0), x * F.log2(x / m)).otherwise(F.lit(0.0))
    out = F.lit(0.0)
    for c, q in zip(counts, ref, strict=True):
        p = F.try_divide(c.cast("double"), total.cast("double"))
        m = (p + q) / 2
        out = out + (part(p, m) + part(q, m)) / 2
    return out


def assess(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row`` with base counts, distances, ``base_failed`` and ``kept``.

    The references are written first, so their size is known when the join is
    planned: a few rows are broadcast, any number is joined.
    """
    refs = materialise(language_references(docs), "references")
    df = _features(docs, full=True)
    df = df.join(refs, F.coalesce("lang", F.lit("")) == F.col("language"), "left")

    def ref(kind: str, n: int) -> list[Column]:
        return [F.get(f"ref_{kind}", F.lit(i)) for i in range(n)]

    def distance(counts: list[Column], total: Column, kind: str) -> Column:
        d = _divergence(counts, total, ref(kind, len(counts)))
        return F.when(F.col("language").isNotNull(), F.sqrt(F.greatest(F.coalesce(d, F.lit(0.0)), F.lit(0.0))))

    def fits(column: str, limit: float, noise: float) -> Column:
        return F.coalesce(F.col(column) <= F.sqrt(F.lit(limit) + F.try_divide(F.lit(noise), F.col("n_words"))), F.lit(True))

    chars = [F.col(f"c_{c}") for c in CLASSES]
    hits = [F.col(f"w_{i}") for i in range(SLOTS)]
    n_hits = sum(hits[1:], hits[0])
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    df = df.withColumns({
        "char_distance": distance(chars, sum(chars[1:], chars[0]), "chars"),
        "word_distance": F.when(F.col("lang").isin(*COMMON_WORDS),
                                distance([*hits, F.col("n_words") - n_hits], F.col("n_words"), "words")),
        "base_failed": base_failed})
    kept = (~F.col("base_failed") & fits("char_distance", CHAR_LIMIT, CHAR_NOISE)
            & fits("word_distance", WORD_LIMIT, WORD_NOISE))
    return df.withColumn("kept", kept).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "char_distance", "word_distance", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged.

    The verdict is written before it filters: over so many derived columns, a
    filter in the same plan keeps the optimizer's constraint inference busy for
    minutes, whatever the data.
    """
    return materialise(assess(docs).select("row", "kept"), "verdicts").where("kept").select("row.*")
