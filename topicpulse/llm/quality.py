"""Quality rules, native: a short-circuit cascade ordered by rejection per cost on a sample.

A document is rejected when the base fails (fewer than ``MIN_WORDS`` words, or over
``MAX_REPEATED`` percent of its words in 8-word windows found twice or more) or when any rule
of the cascade fires. The rules are joined by "or", so their order changes the work but never
the verdict. The order is estimated on a bounded sample (``SAMPLE_ROWS``): each rule's
share of rejected rows over its measured seconds; the best ratio goes first and a row stops at
the first rule that fires.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words: all counts are 0 and the
base fails. Repeated rows are judged alike; other columns are carried untouched.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
SAMPLE_ROWS = 1000
SAMPLE_SHARE = 0.02
BLANKS = " \t\n\x0b\x0c\r"

# Thresholds of the cascade, per word, per word character or per line with a word.
LIMITS = {"symbols": 0.1, "exclamations": 0.2, "capitals": 0.5, "stutter": 0.2, "lines": 0.5,
          "word_chars": (2.0, 15.0)}


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)


def repeated_words(words: Column) -> Column:
    """Words covered by windows that occur twice or more in the same text."""
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(p: Column) -> Column:
            twin = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        def steps(at: Column) -> Column:
            return _total(F.transform(at, lambda x, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))).cast("long")))

        deep = bind(bind(pairs, positions), steps)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(deep)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                           lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    return bind(words, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(
        bind(windows(w), covered)))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base columns and the helpers ``_text``, ``_words`` and ``_lines``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return (docs.withColumns({"_text": body, "_words": text_words(body), "_lines": lines})
            .withColumns({
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("_words"))})
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))))


def rules() -> dict[str, Column]:
    """Rule name to "this row is rejected", over the columns of ``measured``."""
    n = F.col("n_words")
    stutter = bind(F.col("_words"), lambda w: _total(F.transform(
        w, lambda x, i: (F.coalesce(F.get(w, i - 1) == x, F.lit(False))).cast("long"))))
    short, long = LIMITS["word_chars"]
    return {
        "symbols": F.col("n_symbols") > LIMITS["symbols"] * n,
        "word_chars": (F.col("word_chars") < short * n) | (F.col("word_chars") > long * n),
        "lines": F.col("n_dup_lines") > LIMITS["lines"] * F.size("_lines"),
        "exclamations": F.regexp_count("_text", F.lit("!")) > LIMITS["exclamations"] * n,
        "capitals": F.regexp_count("_text", F.lit("\\p{Lu}")) > LIMITS["capitals"] * F.col("word_chars"),
        "stutter": stutter > LIMITS["stutter"] * n,
    }


def cascade_order(docs: DataFrame, text: str = "text") -> list[str]:
    """Rule names by rejected share per second, best first; ties and empty samples keep the given order."""
    names = rules()
    sample = stored(measured(docs.select(text).sample(SAMPLE_SHARE, seed=11).limit(SAMPLE_ROWS), text)
                    .where("not base_failed"), "quality-sample")
    hits = sample.agg(F.count(F.lit(1)), *[F.sum(c.cast("long")) for c in names.values()]).first()
    if not hits[0]:
        return list(names)
    gain = {}
    for (name, rule), hit in zip(names.items(), hits[1:]):
        cost = []
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            sample.agg(F.count(F.when(rule, True))).first()
            cost.append(time.perf_counter() - start)
        gain[name] = (hit or 0) / hits[0] / max(cost[-1], 1e-6)
    return sorted(names, key=lambda x: -gain[x])


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base columns and ``kept``."""
    all_rules, kept = rules(), F.when(F.col("base_failed"), False)
    for name in cascade_order(docs, text):
        kept = kept.when(all_rules[name], False)
    return measured(docs, text).withColumn("kept", kept.otherwise(True)).drop("_text", "_words", "_lines")


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that pass; columns unchanged."""
    verdict = judged(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
                                 F.col("text").alias("_body")), "_body")
    return verdict.where("kept").select("_row.*")
