"""Quality rules: one projection of length, symbol, stop-word and line ratios against a table of
thresholds, in Spark expressions only.

``quality_columns`` is the projection, ``THRESHOLDS`` the rule table, ``quality_rules`` both on a
table of documents. Everything is computed inside the row: no shuffle, no state between rows.

Defined results: a null or empty text has no words (all counts 0) and fails the base rule; texts
of any length are read whole (5-word windows are compared by a 64-bit hash of their words);
repeated rows each get their own verdict; an empty table gives an empty result. Other columns pass
through ``quality_rules`` untouched unless they have the name of a result column, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oeeflow.llm.common import NOT_WS, WS, let

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by",
              "der", "die", "und", "den", "das", "ist", "nicht", "ein", "eine", "von", "zu", "mit", "auf", "sich",
              "de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con", "no",
              "le", "et", "les", "des", "est", "une", "du", "dans", "qui", "pas", "pour", "sur"]

#: The rule table: (name, ratio, least, most, from_words); a text of at least ``from_words`` words
#: is rejected when the ratio lies outside [least, most]. ``None`` leaves a side open. A ratio is
#: null (and passes) when its denominator is 0.
THRESHOLDS = [
    ("words", "n_words", 10, None, 0),
    ("mean_word_chars", "word_chars / n_words", 2, 30, 0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.3, 0),
    ("stop_words", "n_stop_words / n_words", 0.01, None, 20),
    ("duplicate_lines", "n_dup_lines / n_lines", None, 0.5, 0),
    ("repeated_windows", "n_repeat_words / n_words", None, 0.2, 0),
]


def _repeat_words(words: Column, n: Column, width: int = 5) -> Column:
    """Words that lie in a ``width``-word window found more than once in the text.

    Each window's position takes the low bits of its hash, just as many as the text needs, so
    that one sort of plain longs brings equal windows together; whole hashes are then compared.
    """
    def counted(hashes: Column) -> Column:
        bits = F.ceil(F.log2(n + 1)).cast("int")
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def sorted_together(mask: Column) -> Column:
            packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))
            at = lambda x: x.bitwiseAND(mask).cast("int")
            full = lambda x: F.get(hashes, at(x))

            def covered(ordered: Column) -> Column:
                again = F.filter(ordered, lambda x, i: F.coalesce(full(x) == full(F.get(ordered, i - 1)), F.lit(False))
                                 | F.coalesce(full(x) == full(F.get(ordered, i + 1)), F.lit(False)))
                return let(F.sort_array(F.transform(again, at)), lambda p: F.aggregate(
                    F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))),
                    F.lit(0), lambda a, x: a + x))
            return let(F.sort_array(packed), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(low, sorted_together))
    hashes = F.transform(F.sequence(F.lit(0), n - width),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(n < width, F.lit(0)).otherwise(let(hashes, counted))


def quality_columns(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """A struct of the counts: n_words, word_chars, n_symbols, n_stop_words, n_repeat_words and
    ``lines`` (all, dup), all long. A stop word counts in lower, capitalised or upper case."""
    t = F.coalesce(text, F.lit(""))
    all_words = F.array_remove(F.split(t, f"{WS}++"), "")
    stops = sorted({v for w in stop_words for v in (w, w.capitalize(), w.upper())})

    def of(words: Column) -> Column:
        n = F.size(words)
        lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(NOT_WS)))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, r"[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"),
                                          (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            F.size(F.filter(words, lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
            _repeat_words(words, n).cast("long").alias("n_repeat_words"))
    return let(all_words, of)


def verdict(thresholds: list[tuple] = THRESHOLDS) -> Column:
    """True where every ratio of the table lies inside its bounds, over the count columns."""
    ok = F.lit(True)
    for _, ratio, least, most, from_words in thresholds:
        top, _, bottom = ratio.partition(" / ")
        value = F.col(top).cast("double")
        if bottom:
            value = value / F.when(F.col(bottom) > 0, F.col(bottom).cast("double"))
        inside = F.lit(True)
        if least is not None:
            inside = inside & (value >= F.lit(float(least)))
        if most is not None:
            inside = inside & (value <= F.lit(float(most)))
        ok = ok & (F.coalesce(inside, F.lit(True)) | (F.col("n_words") < from_words))
    return ok


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words"]


def quality_rules(docs: DataFrame, text_col: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` (under 10 words, or over 20% of the words in
    repeated 5-word windows) and ``kept`` (not base_failed, and inside every threshold)."""
    keep = [c for c in docs.columns if c not in (*COUNTS, "base_failed", "kept", "_q")]
    q = docs.withColumn("_q", quality_columns(F.col(text_col)))
    counts = q.select(*keep, *[F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols")],
                      F.col("_q.lines.all").alias("n_lines"), F.col("_q.lines.dup").alias("n_dup_lines"),
                      F.col("_q.n_stop_words").alias("n_stop_words"),
                      F.col("_q.n_repeat_words").alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(thresholds))
