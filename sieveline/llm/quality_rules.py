"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Every ratio of a text is an expression over its words and lines, and the verdict is the conjunction of
the table's rows, so a scan with this filter is one stage without a shuffle or a user function.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.texts import BLANK_RUN, BLANKS, bind, count_of, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of the languages the rules know.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was were with you "
    "der die das und ist nicht ein eine einer mit von zu den dem im auf für sich des "
    "le la les de du des et est un une dans que pour en qui au avec pas elle il "
    "el los las y un una en por con para del se su no lo al como es"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if its metric lies between the bounds, both included; None leaves a side open."""

    metric: str
    least: float | None = None
    most: float | None = None

    def passed(self) -> Column:
        sides = []
        if self.least is not None:
            sides.append(F.col(self.metric) >= F.lit(float(self.least)))
        if self.most is not None:
            sides.append(F.col(self.metric) <= F.lit(float(self.most)))
        return reduce(lambda a, b: a & b, sides, F.lit(True))


RULES = (
    Rule("n_words", 10),
    Rule("mean_word_chars", 1.5, 14),
    Rule("symbols_per_word", None, 0.15),
    Rule("upper_ratio", None, 0.5),
    Rule("letter_word_ratio", 0.6),
    Rule("stop_word_ratio", 0.02),
    Rule("dup_line_ratio", None, 0.3),
    Rule("repeat_word_ratio", None, 0.2),
    Rule("ellipsis_line_ratio", None, 0.3),
    Rule("bullet_line_ratio", None, 0.9),
)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of consecutive words that occurs twice or more in the text.

    Windows are compared by 64-bit hashes, and only texts that have two equal ones sort them. Nothing
    is exploded; work and memory are in proportion to the text, but for the sort.
    """

    def covered(starts: Column) -> Column:
        reach = F.transform(
            starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window)))
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def starts_of(ranked: Column) -> Column:
        twin = lambda e, k: (F.get(ranked, k - 1)["h"] == e["h"]) | (F.get(ranked, k + 1)["h"] == e["h"])
        return F.sort_array(F.filter(F.transform(ranked, lambda e, k: F.when(twin(e, k), e["i"])), lambda i: i.isNotNull()))

    def of_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        marked = bind(pairs, lambda ranked: bind(starts_of(ranked), covered))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), marked).otherwise(F.lit(0))

    def of_words(keys: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(keys) - window), lambda i: F.xxhash64(*[F.get(keys, i + d) for d in range(window)])
        )
        return bind(hashes, of_hashes)

    counted = bind(F.transform(words, lambda w: F.xxhash64(w)), of_words)
    return F.when(F.size(words) > window, counted).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its id and the metrics that rules can name. Reads these two columns."""
    base = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("_text"))
    split = base.select(
        "doc_id",
        "_text",
        words_of(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("_lines"),
    )
    words, lines, body = F.col("_words"), F.col("_lines"), F.col("_text")
    known = F.filter(F.split(F.lower(F.translate(body, ".,;:!?", "")), BLANK_RUN), lambda w: w.isin(STOP_WORDS))
    counts = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
        count_of(body, SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(lines).alias("n_lines"),
        F.size(known).alias("n_stop_words"),
        F.regexp_count(body, F.lit("\\p{L}[^\\x20\\x09-\\x0D]*")).alias("n_letter_words"),
        F.size(F.filter(lines, lambda s: s.rlike("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"))).alias("n_ellipsis_lines"),
        F.size(F.filter(lines, lambda s: s.rlike("^[\\x20\\x09-\\x0D]*[-*•‣]"))).alias("n_bullet_lines"),
        F.regexp_count(body, F.lit("\\p{Lu}")).alias("n_upper"),
    )

    def per(count: str, whole: str) -> Column:
        """The share, 0 where there is nothing to share."""
        return F.when(F.col(whole) > 0, F.col(count) / F.col(whole)).otherwise(F.lit(0.0))

    return counts.withColumns(
        {
            "mean_word_chars": per("word_chars", "n_words"),
            "symbols_per_word": per("n_symbols", "n_words"),
            "upper_ratio": per("n_upper", "word_chars"),
            "letter_word_ratio": per("n_letter_words", "n_words"),
            "stop_word_ratio": per("n_stop_words", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "repeat_word_ratio": per("n_repeat_words", "n_words"),
            "ellipsis_line_ratio": per("n_ellipsis_lines", "n_lines"),
            "bullet_line_ratio": per("n_bullet_lines", "n_lines"),
        }
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Metrics, ``base_failed`` (under 10 words, or over a fifth of them repeated) and ``kept`` per document.

    ``kept`` is false where the base fails, else whether every rule passes. A null text counts as
    empty and fails; null ids and repeated rows are kept as they are; columns of ``docs`` other than
    the two named are not read.
    """
    metrics = measured(docs, id, text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = reduce(lambda a, b: a & b, [r.passed() for r in rules], F.lit(True))
    return metrics.withColumns({"base_failed": failed, "kept": ~failed & verdict})
