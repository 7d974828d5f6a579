r"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

``RULES`` states each rule as a ratio of two measures and the range in which a text is kept. ``compile_rules`` turns the table
into boolean columns, so a new rule is a new line of the table. All measures come from the row itself: nothing is shuffled.

Words are ``[^\x20\x09-\x0D]+``. Windows of three words are found twice by sorting their 64-bit hashes and places, and comparing the words of
neighbours with equal hashes, so a text of n words costs n log n, however repetitive it is.

Stop words count at each occurrence, in any case of A-Z, against all words of the text, so the rule means the same at every length.

Edge cases: null and empty texts have no words, fail the base and are not kept; a text may have any length, as each measure costs n log n at most;
repeated rows give repeated results, an empty table none; columns besides the id and the text are ignored; a ratio with denominator 0 counts as 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "das dem den der des die ein eine im ist mit nicht sich und von zu "
    "au avec dans des du elle en est et la le les par pour qui que sur un une "
    "como con de del el esta las los no para por se su y"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text whose ``measure / per`` is in [low, high]."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("length", "n_words", None, MIN_WORDS, 1_000_000),
    Rule("word_length", "word_chars", "n_words", 2.5, 11.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations", "n_exclamations", "n_words", None, 0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("stop_words", "n_stop_words", "n_words", 0.06, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def compile_rules(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """For each rule, the expression that says whether a row passes; exact, without division."""
    compiled = {}
    for rule in rules:
        measure, per = F.col(rule.measure), F.col(rule.per) if rule.per else F.lit(1)
        tests = [F.lit(True)]
        if rule.low is not None:
            tests.append(measure >= rule.low * per)
        if rule.high is not None:
            tests.append(measure <= rule.high * per)
        passed = tests[0]
        for test in tests[1:]:
            passed = passed & test
        compiled[rule.name] = passed
    return compiled


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it, also where filters are pushed below."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated_words(words: Column) -> Column:
    """Words of the array that lie in a window of three words found twice or more."""
    size = F.size(words)

    def tagged(word: Column, place: Column) -> Column:
        return F.struct(F.xxhash64(word, F.get(words, place + 1), F.get(words, place + 2)).alias("key"), place.alias("place"))

    def starts(windows: Column) -> Column:
        def same(window: Column, at: Column) -> Column:
            other = F.get(windows, at)
            equal = other["key"] == window["key"]
            for k in range(3):
                equal = equal & (F.get(words, other["place"] + k) == F.get(words, window["place"] + k))
            return F.coalesce(equal, F.lit(False))

        repeated = F.filter(windows, lambda window, i: same(window, i - 1) | same(window, i + 1))
        return F.sort_array(F.transform(repeated, lambda window: window["place"].cast("long")))

    def covered(places: Column) -> Column:
        widths = F.transform(places, lambda place, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(places, i + 1) - place, F.lit(3).cast("long"))))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda total, width: total + width)

    return F.when(size >= 3, let(let(F.sort_array(F.transform(F.slice(words, 1, size - 2), tagged)), starts), covered)).otherwise(F.lit(0).cast("long"))


def measures(texts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and all measures of each text."""
    def of(text: Column) -> Column:
        def of_parts(words: Column) -> Column:
            return let(
                F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)),
                lambda lines: F.struct(
                    F.size(words).cast("long").alias("n_words"),
                    F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                    F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                    _repeated_words(words).alias("n_repeat_words"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
                    F.size(F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*\z"))).cast("long").alias("n_ellipsis_lines"),
                    F.size(F.filter(lines, lambda line: line.rlike(r"\A[\x20\x09-\x0D]*[-*•]\x20"))).cast("long").alias("n_bullet_lines"),
                    F.size(F.filter(words, lambda word: F.translate(word, UPPER, UPPER.lower()).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
                ),
            )

        return let(F.array_remove(F.split(text, r"[\x20\x09-\x0D]", -1), ""), of_parts)

    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    return texts.select(F.col(f"`{id_column}`").alias(id_column), let(text, of).alias("_m")).select(id_column, "_m.*")


def apply_rules(texts: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Measures, the base's verdict, the rules that fail, and whether the text is kept."""
    measured = measures(texts, id_column, text_column)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdicts = compile_rules(rules)
    names = F.array_compact(F.array(*(F.when(~passed, F.lit(name)) for name, passed in verdicts.items())))
    return measured.withColumns({"base_failed": failed, "failed_rules": F.concat_ws(",", names)}).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def document_quality(documents: DataFrame) -> DataFrame:
    return apply_rules(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules", "n_lines", "n_stop_words"
    )
