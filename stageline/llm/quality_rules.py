"""Quality rules: a threshold table, compiled into one Spark projection.

Every rule bounds one ratio of a text: lengths, symbols, stop words, lines. The ratios
are expressions over counts that the text gives without user functions, so that a rule
is a comparison in a projection and a table of rules is a projection.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a text of fewer words, or with more percent of its words in repeated windows, fails
MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 20, 8, 30
#: rules that a table may hold: the table becomes one expression
MAX_RULES = 1000

WORD_CHAR, SYMBOL = r"[^\x20\x09-\x0D]", r"[#*$%&|<>]"
#: an exclamation mark at the end of a word; a word without a letter
SHOUT = r"!(?![^\x20\x09-\x0D])"
WORD_WITHOUT_LETTER = r"(?:^|[\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])"
BULLET_LINE = r"^[ \t]*[-*\x{2022}\x{25CF}\x{25E6}]"
_STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "that", "with", "for", "on",
    "der", "die", "das", "und", "ist", "zu", "nicht", "von", "den", "mit",
    "el", "los", "las", "que", "y", "en", "un", "por", "con", "del",
    "le", "la", "les", "de", "et", "des", "une", "est", "pour", "dans",
]
#: as they stand in a text: lower-case, capitalised, upper-case
STOP_WORDS = [form for w in _STOP_WORDS for form in dict.fromkeys((w, w.capitalize(), w.upper()))]
#: columns that ``counted`` adds
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_shouts",
    "n_letter_words", "n_bullet_lines", "n_ellipsis_lines",
]


@dataclass(frozen=True)
class Rule:
    """``name`` fails where ``ratio`` is below ``low`` or above ``high``; null is open."""

    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


#: ratios a rule may name, over the counts of ``counted``; a text without words has 0
RATIOS = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "stop_words": "n_stop_words / greatest(n_words, 1)",
    "shouted_words": "n_shouts / greatest(n_words, 1)",
    "letter_words": "n_letter_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "bullet_lines": "n_bullet_lines / greatest(n_lines, 1)",
    "ellipsis_lines": "n_ellipsis_lines / greatest(n_lines, 1)",
}
RULES = [
    Rule("words too short or too long", "word_length", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("few stop words", "stop_words", 0.02, None),
    Rule("shouting", "shouted_words", None, 0.1),
    Rule("few words with letters", "letter_words", 0.8, None),
    Rule("repeated lines", "duplicate_lines", None, 0.3),
    Rule("bullets", "bullet_lines", None, 0.9),
    Rule("ellipses", "ellipsis_lines", None, 0.3),
]


def rules_from(table: DataFrame) -> list[Rule]:
    """The rules of a table ``name, ratio, low, high``; at most ``MAX_RULES`` rows."""
    rows = table.select("name", "ratio", "low", "high").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [Rule(*row) for row in rows]


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of runs of twice the length: each run with the one that follows it."""
    runs = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), runs), F.slice(hashes, F.lit(1 + step), runs), lambda a, b: F.xxhash64(a, b))


def _repeats(hashes: str) -> Column:
    """How many elements stood before; null for no array."""
    return F.size(hashes) - F.size(F.array_distinct(hashes))


def _covered(marks: Column) -> Column:
    """Words inside windows that start at the given sorted places."""
    following = F.slice(marks, F.lit(2), F.greatest(F.size(marks), F.lit(1)))
    steps = F.zip_with(marks, following, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the counts of their texts, in place of other columns of the names.

    Counts are exact but for windows, which are compared by 64-bit hashes. They are
    steps of projections: what several counts need, such as the words, is found once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.regexp_replace(text, r"[\x09-\x0D]+", " ")
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHAR))
    rows = docs.select(F.struct("*").alias("__row"), text.alias("__text"), words.alias("__words"), lines.alias("__lines"))
    n_words, n_lines = F.size("__words").cast("long"), F.size("__lines").cast("long")

    def times(pattern: str) -> Column:
        return F.regexp_count("__text", F.lit(pattern)).cast("long")

    def lines_that(holds) -> Column:
        return F.size(F.filter("__lines", holds)).cast("long")

    def ends_open(line: Column) -> Column:
        end = F.rtrim(line, F.lit(" \t\r"))
        return F.endswith(end, F.lit("...")) | F.endswith(end, F.lit("\u2026"))

    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": times(SYMBOL),
        "n_dup_lines": n_lines - F.size(F.array_distinct("__lines")),
        "n_lines": n_lines,
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(STOP_WORDS))).cast("long"),
        "n_shouts": times(SHOUT),
        "n_letter_words": n_words - times(WORD_WITHOUT_LETTER),
        "n_bullet_lines": lines_that(lambda line: line.rlike(BULLET_LINE)),
        "n_ellipsis_lines": lines_that(ends_open),
    }
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    rows = rows.select("__row", *[value.alias(name) for name, value in counts.items()], hashes.alias("__hashes"))
    # a window that the text has twice gives 7 later pairs of words that stood before, and 5
    # such runs of four: texts with fewer go no further, so few are looked at in whole
    rows = rows.withColumn("__pairs", _joined(F.col("__hashes"), 1)).drop("__hashes")
    rows = rows.withColumn("__fours", F.when(_repeats("__pairs") >= 7, _joined(F.col("__pairs"), 2))).drop("__pairs")
    rows = rows.withColumn("__windows", F.when(_repeats("__fours") >= 5, _joined(F.col("__fours"), 4))).drop("__fours")
    repeats = _repeats("__windows") > 0
    placed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn("__sorted", F.when(repeats, F.sort_array(placed)).otherwise(nothing)).drop("__windows")
    again = F.filter(
        "__sorted",
        lambda x, i: (F.get("__sorted", i - 1)["h"] == x["h"]) | (F.get("__sorted", i + 1)["h"] == x["h"]),
    )
    rows = rows.withColumn("__marks", F.sort_array(F.transform(again, lambda x: x["i"])))
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in COUNTS]
    found = F.struct(*[F.col(c) for c in counts], _covered(F.col("__marks")).alias("n_repeat_words"))
    # an array of one row: filters on the counts stay above it, and do not count anew below
    return rows.select(*kept, F.inline(F.array(found)))


def failed_rules(rules: Iterable[Rule]) -> Column:
    """The names of the rules that a row of ``counted`` fails, as one expression."""
    tests = []
    for rule in rules:
        ratio = F.expr(RATIOS[rule.ratio])
        out = F.lit(False)
        if rule.low is not None:
            out = out | (ratio < F.lit(float(rule.low)))
        if rule.high is not None:
            out = out | (ratio > F.lit(float(rule.high)))
        tests.append(F.when(out, F.lit(rule.name)))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def judge(
    docs: DataFrame, rules: Iterable[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, all counts, ``base_failed``, ``failed`` (names of
    the rules of the table that it fails), ``kept``.

    Words are runs without white space; lines are split at line feeds and count if they
    have a word. ``n_dup_lines`` are lines equal to an earlier one, ``n_repeat_words`` the
    words in windows of 8 words that the text has twice or more, the first included. Null
    is the empty text: no words, so that it fails. A very long text is one row, handled in
    whole. Rows that repeat an id or a text are judged one by one; other columns are not
    read. An empty table gives no rows; without rules only the base decides.
    """
    rows = counted(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__source")), "__source").drop("__source")
    rows = rows.select("*", base_failed().alias("base_failed"), failed_rules(rules).alias("failed"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def keep_by_rules(docs: DataFrame, rules: Iterable[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that fail neither the base nor a rule; as in ``judge``.

    A filter over one pass: nothing shuffles."""
    inner = docs.select(F.struct("*").alias("__doc"), F.col(text_col).alias("__source"))
    judged = counted(inner, "__source").where(~base_failed() & (F.size(failed_rules(rules)) == 0))
    return judged.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
