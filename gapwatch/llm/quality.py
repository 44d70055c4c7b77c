"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

Only DataFrame functions: every document is one row, its words and lines are
arrays inside the row, so nothing is shuffled, whatever the distribution of
sources or texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import SPACES

#: Fixed by the contract.
SYMBOLS = "#*$%&|<>"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Phrases of page furniture; a short line with one of them goes.
MOST_FURNITURE_WORDS = 15
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "terms and conditions",
    "use of cookies", "uses cookies", "enable javascript", "subscribe to our", "sign up for our", "click here",
    "log in", "sign in", "share this", "powered by", "back to top", "skip to content", "lorem ipsum",
    "spdx-license-identifier", "licensed under",
)


_ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_share", "base_failed", "kept", "clean_text")


def _visible(text: Column) -> Column:
    """Number of characters that are no white space."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return F.length(text)


def _count(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit("[" + re.escape(characters) + "]"))


def _line_fails(line: Column) -> Column:
    """Whether a line breaks a rule; all rules look at this line alone.

    * punctuation: more symbols, or more exclamation and question marks, than a third of its words;
    * navigation: three or more cells cut by bars, bullets or angle quotes, or no sentence at all
      (under five words, no sentence mark) where each word starts with a capital or digit;
    * boilerplate: a phrase of page furniture, as whole words, in a line of at most MOST_FURNITURE_WORDS words.
    """
    split = F.split(F.btrim(line, F.lit(SPACES)), WORD_BREAK)
    words = F.size(split)
    symbols = _count(line, SYMBOLS + "{}~^=_\\")
    marks = _count(line, "!?")
    cells = _count(line, "|•»›")
    titled = F.forall(split, lambda word: F.substring(word, 1, 1).rlike("[\\p{Lu}\\p{N}]"))
    menu = (words < 5) & ~line.rlike("[.!?:;,…。]") & titled
    furniture = (words <= MOST_FURNITURE_WORDS) & F.lower(line).rlike("\\b(?:" + "|".join(BOILERPLATE) + ")\\b")
    return (symbols * 3 > words) | (marks * 3 > words) | (cells >= 3) | menu | furniture


def _assessed(docs: DataFrame, text_column: str) -> DataFrame:
    """``docs`` with the columns of the verdict, under names that clash with none of theirs."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    nothing = F.array().cast("array<string>")
    step = docs.withColumns({
        "_words": F.when(trimmed == "", nothing).otherwise(F.split(trimmed, WORD_BREAK)),
        "_lines": F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != ""),
    })
    step = step.withColumns({
        "_n_words": F.size("_words").cast("bigint"),
        "_word_chars": _visible(text).cast("bigint"),
        "_n_symbols": _count(text, SYMBOLS).cast("bigint"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_ones": F.transform("_words", lambda w: F.xxhash64(w)),
        "_passed": F.filter("_lines", lambda line: ~_line_fails(line)),
    }).drop("_words", "_lines")
    # Windows found twice: sort the hashes, each with its position in the low bits, and compare
    # neighbours; the full hashes of the two positions decide.
    step = step.withColumn("_ones", F.when(F.size("_ones") >= WINDOW, F.col("_ones")).otherwise(F.array().cast("array<bigint>")))
    for width in (1, 2, 4):
        size = F.greatest(F.size("_ones") - width, F.lit(0))
        step = step.withColumn("_ones", F.zip_with(
            F.slice("_ones", 1, size), F.slice("_ones", width + 1, size), lambda a, b: F.xxhash64(a, b)))
    step = step.withColumn("_bits", F.coalesce(F.length(F.bin(F.size("_ones"))), F.lit(1)))
    low = F.expr("shiftleft(1L, _bits) - 1")
    step = step.withColumn("_sorted", F.sort_array(F.transform(
        "_ones", lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint")))))

    def same(one: Column, other: Column) -> Column:
        return F.coalesce(
            (one.bitwiseAND(F.bitwise_not(low)) == other.bitwiseAND(F.bitwise_not(low)))
            & (F.get("_ones", one.bitwiseAND(low).cast("int")) == F.get("_ones", other.bitwiseAND(low).cast("int"))),
            F.lit(False),
        )

    step = step.withColumn("_twice", F.filter(
        "_sorted", lambda x, i: same(x, F.get("_sorted", i - 1)) | same(x, F.get("_sorted", i + 1))))
    step = step.withColumn("_twice", F.sort_array(F.transform("_twice", lambda x: x.bitwiseAND(low))))
    covered = F.transform("_twice", lambda p, i: F.least(
        F.lit(WINDOW).cast("bigint"), F.coalesce(F.get("_twice", i + 1) - p, F.lit(WINDOW).cast("bigint"))))
    step = step.withColumn("_n_repeat_words", F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x))
    step = step.withColumn("_clean_text", F.array_join("_passed", "\n"))
    return step.withColumn("_left_chars", _visible(F.col("_clean_text")).cast("bigint")).drop(
        "_ones", "_bits", "_sorted", "_twice", "_passed")


def clean_lines(
    docs: DataFrame, text_column: str = "text", max_lost: float = 0.5,
) -> DataFrame:
    """``docs`` with the quality columns and the cleaned text.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``,
    ``lost_share`` (characters of words in failing lines), ``base_failed``,
    ``kept`` and ``clean_text`` (the lines that pass, joined). A document is
    kept if the base rules hold and it loses at most ``max_lost`` of its characters.

    Null, empty and blank texts: all counts 0, base_failed, not kept, clean
    text empty. Repeated rows are judged alike, each on its own. Columns of
    ``docs`` with one of these names are replaced, all others stay.
    """
    judged = _assessed(docs, text_column)
    lost = F.when(F.col("_word_chars") > 0, 1 - F.col("_left_chars") / F.col("_word_chars")).otherwise(F.lit(0.0))
    failed = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))
    out = {
        "n_words": F.col("_n_words"), "word_chars": F.col("_word_chars"), "n_symbols": F.col("_n_symbols"),
        "n_dup_lines": F.col("_n_dup_lines"), "n_repeat_words": F.col("_n_repeat_words"),
        "lost_share": lost, "base_failed": failed, "kept": ~failed & (lost <= max_lost), "clean_text": F.col("_clean_text"),
    }
    names = [c for c in docs.columns if c not in out]
    return judged.select(*names, *(column.alias(name) for name, column in out.items()))


def kept_documents(docs: DataFrame, text_column: str = "text", max_lost: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``clean_lines`` keeps, with their columns as they were,
    but for those whose names the verdict takes.

    A filter on the verdict alone would be moved below the steps that lead to
    it, each spelled out inside the next many times over. The row number, which
    can't be moved, keeps the filter above them.
    """
    judged = clean_lines(docs, text_column, max_lost)
    verdict = judged.select(F.col("kept").alias("_kept"), F.monotonically_increasing_id().alias("_row"), *(
        c for c in docs.columns if c in judged.columns and c not in _ADDED))
    return verdict.filter(F.col("_kept") & (F.col("_row") >= 0)).drop("_kept", "_row")
