"""Language by words first: known words by their log frequency per language, others by shorter and shorter n-grams.

Counts come from labelled documents. A word that was seen often enough scores
by its frequency in each language. Any other word falls back to its longest
character n-grams that were seen, from LONGEST letters down to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import small_batches

LONGEST = 4
_LETTERS = regex.compile(r"\p{L}+")


def _words(chunk: str) -> list[str]:
    return _LETTERS.findall(chunk.lower())


def _grams(word: str, n: int) -> list[str]:
    """n-grams of the word with its ends marked; single letters are taken without them."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i: i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies per language (columns) of words and n-grams (rows)."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


class Identifier:
    def __init__(self, model: LanguageModel, most: int = 300_000):
        self._model, self._most = model, most
        self._known: dict[str, tuple] = {}
        self._word_scores = [tuple(r) for r in model.word_scores.tolist()]
        self._gram_scores = [tuple(r) for r in model.gram_scores.tolist()]
        self._nothing = (0.0,) * len(model.languages)

    def _word(self, word: str) -> tuple:
        at = self._model.words.get(word)
        if at is not None:
            return self._word_scores[at]
        grams = self._model.grams
        marked = f"<{word}>"
        for n in range(min(LONGEST, len(marked)), 1, -1):
            seen = [grams[g] for i in range(len(marked) - n + 1) if (g := marked[i: i + n]) in grams]
            if seen:
                break
        else:
            seen = [grams[g] for g in word if g in grams]
        if not seen:
            return self._nothing
        rows = [self._gram_scores[at] for at in seen]
        return tuple([sum(column) / len(seen) for column in zip(*rows)])

    def _chunk(self, chunk: str) -> tuple:
        """The scores of a chunk, summed over its words, and their number."""
        scores = [self._word(w) for w in _words(chunk)]
        if len(self._known) >= self._most:
            self._known.clear()
        found = (*scores[0], 1) if len(scores) == 1 else (*map(sum, zip(*scores, self._nothing)), len(scores))
        self._known[chunk] = found
        return found

    def predict(self, text: str) -> tuple[str, float]:
        known = self._known
        rows = [known.get(c) or self._chunk(c) for c in text.split()]
        total = np.array([sum(column) for column in zip(*rows)])
        if not rows or not total[-1] or not self._model.languages:
            return "und", 0.0
        share = np.exp(total[:-1] - total[:-1].max())
        share /= share.sum()
        best = int(share.argmax())
        return self._model.languages[best], float(share[best])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words.setdefault(lang, Counter()).update(_words(text))
    for lang, counted in words.items():
        grams: Counter = Counter()
        for word, count in counted.items():
            for n in range(1, LONGEST + 1):
                for gram in _grams(word, n):
                    grams[gram] += count
        for kind, found in (("word", counted), ("gram", grams)):
            items = list(found.items())
            for at in range(0, len(items), 50_000):
                part = items[at: at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(part)), pa.array([lang] * len(part)), pa.array([k for k, _ in part]),
                     pa.array([c for _, c in part], pa.int64())], names=["kind", "lang", "item", "count"])


def fit_languages(
    docs: DataFrame, trains: Column, fit_rows: int = 5_000, least_count: int = 3, most_items: int = 100_000,
    text_column: str = "text", lang_column: str = "lang",
) -> LanguageModel:
    """Frequencies of words and n-grams per language from documents with a language.

    ``trains`` is a condition on the columns of ``docs``. About ``fit_rows``
    rows at most are read for it, chosen by a hash of their text, so equal texts
    are in or out together; ``most_items`` bounds each of the two tables that
    go to the driver and back. Rarer words are scored by n-grams.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.filter(trains & F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), text.alias("text"))
    n = rows.count()
    share = min(1.0, fit_rows / max(1, n))
    rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 62)) <= F.lit(int(share * (1 << 62))))
    # A text that was copied often counts once per language.
    rows = rows.groupBy("lang", "text").agg(F.lit(1).alias("one")).select("lang", "text")
    counts = small_batches(rows).mapInArrow(_count, "kind string, lang string, item string, count bigint").groupBy(
        "kind", "lang", "item").agg(F.sum("count").alias("count"))
    items = counts.groupBy("kind", "item").agg(
        F.sum("count").alias("total"), F.collect_list(F.struct("lang", "count")).alias("of"))
    items = items.filter(F.col("total") >= least_count).persist()
    try:
        tables = {
            kind: items.filter(F.col("kind") == kind).orderBy(F.desc("total"), "item").limit(most_items).select(
                "item", "of").toArrow().to_pylist() for kind in ("word", "gram")}
    finally:
        items.unpersist()
    languages = sorted({c["lang"] for r in tables["gram"] for c in r["of"]})
    place = {lang: i for i, lang in enumerate(languages)}
    out = {}
    for kind, found in tables.items():
        table = np.zeros((len(found), len(languages)))
        for i, row in enumerate(found):
            for c in row["of"]:
                table[i, place[c["lang"]]] = c["count"]
        total = table.sum(axis=0, keepdims=True) if len(found) else np.zeros((1, len(languages)))
        out[kind] = (
            {r["item"]: i for i, r in enumerate(found)},
            np.log((table + 0.1) / (total + 0.1 * (len(found) + 1))))
    return LanguageModel(languages, *out["word"], *out["gram"])


def identify_language(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (share of the best language, 0 to 1).

    Null texts and texts without a letter are ``und`` with score 0; so is every
    text if the model has learned no language. Repeated rows are judged alike.
    Columns of ``docs`` with one of these names are replaced. Nothing is shuffled.
    """
    import pandas as pd
    from pyspark.sql.pandas.functions import pandas_udf

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see fit_languages

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(shared.value)
        for texts in batches:
            yield pd.DataFrame([identifier.predict(t) for t in texts], columns=["lang", "score"])

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = pandas_udf(predict, "lang string, score double")(F.coalesce(F.col(text_column), F.lit("")))
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return small_batches(docs).select(*names, found.alias("_found")).select(
        *names, F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))
