"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits and signs that stand for
letters), the lexicon's entries are found by an Aho-Corasick automaton, hits
inside exception phrases don't count, and the weighted hits, as such and
relative to the length, give a logistic score.

Weights come from labelled documents: word stems that occur far more often in
toxic ones. Near copies among them count once, so that the words of a text
that was copied often don't pass for a stem of the lexicon.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import id_and_text, small_batches
from gapwatch.llm.shingles import shingle_set, word_hashes

#: Letters of other scripts that look Latin, and digits and signs used for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "к": "k", "м": "m", "т": "t", "н": "h", "в": "b", "ԛ": "q", "ԝ": "w", "α": "a", "ο": "o", "ρ": "p", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
#: Insults known beforehand; labels decide where they say enough about a word.
KNOWN = (
    "idiot", "moron", "stupid", "loser", "scum", "imbecile", "asshole", "bastard", "bitch", "fuck", "shithead",
    "dumbass", "retard", "worthless", "pathetic", "disgusting", "connard", "salope", "encule", "abruti", "arschloch",
    "wichser", "schlampe", "dummkopf", "pendejo", "cabron", "gilipollas", "hijo de puta",
)
KNOWN_WEIGHT = 3.0
#: Phrases whose words are not meant as an insult.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "take out the trash", "clown fish", "circus clown", "class clown",
    "pond scum", "scum line", "losers bracket", "not stupid", "no idiot",
)
LONGEST_STEM = 14
SHORTEST_STEM = 4

_FOLD = str.maketrans(HOMOGLYPHS)
_SWAP = str.maketrans(SUBSTITUTES)
_INNER_SIGN = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])")
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W_]+")


def folded(chunk: str) -> str:
    """A run of text without white space, folded; what remains between signs is split by single spaces."""
    chunk = chunk.lower()
    if not chunk.isascii():
        chunk = unicodedata.normalize("NFKD", chunk.translate(_FOLD))
        chunk = "".join(c for c in chunk if not unicodedata.combining(c)).translate(_FOLD)
    if not chunk.isalpha():
        if _LETTER.search(chunk):
            chunk = _INNER_SIGN.sub(lambda m: SUBSTITUTES[m[0]], chunk)
            chunk = _OTHER.sub(" ", chunk).strip()
            chunk = " ".join(w.translate(_SWAP) if _LETTER.search(w) else w for w in chunk.split(" "))
        else:
            chunk = _OTHER.sub(" ", chunk).strip()
    return chunk


class Folder:
    """Folds texts, keeping a bounded number of chunks it has folded before."""

    def __init__(self, most: int = 200_000):
        self._known: dict[str, str] = {}
        self._most = most

    def words(self, text: str) -> list[str]:
        known, out = self._known, []
        for chunk in text.split():
            word = known.get(chunk)
            if word is None:
                if len(known) >= self._most:
                    known.clear()
                word = known[chunk] = folded(chunk)
            if word:
                out.append(word)
        return out


@dataclass
class Lexicon:
    """Entries match at the start of a word; ``bias`` and ``slopes`` turn hits into a score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float = -4.0
    slopes: tuple[float, float] = (4.0, 0.5)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self._lexicon, self._fold = lexicon, Folder()
        self._automaton = ahocorasick.Automaton()
        entries = {f" {entry}": (weight, len(entry)) for entry, weight in lexicon.weights.items()}
        entries |= {f" {' '.join(map(folded, phrase.split()))} ": (0.0, len(phrase)) for phrase in lexicon.exceptions}
        for entry, value in entries.items():
            self._automaton.add_word(entry, (value[0], len(entry)))
        self._automaton.make_automaton()

    def features(self, text: str) -> tuple[float, int]:
        """Sum of the weights of the hits, and the number of words."""
        words = self._fold.words(text)
        if not words or not len(self._automaton):
            return 0.0, len(words)
        hits, excused = [], []
        for end, (weight, length) in self._automaton.iter(f" {' '.join(words)} "):
            (hits if weight else excused).append((end - length + 1, end, weight))
        total, last = 0.0, -1
        for start, end, weight in sorted(hits):
            # of entries that start together, such as a stem and its longer form, one counts
            if start != last and not any(a <= start and end <= b for a, b, _ in excused):
                total += weight
                last = start
        return total, len(words)

    def score(self, text: str) -> float:
        return scored(self._lexicon, *self.features(text))


def _inputs(total: float, words: int) -> tuple[float, float]:
    return math.log1p(max(0.0, total)), math.log1p(100 * max(0.0, total) / (words + 20))


def scored(lexicon: Lexicon, total: float, words: int) -> float:
    x = lexicon.bias + sum(s * v for s, v in zip(lexicon.slopes, _inputs(total, words)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _labelled_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = Folder()
    for batch in batches:
        signs, words, texts = [], [], batch.column("text").to_pylist()
        for i, text in enumerate(texts):
            shingles = shingle_set(word_hashes(text), 5)
            signs.append(int(shingles.min().view(np.int64)) if len(shingles) else -i)
            words.append(sorted({w for run in fold.words(text) for w in run.split(" ")}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(signs, pa.int64()), pa.array(words, pa.list_(pa.string())), batch.column("text")],
            names=["toxic", "sign", "words", "text"])


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task with each stem, toxic and other; a whole word is a stem with a final space."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for toxic, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
            counts[toxic].update({w[:n] for w in words for n in range(SHORTEST_STEM, min(len(w), LONGEST_STEM) + 1)})
    stems = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(stems), 50_000):
        part = stems[at: at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([counts[1][s] for s in part], pa.int64()), pa.array([counts[0][s] for s in part], pa.int64())],
            names=["stem", "toxic", "other"])


def _features_of(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())],
                names=["toxic", "total", "words"])

    return run


def _chosen(rows: list, n_toxic: int, n_other: int) -> dict[str, float]:
    """Stems and weights: of a family of prefixes the longest that still has nine tenths of the documents."""
    counts = {r["stem"]: (r["toxic"], r["other"]) for r in rows}
    weight = {
        s: math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_other + 1)) for s, (a, b) in counts.items()}
    children: dict[str, list[str]] = {}
    for stem in counts:
        children.setdefault(stem[:-1], []).append(stem)
    chosen: dict[str, float] = {}
    for stem in sorted(counts, key=len):
        if any(stem[:n] in chosen for n in range(SHORTEST_STEM, len(stem))):
            continue
        longest = stem
        while longer := [s for s in children.get(longest, ()) if counts[s][0] >= 0.9 * counts[stem][0]]:
            longest = longer[0]
        chosen[longest] = weight[longest]
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (bias first) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = ridge * np.diag([0.001] + [1.0] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, trains: Column, fit_rows: int = 8_000, least_docs: int = 8, least_share: float = 0.015,
    exceptions: tuple[str, ...] = EXCEPTIONS, id_column: str = "doc_id", text_column: str = "text",
) -> Lexicon:
    """Lexicon and score from labelled documents.

    ``trains`` is a condition on ``doc_id`` of the labels. At most about
    ``fit_rows`` labelled rows are used, chosen by a hash of the id: this
    bounds what is broadcast (their ids) and collected (stems, two numbers per row).
    A stem must occur in ``least_docs`` toxic documents and in ``least_share`` of them.
    With no toxic or no other document among them the known words alone score.
    """
    rows = labels.filter(trains & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    n = rows.count()
    share = min(1.0, fit_rows / max(1, n))
    rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)) <= F.lit(int(share * (1 << 62))))
    sample = small_batches(id_and_text(docs, id_column, text_column)).join(F.broadcast(rows), "doc_id").select("toxic", "text")
    sample = sample.mapInArrow(_labelled_words, "toxic int, sign bigint, words array<string>, text string")
    # One row per sign keeps one of a group of near copies, mostly: the smallest, whatever order the rows come in.
    sample = sample.groupBy("sign", "toxic").agg(F.min(F.struct("text", "words")).alias("row")).select(
        "sign", "toxic", "row.words", "row.text").persist()
    try:
        sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        known = {w: KNOWN_WEIGHT for w in KNOWN}
        if not sizes.get(1) or not sizes.get(0):
            return Lexicon(known, exceptions)
        stems = sample.select("toxic", "words").mapInArrow(_count_stems, "stem string, toxic bigint, other bigint").groupBy(
            "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        least = max(least_docs, least_share * sizes[1])
        telling = (F.col("toxic") >= least) & (F.col("toxic") >= 4 * F.col("other"))
        is_known = F.col("stem").isin(list(KNOWN))
        found = stems.filter(telling | is_known).orderBy(F.desc(is_known), F.desc("toxic"), "stem").limit(20_000).collect()
        told = [r for r in found if r["toxic"] >= max(least, 4 * r["other"])]
        chosen = _chosen(sorted(told, key=lambda r: (-r["toxic"], r["stem"])), sizes[1], sizes[0])
        # Where labels say enough about a word, they decide.
        decided = {r["stem"] for r in found if r["toxic"] + r["other"] >= least_docs}
        known = {w: v for w, v in known.items() if w not in decided}
        lexicon = Lexicon(known | chosen, exceptions)
        points = sample.select("toxic", "text").mapInArrow(_features_of(lexicon), "toxic int, total double, words bigint").toPandas()
        x = np.array([_inputs(t, w) for t, w in zip(points["total"], points["words"])])
        bias, *slopes = _logistic(x, points["toxic"].to_numpy(dtype=float))
        lexicon.bias, lexicon.slopes = float(bias), tuple(max(0.0, float(s)) for s in slopes)
        return lexicon
    finally:
        sample.unpersist()


def score_toxicity(
    docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts score as texts without a hit. Repeated rows score
    alike. Columns of ``docs`` with one of these names are replaced. Nothing
    is shuffled.
    """
    import pandas as pd
    from pyspark.sql.pandas.functions import pandas_udf

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(lexicon)
        for texts in batches:
            yield texts.map(matcher.score)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    score = pandas_udf(run, "double")
    out = small_batches(docs).withColumn("score", score(F.coalesce(F.col(text_column), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
