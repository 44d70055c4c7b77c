"""How far the sources of a language lie apart in their words, from one-hot level products.

1. Terms are counted per (language, source) in the tasks that read the texts;
   a language keeps the terms that enough of its documents have.
2. A group's price ``p`` of a term depends on its count there alone, so a term
   stands at one *level* (one price) in each group. In a block of terms every
   group has an indicator column per level, with a 1 where a term stands at it.
3. The columns times their transpose give, for each two groups at once, how
   many terms stand at level a here and at level b there: the joint table. It is
   priced once per pair of levels instead of once per term.
4. Blocks are products of their own, of bounded size; their sums are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwatch.llm.common import groups, small_batches, table, written

#: Fixed by the contract: prices are shares in units of this, two counts are added to each term.
SCALE, ADDED = 1_000_000_000, 2
#: Terms of a block and groups of a tile: what one product holds at once.
BLOCK_TERMS, TILE_GROUPS = 1024, 48
#: Indicator columns that one product may have; beyond it the block's rows are halved.
MOST_COLUMNS = 2048
#: Characters of text whose terms a task counts before it hands the counts on.
HELD_CHARS = 12 << 20

_PARTS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_COUNTED = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, as UTF-8 with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_PARTS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (language, source, term) of the texts held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def counted():
        for (lang, source), (count, docs) in held.items():
            yield table({
                "lang": [lang] * len(count), "source": [source] * len(count), "term": list(count),
                "count": list(count.values()), "docs": [docs[t] for t in count]}, _COUNTED)

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            terms = terms_of(text.as_py())
            count, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            count.update(terms)
            docs.update(set(terms))
            size += len(text.as_py())
            if size > HELD_CHARS:
                yield from counted()
                held, size = {}, 0
    yield from counted()


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def joint_sums(prices: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Summed distances of each group of ``first`` to each of ``second`` over all terms.

    ``prices`` has a row per term and a column per group; ``first`` and
    ``second`` are column numbers. The product of the indicator columns counts
    terms in float32, exact as no block has 2^24 of them.
    """
    columns = np.unique(np.concatenate((first, second)))
    levels = [np.unique(prices[:, c], return_inverse=True) for c in columns]
    width = sum(len(values) for values, _ in levels)
    if width > MOST_COLUMNS and len(prices) > 1:
        half = len(prices) // 2
        return joint_sums(prices[:half], first, second) + joint_sums(prices[half:], first, second)
    starts = np.cumsum([0, *(len(values) for values, _ in levels)])
    onehot = np.zeros((len(prices), width), dtype=np.float32)
    for start, (_, place) in zip(starts, levels):
        onehot[np.arange(len(prices)), start + place.ravel()] = 1
    at = {c: i for i, c in enumerate(columns)}
    value = np.concatenate([values for values, _ in levels])
    own = lambda group: np.arange(starts[at[group]], starts[at[group] + 1])
    left, right = (np.concatenate([own(g) for g in side]) for side in (first, second))
    joint = (onehot[:, left].T @ onehot[:, right]).astype(np.int64)
    priced = joint * _distance(value[left][:, None], value[right][None, :])
    cut = lambda side: np.cumsum([0, *(len(own(g)) for g in side[:-1])])
    return np.add.reduceat(np.add.reduceat(priced, cut(first), axis=0), cut(second), axis=1)


_FOUND = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
_FOUND_COLUMNS = "lang string, source string, part string, item string, value bigint"
_BLOCK = ["lang", "band", "block", "first_tile", "second_tile"]


def _best(items: list[str], value: np.ndarray, most: int) -> np.ndarray:
    """Rows of the ``most`` largest values, equal ones by the item's UTF-8."""
    if len(value) > most:
        rows = np.flatnonzero(value >= np.partition(value, -most)[-most])
    else:
        rows = np.arange(len(value))
    return np.array(sorted(rows.tolist(), key=lambda i: (-value[i], items[i].encode()))[:most], dtype=np.int64)


def _multiply(most_terms: int):
    """Of one block of terms, the summed distances of the groups of two tiles, and each group's dearest terms."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, _BLOCK):
            header = rows.filter(pc.is_null(rows.column("term")))
            known = rows.filter(pc.is_valid(rows.column("term")))
            names, tiles = header.column("source").to_pylist(), header.column("tile").to_numpy()
            column_of = {name: i for i, name in enumerate(names)}
            terms = known.column("term").combine_chunks().dictionary_encode()
            place, words = terms.indices.to_numpy(), terms.dictionary.to_pylist()
            column = np.array([column_of[s] for s in known.column("source").to_pylist()], dtype=np.int64)
            price = known.column("price").to_numpy()
            # a term that a group lacks stands at the group's price of a count of 0
            prices = np.repeat(header.column("price").to_numpy()[None, :], len(words), axis=0)
            prices[place, column] = price
            first_tile, second_tile = rows.column("first_tile")[0].as_py(), rows.column("second_tile")[0].as_py()
            first, second = np.flatnonzero(tiles == first_tile), np.flatnonzero(tiles == second_tile)
            found: list[tuple] = []
            if len(first) and len(second) and len(words):
                sums = joint_sums(prices, first, second)
                for i, one in enumerate(first.tolist()):
                    for j, other in enumerate(second.tolist()):
                        if one != other:
                            found.append((names[one], "pair", names[other], int(sums[i, j])))
                            if first_tile != second_tile:
                                found.append((names[other], "pair", names[one], int(sums[i, j])))
            if first_tile == second_tile:
                apart = price - known.column("lang_price").to_numpy()
                value = apart ** 2 // (2 * price - apart)
                for group in first.tolist():
                    at = np.flatnonzero((column == group) & (apart > 0))
                    best = at[_best([words[place[i]] for i in at], value[at], most_terms)]
                    found.extend((names[group], "term", words[place[i]], int(value[i])) for i in best)
            if found:
                lang = rows.column("lang")[0].as_py()
                yield table(dict(zip(_FOUND.names, ([lang] * len(found), *zip(*found)))), _FOUND)

    return multiply


def _price(count: str, of: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (of + ADDED * kept)); in decimals where a long would overflow."""
    shares = F.col(of) + ADDED * F.col(kept)
    wide = (F.col(count).cast("decimal(20,0)") + F.lit(ADDED)) * F.lit(SCALE).cast("decimal(10,0)")
    short = (F.col(count) + ADDED) * F.lit(SCALE).cast("bigint")
    return F.when(F.col(count) < F.lit((1 << 63) // SCALE - ADDED - 1), F.call_function("div", short, shares)).otherwise(
        F.call_function("div", wide, shares.cast("decimal(20,0)"))) + 1


def source_divergence(
    docs: DataFrame, least_documents: int = 10, most_terms: int = 10,
    lang_column: str = "lang", source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources and terms that a source's words set apart.

    Part ``pair`` holds every other source of the language with the summed
    distance of the prices of all kept terms, part ``term`` the ``most_terms``
    terms that are dearer in the source than in its language and occur there.
    Ranks go by value, then by the item's UTF-8.

    A null text, language or source counts as empty text. Empty texts make a
    group without terms; a language that keeps no term has distances of 0.
    Repeated rows count as often as they are there. Very long texts are counted
    whole. An empty table gives no rows. Other columns are left behind.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = small_batches(docs.select(
        empty(lang_column).alias("lang"), empty(source_column).alias("source"), empty(text_column).alias("text")))
    counted = texts.mapInArrow(_count, "lang string, source string, term string, count bigint, docs bigint")
    counts = written(counted.groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counts")
    # Terms of one power of two have few levels; such a band is cut into blocks.
    kept = written(counts.groupBy("lang", "term").agg(F.sum("count").alias("total"), F.sum("docs").alias("docs")).filter(
        F.col("docs") >= least_documents).select("lang", "term", "total", F.floor(F.log2("total")).cast("int").alias("band")), "kept")
    bands = kept.groupBy("lang", "band").agg(
        F.ceil(F.count("*") / BLOCK_TERMS).cast("int").alias("blocks"), F.count("*").alias("n"), F.sum("total").alias("total"))
    of_lang = bands.groupBy("lang").agg(F.sum("total").alias("lang_sum"), F.sum("n").alias("n_kept"))
    rows = written(counts.drop("docs").join(kept, ["lang", "term"]), "rows")

    # Every group that occurs, the sum of its kept counts, and what its language keeps.
    sums = rows.groupBy("lang", "source").agg(F.sum("count").alias("source_sum"))
    found = texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(
        0, ["source_sum", "lang_sum", "n_kept"])
    tiles = F.ceil(F.col("n_groups") / TILE_GROUPS).cast("int")
    sources = written(found.join(found.groupBy("lang").agg(F.count("*").alias("n_groups")), "lang").withColumns({
        "tiles": tiles, "tile": F.pmod(F.xxhash64("source"), tiles).cast("int")}), "sources")

    cells = rows.join(sources, ["lang", "source"]).join(bands.select("lang", "band", "blocks"), ["lang", "band"]).select(
        "lang", "band", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"), "source", "term",
        _price("count", "source_sum", "n_kept").alias("price"), _price("total", "lang_sum", "n_kept").alias("lang_price"),
        "tile", "tiles")
    # Every block knows every group of its language.
    headers = sources.withColumn("none", F.lit(0).cast("bigint")).join(bands.select("lang", "band", "blocks"), "lang").select(
        "lang", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
        F.lit(None).cast("string").alias("term"), _price("none", "source_sum", "n_kept").alias("price"),
        F.lit(None).cast("bigint").alias("lang_price"), "tile", "tiles")
    # Each row meets every tile once.
    dealt = cells.unionByName(headers).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "lang", "band", "block", F.least("tile", "other").alias("first_tile"), F.greatest("tile", "other").alias("second_tile"),
        "source", "term", "price", "lang_price", "tile")
    results = written(dealt.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK).mapInArrow(
        _multiply(most_terms), _FOUND_COLUMNS), "results")

    # A language without kept terms has no block: its pairs are 0.
    item = sources.select("lang", F.col("source").alias("item"))
    pairs = sources.select("lang", "source", F.lit("pair").alias("part")).join(item, "lang").filter("source != item").join(
        results.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")),
        ["lang", "source", "item"], "left").fillna(0, ["value"]).select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(results.filter("part = 'term'")).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= most_terms))
