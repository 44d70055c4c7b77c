"""Source divergence, the prefix trie and the n-gram join: SQL twins on odd tables, small blocks, empty tables."""

import itertools
import random

import duckdb
import numpy as np
import pytest

from gapwatch.llm import divergence, fragments, neardup, trie, twins

DOCS = "doc_id bigint, text string, lang string, source string, term string, node bigint, rank string"
TURNS = "conv_id bigint, turn bigint, role string, text string, path string, depth string"


def _same(frame, table, rows, schema, sql):
    """The frame against its twin over the same rows."""
    names = [column.split()[0] for column in schema.split(", ")]
    types = {"bigint": "BIGINT", "string": "VARCHAR"}
    duck = duckdb.connect()
    duck.execute(f"CREATE TABLE {table} ({', '.join(f'{c.split()[0]} {types[c.split()[1]]}' for c in schema.split(', '))})")
    if rows:
        duck.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' for _ in names)})", rows)
    columns = sorted(frame.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    found = [tuple(row) for row in frame.select(columns).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    return found


def _documents(seed, n=60):
    """Documents of few words, with nulls, empty and blank texts, repeated rows, shared and null ids, near and exact copies."""
    draw = random.Random(seed)
    words = [draw.choice(["ab", "Cd", "é", "ñandú", "x1y", "q", "Straße"]) + str(draw.randrange(6)) for _ in range(40)]
    rows = []
    for i in range(n):
        text = " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 3, 5, 20, 60])))
        rows.append((i, draw.choice([text, text, text, None, "", " \t\n", "1 2 3"]), draw.choice(["en", "de", None, ""]),
                     draw.choice(["a", "b", "c", "d", "é", None, ""]), "t", i, "r"))
    for i, row in enumerate(draw.choices(rows, k=20)):
        rows.append((draw.choice([row[0], 100 + i, None]), *row[1:]))
    base = [f"w{i}" for i in range(120)]
    for i in range(25):
        changed = list(base)
        for _ in range(draw.randrange(4)):
            changed[draw.randrange(120)] = f"new{draw.randrange(5)}"
        rows.append((200 + i, draw.choice([" ", "  ", "\n"]).join(changed).upper() if i % 2 else " ".join(changed), "en", "a", None, None, None))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_divergence_on_odd_tables(spark, monkeypatch, seed):
    # Blocks of three terms, tiles of two groups, a handful of characters counted at a time.
    for name, value in (("BLOCK_TERMS", 3), ("TILE_GROUPS", 2), ("HELD_CHARS", 50)):
        monkeypatch.setattr(divergence, name, value)
    rows = _documents(seed)
    frame = divergence.source_divergence(spark.createDataFrame(rows, DOCS), least_documents=3, most_terms=2)
    found = _same(frame, "documents", rows, DOCS, twins.source_divergence(3, 2))
    assert {part for row in found for part in row if part in ("pair", "term")} == {"pair", "term"}


def test_divergence_without_kept_terms_and_without_rows(spark):
    rows = _documents(0, 10)[:10]
    frame = divergence.source_divergence(spark.createDataFrame(rows, DOCS), least_documents=1000)
    found = _same(frame, "documents", rows, DOCS, twins.source_divergence(1000))
    assert all("pair" in row for row in found)
    assert divergence.source_divergence(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("most_columns", [4, 2048])
def test_products_of_indicators_agree_with_term_by_term(monkeypatch, most_columns):
    monkeypatch.setattr(divergence, "MOST_COLUMNS", most_columns)
    prices = np.random.default_rng(3).integers(1, 40, (50, 7)) ** 5
    first, second = np.array([0, 2, 3]), np.array([1, 2, 6])
    sums = divergence.joint_sums(prices, first, second)
    for (i, g), (j, h) in itertools.product(enumerate(first), enumerate(second)):
        assert sums[i, j] == sum((p - q) ** 2 // (p + q) for p, q in zip(prices[:, g].tolist(), prices[:, h].tolist()))


def test_prices_of_counts_beyond_a_long(spark):
    count, of, kept = 10 ** 15, 3 * 10 ** 15 + 7, 12345
    frame = spark.createDataFrame([(count, of, kept), (5, of, kept), (0, 9, 1)], "c bigint, n bigint, v bigint")
    found = [row[0] for row in frame.select(divergence._price("c", "n", "v")).collect()]
    assert found == [1 + 10 ** 9 * (c + 2) // (n + 2 * v) for c, n, v in ((count, of, kept), (5, of, kept), (0, 9, 1))]


def _turns(seed, convs=40):
    """Conversations that share beginnings; gaps in ids, ties and nulls among turns, repeated rows, null ids."""
    draw = random.Random(seed)
    rows = []
    for conv in range(convs):
        if conv % 7 == 3:
            continue
        for turn in range(draw.choice([0, 1, 2, 5, 12])):
            rows.append((conv, draw.choice([turn, turn, None, 0]), draw.choice(["user", "bot", None]),
                         draw.choice(["hi", "yes", "", None, "é" * 3]), "p", "d"))
    return rows + rows[:5] + [(None, 0, "user", "hi", "p", "d")]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("shard_turns", [2, 7, 1000])
def test_trie_in_any_number_of_shards(spark, seed, shard_turns):
    rows = _turns(seed)
    _same(trie.prefix_trie(spark.createDataFrame(rows, TURNS), shard_turns), "conversations", rows, TURNS, twins.prefix_trie())


def test_copies_of_one_conversation_fill_several_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPLITTER_TURNS", 2)
    rows = [(5 * c, t, "user", f"turn {t}", "p", "d") for c in range(60) for t in range(3)]
    frame = trie.prefix_trie(spark.createDataFrame(rows, TURNS), 10)
    found = _same(frame, "conversations", rows, TURNS, twins.prefix_trie())
    assert len(found) == 4


def test_trie_of_nothing_and_of_a_very_long_text(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(0, 0, "user", "long " * 1_000_000, "p", "d"), (0, 1, "bot", "x", "p", "d"), (1, 0, "user", "y", "p", "d")]
    _same(trie.prefix_trie(spark.createDataFrame(rows, TURNS)), "conversations", rows, TURNS, twins.prefix_trie())


def _small_blocks(monkeypatch):
    for name, value in (("STAR", 2), ("BLOCK", 3), ("BLOCK_GRAMS", 500), ("HELD_BYTES", 4000), ("FRAGMENTS", 3)):
        monkeypatch.setattr(fragments, name, value)


@pytest.mark.parametrize("seed", range(2))
def test_join_on_odd_tables(spark, monkeypatch, seed):
    _small_blocks(monkeypatch)
    rows = _documents(seed)
    found = _same(fragments.similar_groups(spark.createDataFrame(rows, DOCS), fragments=3), "documents", rows, DOCS, twins.ngram_join())
    assert len(found) == len(rows)
    assert sum(component != doc_id for component, doc_id, _ in found) > 10


def test_a_group_whose_centre_alone_links_it(spark, monkeypatch):
    # Variants of a base by other words: each is linked to the base, which is not the first, and to no other variant.
    _small_blocks(monkeypatch)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(30):
        changed = list(base)
        for k in (3 * i, 3 * i + 1):
            changed[(k * 3) % 100] = f"own{i}-{k}"
        rows.append((i, " ".join(changed), "en", "a", None, None, None))
    rows.append((1000, " ".join(base), "en", "a", None, None, None))
    found = _same(fragments.similar_groups(spark.createDataFrame(rows, DOCS)), "documents", rows, DOCS, twins.ngram_join())
    assert {component for component, _, _ in found} == {0}


def test_join_of_nothing_and_of_a_very_long_text(spark):
    assert fragments.similar_groups(spark.createDataFrame([], DOCS)).collect() == []
    long = " ".join(f"v{i}" for i in range(600_000))
    rows = [(3, long, "en", "a", None, None, None), (2, long + " end", "en", "a", None, None, None), (1, "v1 v2", "en", "a", None, None, None)]
    found = fragments.similar_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert {tuple(row) for row in found} == {(3, 599_996, 2), (2, 599_997, 2), (1, 1, 1)}


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_prefixes_and_bounds_lose_no_link(percent):
    draw = np.random.default_rng(percent)
    order = fragments.Order.from_counts(draw.integers(0, 5, 1 << fragments.BUCKET_BITS), 4)
    for _ in range(300):
        both = draw.integers(0, 1 << 63, draw.integers(2, 60), dtype=np.uint64) * np.uint64(2)
        one, other = (np.unique(draw.choice(both, draw.integers(1, len(both) + 1))) for _ in range(2))
        common = len(np.intersect1d(one, other))
        linked = 100 * common >= percent * (len(one) + len(other) - common)
        assert fragments.overlap_reaches(order.segments(one), order.segments(other), percent) == linked
        if linked:
            assert len(np.intersect1d(order.prefix(one, percent), order.prefix(other, percent)))
            for per_gram in (2, 16):
                a, b = (fragments.parity(grams, per_gram) for grams in (one, other))
                assert fragments.may_link(a, len(one), b, len(other), percent)


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_agree_with_their_twin(spark, monkeypatch, seed):
    for name, value in (("BLOCK", 3), ("BLOCK_SHINGLES", 500), ("HELD_BYTES", 4000)):
        monkeypatch.setattr(neardup, name, value)
    rows = _documents(seed)
    _same(neardup.near_duplicates(spark.createDataFrame(rows, DOCS)), "documents", rows, DOCS, twins.near_duplicates())
