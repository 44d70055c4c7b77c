"""Inputs that once broke an operator, through Spark."""

import time
from collections import Counter

import pytest

from gapwatch.llm import html, kdtree, langid, quality


@pytest.mark.parametrize("page", [
    '<ol start="--5"><li>a</ol>', '<ol start="' + "9" * 5000 + '"><li>a</ol>', '<table><tr><td colspan="' + "9" * 5000 + '">a</table>',
    "<![foo[x]]>a", "a<![", "<!a", "<" * 50 + "a", "a</" + "b" * 100_000,
])
def test_wild_markup_does_not_fail(page):
    html.rendered(page)


def test_endless_nesting_takes_linear_time():
    def seconds(n):
        start = time.process_time()
        html.rendered("<b>" * n + "x" + "</i>" * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(16_000) < 10 * max(seconds(4_000), 0.05)


def test_pages_through_spark(spark):
    pages = spark.createDataFrame(
        [(1, "<p>a<p>b", "t"), (1, "<p>a<p>b", "t"), (None, None, "t"), (2, "<![x[y]]><p>c", "t"), (3, "<p>" + "word " * 1_000_000, "t")],
        "page_id bigint, html string, text string")
    found = html.extract_text(pages)
    assert found.columns == ["page_id", "text"]
    rows = [(row["page_id"], row["text"][:9]) for row in found.collect()]
    assert Counter(rows) == Counter({(1, "a\n\nb"): 2, (None, ""): 1, (2, "c"): 1, (3, "word word"): 1})
    assert html.extract_text(pages.limit(0)).collect() == []


def test_lines_with_long_words_and_phrases_in_prose(spark):
    prose = "the new design in the north wing was shown on a blog in may and people liked it a lot because it was so plain and calm"
    docs = spark.createDataFrame(
        [(1, "1" * 200_000 + " b"), (2, prose), (3, prose + " all rights reserved"), (4, prose + "\nclick here\nHome News Sport"),
         (5, "Click here to log in\nAll rights reserved " * 6)], "doc_id bigint, text string")
    start = time.perf_counter()
    found = {row["doc_id"]: row for row in quality.clean_lines(docs).collect()}
    assert time.perf_counter() - start < 60
    assert [found[i]["kept"] for i in (1, 2, 3, 4, 5)] == [False, True, True, True, False]
    assert found[2]["lost_share"] == found[3]["lost_share"] == 0.0 and found[4]["clean_text"] == prose


def test_rows_of_one_id_and_text_are_spread_by_bytes(spark):
    rows = [(7, "x" * 100) for _ in range(200)] + [(i, "y" * (50 + i % 100)) for i in range(400)]
    found = kdtree.kd_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=8).collect()
    sizes = Counter()
    for row in found:
        sizes[row["shard"]] += row["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(size - mean) for size in sizes.values()) < 0.1 * mean
    for shard in range(8):
        slots = sorted(row["slot"] for row in found if row["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "das ist ein haus und ein garten", "de") for i in range(20)] + [
        (i, "this is a house and a garden", "en") for i in range(20, 40)], "doc_id bigint, text string, lang string")
    from pyspark.sql import functions as F

    model = langid.fit_languages(docs, F.lit(True))
    odd = spark.createDataFrame([(1, "½"), (2, "²³"), (3, "Ⅷ"), (4, None), (5, "12_!"), (6, "ein Haus")], "doc_id bigint, text string")
    found = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in langid.identify_language(odd, model).collect()}
    assert [found[i] for i in range(1, 6)] == [("und", 0.0)] * 5 and found[6][0] == "de"
