"""The skip index: no match is lost, and files without the term are not opened."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import textindex
from tidemark.session import scratch_dir

WORDS = ["apple", "Bread", "cheese", "Éclair", "straße", "ΣΟΦΟΣ", "日本語の文", "x"]


@pytest.fixture(scope="module")
def table(spark):
    """Eight files; each has words of its own, and a null and an empty text."""
    path, r = scratch_dir(spark, "texts"), random.Random(2)
    for i in range(8):
        rows = [(i * 100 + j, " ".join(r.choices(WORDS[:2], k=5)) + f" only{i}only {WORDS[i]}") for j in range(20)] + [(i * 100 + 90, None), (i * 100 + 91, "")]
        spark.createDataFrame(rows, "id int, text string").coalesce(1).write.mode("append").parquet(path)
    rows = spark.read.parquet(path)
    index = scratch_dir(spark, "index")
    textindex.write(textindex.build(rows, F.col("text")), index)
    return rows, spark.read.parquet(index), path, index


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_no_match_is_lost(table):
    rows, index, *_ = table
    for term in [*WORDS, "ONLY3only", "bread apple", "PPL", "ab", "a", "", "nowhere", "σοφος", "σοφο", "ÉCLAIR", "本語", "STRASSE", "straße", "only7only x"]:
        want = ids(rows.filter(F.lower("text").contains(F.lower(F.lit(term)))))
        assert ids(textindex.search(rows, index, F.col("text"), term)) == want, term


def test_only_files_with_the_term_are_read(table):
    rows, index, *_ = table
    found = textindex.search(rows, index, F.col("text"), "Only3ONLY")
    assert len(found.inputFiles()) == 1 and len(ids(found)) == 20
    assert len(textindex.search(rows, index, F.col("text"), "apple").inputFiles()) == 8
    assert len(textindex.search(rows, index, F.col("text"), "on").inputFiles()) == 8
    nothing = textindex.search(rows, index, F.col("text"), "zebra quagga")
    assert ids(nothing) == [] and not nothing.inputFiles()


def test_files_the_index_does_not_know_are_read(spark, table):
    rows, index, path, _ = table
    more = scratch_dir(spark, "more")
    spark.createDataFrame([(9001, "Only3only again")], "id int, text string").coalesce(1).write.parquet(more)
    both = spark.read.parquet(path, more)
    found = textindex.search(both, index, F.col("text"), "only3only")
    assert len(found.inputFiles()) == 2 and 9001 in ids(found)
    grown = scratch_dir(spark, "grown")
    textindex.write(index, grown)
    textindex.write(textindex.build(spark.read.parquet(more), F.col("text")), grown, "append")
    assert len(textindex.search(both, spark.read.parquet(grown), F.col("text"), "only5only").inputFiles()) == 1


def test_the_search_reads_its_own_words_of_the_index(table):
    _, index, *_ = table
    plan = textindex.files_with(index, "only3only")._jdf.queryExecution().toString()
    assert "In(word, [" in plan.split("PushedFilters:")[-1]


def test_bits_of_a_term():
    assert textindex.needed("ab") == {} and textindex.spots(np.zeros(0, np.uint8)).size == 0
    one = textindex.needed("abc")
    assert len(one) == 1 and set(one) <= set(textindex.needed("xabcx"))
