"""Helpers: bounded tops, words in pieces, folds."""

import random
import zlib

from pyspark.sql import functions as F

from shelfwise.llm import common


def test_most_frequent_keeps_the_top_within_its_bound(spark):
    rng = random.Random(3)
    counts = [int(rng.paretovariate(0.5)) for _ in range(3000)] + [10**9, 10**9 + 1]
    df = spark.createDataFrame(list(enumerate(counts)), "k long, n long")
    for bound in (0, 1, 2, 50, 700, 5000):
        got = sorted((r["n"] for r in common.most_frequent(df, "n", bound).collect()), reverse=True)
        assert len(got) <= bound
        assert got == sorted(counts, reverse=True)[:len(got)]
        rest = sorted(counts, reverse=True)[len(got):]
        assert not (got and rest) or got[-1] > rest[0]  # equal counts stay together
    assert len(common.most_frequent(df, "n", 700).collect()) > 300
    assert common.most_frequent(df.limit(0), "n", 5).collect() == []


def test_words_do_not_depend_on_pieces(monkeypatch):
    text = "Ünder THE\t moon\x0b\x0c\r\n no break " * 50
    expect = text.encode().lower().split()
    monkeypatch.setattr(common, "WORD_PIECE", 7)
    assert [w for part in common.word_lists(text) for w in part] == expect
    assert [w for part in common.word_lists("A" * 100) for w in part] == [b"a" * 100]
    assert list(common.word_lists(None)) == list(common.word_lists("")) == []


def test_folds_follow_the_checksum_of_the_id(spark):
    df = spark.createDataFrame([(i,) for i in [*range(50), -3, None]], "doc_id long")
    for r in df.select("doc_id", common.held_out(F.col("doc_id"), 7, 2).alias("out")).collect():
        assert r["out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_fresh_names_ignore_case(spark):
    df = spark.createDataFrame([(1, 2)], "Score int, _score int")
    assert common.fresh(df, "score") == "__score"
