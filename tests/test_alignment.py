"""The alignment table function against the score it explains."""

import pytest

import brute
from linkwell.functions.alignment import register


def test_blocks_make_up_the_partial_ratio(spark):
    register(spark)
    pairs = [
        (1, "acme north", "the acme northern company"), (2, "globex", "globex"), (3, "abxcd", "zzabcdzz"), (4, "", "x"), (5, None, "x"),
        (6, "kitten", "sitting"), (7, "é日本", "日本é"), (8, "long text here", "text"), (9, "abcd", "bcda"), (10, "q", "zzz"),
    ]
    spark.createDataFrame(pairs, "id int, a string, b string").repartition(3).createOrReplaceTempView("text_pairs")
    rows = spark.sql("SELECT * FROM align_texts(TABLE(text_pairs)) ORDER BY id, block").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r)
    texts = {i: (a or "", b or "") for i, a, b in pairs}
    for i, (a, b) in texts.items():
        found = by_id.get(i, [])
        assert [r.block for r in found] == list(range(len(found)))
        for r, after in zip(found, found[1:]):
            assert r.a_from + r.length <= after.a_from and r.b_from + r.length <= after.b_from
        for r in found:
            assert r.text == a[r.a_from : r.a_from + r.length] == b[r.b_from : r.b_from + r.length]
        score, same = brute.partial_ratio(a, b), sum(r.length for r in found)
        short = min(len(a), len(b))
        assert score == (2 * same / (short + found[0].window) if found else 0) and len({r.window for r in found}) <= 1


def test_the_table_needs_its_columns(spark):
    register(spark)
    spark.createDataFrame([(1, "x")], "id int, a string").createOrReplaceTempView("no_pairs")
    with pytest.raises(Exception, match="id, a and b"):
        spark.sql("SELECT * FROM align_texts(TABLE(no_pairs))").collect()
