"""Lines of an exported index, read without a pattern for each of their parts."""

from lexspark.sources.index_store import import_text, malformed_lines

GOOD = {"a-b\t1": ("b", "a", 1), "a-b-c\t007": ("b-c", "a", 7), "\\h-\\\\h\\t\t9\u0085": ("\\h\t", "-", 9), "x--\t999999999999999999": ("-", "x", 999999999999999999), "é -\\\\\\\\n \t2": ("\\\\n ", "é ", 2)}
BAD = ["", "a-b", "-b\t1", "a-\t1", "a-b\t", "a-b\t1\t2", "a-b\t-1", "a-b\t1000000000000000000000", "a\t1", "a-b\t1 "]


def test_lines_are_read_as_they_were(spark, tmp_path):
    spark.createDataFrame([(x,) for x in [*GOOD, *BAD]], "value string").write.text(f"{tmp_path}/counts")
    read = import_text(spark, str(tmp_path))
    assert sorted(map(tuple, read.select("doc", "term", "tf").collect())) == sorted(GOOD.values())
    assert sorted(r.value for r in malformed_lines(spark, str(tmp_path)).collect()) == sorted(BAD)
    physical = read._jdf.queryExecution().executedPlan().toString()
    assert physical.count("regexp_extract") <= 1
