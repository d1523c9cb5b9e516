from ridemetrics.operators.topk import bottom_rows, top_rows

ROWS = [(2, 5), (1, 5), (3, 4), (4, None), (None, 5)]


def test_ties_go_to_the_smallest_key(spark):
    df = spark.createDataFrame(ROWS, "key int, measure int")
    assert [r.key for r in top_rows(df, "measure", ["key"], 3).collect()] == [1, 2, None]


def test_null_measures_come_last(spark):
    df = spark.createDataFrame(ROWS, "key int, measure int")
    assert bottom_rows(df, "measure", ["key"]).first().key == 3
    assert top_rows(df, "measure", ["key"], 5).collect()[-1].key == 4
    alone = df.filter("measure IS NULL")
    assert bottom_rows(alone, "measure", ["key"]).first().key == 4
    assert top_rows(df.limit(0), "measure", ["key"]).count() == 0
