from shopmarts.plans import marts


def test_installment_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 3, 6, 12, 13)], "n int")
    got = [r[0] for r in df.select(marts.installment_bucket("n")).collect()]
    assert got == ["2_to_3", "1_single", "2_to_3", "4_to_6", "7_to_12", "13_plus"]  # T13: 0 -> 2_to_3


def test_delay_buckets_null_falls_to_last(spark):
    df = spark.createDataFrame([(d,) for d in (-7, -1, 0, 3, 7, 8, None)], "d int")
    got = [r[0][0] for r in df.select(marts.delay_bucket("d")).collect()]
    assert got == ["1", "2", "3", "4", "5", "6", "6"]  # T12
