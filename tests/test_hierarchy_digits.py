from quern.operators import hierarchy as hi


def test_digit_sum_is_null_when_a_leaf_does_not_fit(spark):
    def total(leaf):
        rows = [(1, None, 0, 1, "1", None), (2, 1, 1, 2, "12", "L"), (3, 1, 1, 3, leaf, "R")]
        df = spark.createDataFrame(rows, "id long, parent long, level int, val long, digits string, side string")
        return hi.tree_summary(df).first().digit_sum
    assert total("13") == 25
    assert total("1" * 39) is None
