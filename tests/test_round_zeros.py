import math

from pyspark.sql import functions as F

from tidepost.functions import vectors as V


def test_zeros_are_not_rounded_through_decimals(spark):
    df = spark.createDataFrame([([0.0, -0.0, 0.5000005, 0.5000015, -1e-9, None],), (None,)], "v array<double>")
    rounded = V.round_vector(F.col("v"))
    rows = [r[0] for r in df.select(rounded).collect()]
    assert rows == [[0.0, 0.0, 0.5, 0.500002, 0.0, None], None]
    assert math.copysign(1, rows[0][1]) == 1
    assert df.select(V.round_vector(F.col("v").cast("array<float>")).alias("r")).schema["r"].dataType.simpleString() == "array<float>"
    assert "CASE WHEN" in rounded._jc.toString().upper()
