"""Single-partition forms that the distributed ranking is held against."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import ranking


def plain_ntile(df, k, order, out_col="ntile"):
    return df.withColumn(out_col, F.ntile(k).over(Window.orderBy(*ranking.sort_columns(order))))
