"""Where the logs of the tests are, and lines as a DataFrame."""

import os

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
