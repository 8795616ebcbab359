"""Small helpers shared by the tests."""

from collections import Counter

from vitrine import schemas


def rows(df):
    return [tuple(r) for r in df.collect()]


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def listing(**values):
    """One raw listing; columns not given are NULL."""
    return tuple(values.get(name) for name in schemas.LISTING.names)


def listings(spark, *items):
    return spark.createDataFrame([listing(**i) for i in items], schemas.LISTING)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
