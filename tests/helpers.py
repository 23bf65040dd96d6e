"""What several test files use."""

SF_SMALL = "/root/testdata/sf0.001"


def lines(spark, *texts):
    """A line frame (``value STRING``) from literal lines, in order."""
    return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
