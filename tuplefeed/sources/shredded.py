"""A feed landed once as shredded VARIANT, so that later reads parse no text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tuplefeed.sources.feed import decode

# What Parquet writing and reading of VARIANT needs; the columns are found from the first rows of a file.
WRITE_SETTINGS = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
}
READ_SETTINGS = {
    "spark.sql.variant.allowReadingShredded": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def land_shredded(feed: DataFrame, path: str, mode: str = "error") -> None:
    """Decode a feed of (seq, wire) and write (seq, change), common members as columns of their own.

    Rows that are no JSON object are left out, as in ``decode``; ``rejects`` lists them. Members of
    another type than most, or that few changes have, stay in the remaining VARIANT value, so every
    change can be read back whole.
    """
    conf = feed.sparkSession.conf
    before = {key: conf.get(key, None) for key in WRITE_SETTINGS}
    try:
        for key, value in WRITE_SETTINGS.items():
            conf.set(key, value)
        decode(feed).write.mode(mode).parquet(path)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def read_shredded(spark: SparkSession, path: str) -> DataFrame:
    """The changes (seq, change), for ``parse_changes``. The scan reads only members that are asked
    for; asking for the whole change, as ``raw_json`` does, reads all of them."""
    for key, value in READ_SETTINGS.items():
        spark.conf.set(key, value)
    return spark.read.schema("seq BIGINT, change VARIANT").parquet(path)
