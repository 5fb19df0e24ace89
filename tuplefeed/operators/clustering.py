"""An audit table whose files hold neighbours in several columns at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.operators.changelog import CHANGELOG_SCHEMA, by_date
from tuplefeed.operators.ordering import block_of, dense_position

CLUSTERED_BY = ("object_type", "relation", "user_type", "event_date")
LOOKED_UP = ("object_id", "user_id")
BITS = 8  # of a column's place on the curve


def curve(places: list[Column], bits: int = BITS) -> Column:
    """The place on the Z-order curve: the bits of all columns, the highest of each first."""
    n = len(places)
    taken = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * n + n - 1 - k)
        for bit in range(bits)
        for k, place in enumerate(places)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def _placed(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """Add ``_place_<name>``: the rank of the value among the column's values, scaled to ``bits``.

    The values are ranked in parallel, however many there are; NULL has place 0.
    """
    values = rows.groupBy(name).agg(F.count(F.lit(1)).alias("_rows")).where(F.col(name).isNotNull()).select(name)
    ranked = dense_position(values, name, "_rank")
    number = ranked.agg(F.max("_rank") + 1).scalar()
    place = block_of(F.col("_rank") * (1 << bits), number)
    ranks = ranked.select(F.col(name), place.alias(f"_place_{name}"))
    return rows.join(ranks, name, "left").fillna(0, [f"_place_{name}"])


def write_clustered(
    rows: DataFrame, path: str, columns: tuple[str, ...] = CLUSTERED_BY, bits: int = BITS, **options: str
) -> None:
    """Write changelog rows along a space-filling curve over ``columns``, with Bloom filters on ids.

    A filter on any of the columns, not only the first, skips most row groups by their smallest and
    largest values; a filter on an id skips those whose Bloom filter lacks it. Rows at one place of
    the curve are told apart by ``id``, so a hot combination of values is cut into many files.
    ``options`` go to the Parquet writer.
    """
    placed = by_date(rows)
    names = placed.columns
    for name in columns:
        placed = _placed(placed, name, bits)
    along = placed.withColumn("_curve", curve([F.col(f"_place_{name}") for name in columns], bits))
    ordered = along.repartitionByRange("_curve", "id").sortWithinPartitions("_curve", "id")
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in LOOKED_UP}
    adaptive = {"parquet.bloom.filter.adaptive.enabled": "true"}
    ordered.select(names).write.mode("overwrite").options(**blooms, **adaptive, **options).parquet(path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """The table for ``changelog.audit``, which then filters ``event_date`` along with times."""
    return spark.read.schema(f"{CHANGELOG_SCHEMA}, event_date DATE").parquet(path)
