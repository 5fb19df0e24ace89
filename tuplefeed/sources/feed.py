"""Reading a change feed: rows of (seq, wire), or pages of changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.operators.ordering import block_of, dense_position, prefix_sums

FEED_SCHEMA = "seq BIGINT, wire STRING"
PAGES_SCHEMA = "page_no BIGINT, body STRING"
START = ""  # the token of the start of a feed


def read_feed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(FEED_SCHEMA).format(fmt).load(path)


def stream_feed(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(FEED_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(PAGES_SCHEMA).format(fmt).load(path)


def read_page_files(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None
) -> DataFrame:
    """Pages saved as one JSON file each, numbered by the last digits in the file name, such as
    ``2024-page-000123.json``. A file without a number is an error, and so are two files with one
    number, since their changes would share positions; streams see to that in ``streams.sync``."""
    reader = (spark.readStream if stream else spark.read).option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("bigint")
    missing = F.raise_error(F.concat(F.lit("no page number in file name "), name))
    pages = reader.format("text").load(path)
    if not stream:
        names = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"))
        numbers = names.select(F.regexp_extract("name", r"(\d+)\D*$", 1).try_cast("bigint").alias("n"))
        twice = numbers.where("n IS NOT NULL").groupBy("n").count().where("count > 1").first()
        if twice:
            raise ValueError(f"{twice['count']} files of {path} have the page number {twice['n']}")
    return pages.select(
        F.coalesce(number, missing.cast("bigint")).alias("page_no"), F.col("value").alias("body")
    )


def _document(text: Column) -> Column:
    """The text as first element of a VARIANT array, its hash as second.

    The JSON parser stops after the first value; the hash is missing or moved when more text
    follows, as in two changes on one line.
    """
    return F.try_parse_json(
        F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text), F.lit("]"))
    )


def _is_object(text: Column, document: Column) -> Column:
    """Whether the whole text is one JSON object."""
    complete = F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(text)
    return F.coalesce(complete & text.rlike(r"^[ \t\r\n]*\{"), F.lit(False))


def _content(document: Column) -> Column:
    return F.try_variant_get(document, "$[0]", "variant")


def decode(feed: DataFrame) -> DataFrame:
    """Replace ``wire`` by the VARIANT ``change``; drop what is no JSON object.

    The explode keeps later filters on parsed fields above this step: pushed below it, they
    would each parse the JSON text once more.
    """
    keep = [c for c in feed.columns if c != "wire"]
    wire, document = F.col("wire"), F.col("document")
    parsed = feed.withColumn("document", _document(wire))
    good = F.when(_is_object(wire, document), F.array(_content(document)))
    return parsed.select(*keep, F.explode(good).alias("change"))


def rejects(rows: DataFrame, text: str = "wire") -> DataFrame:
    """The rows ``decode`` (or, with ``text="body"``, ``decode_pages``) drops, for quarantine."""
    column = F.col(text)
    return rows.where(~_is_object(column, _document(column)))


def decode_pages(pages: DataFrame, page_rows: int = 1000) -> DataFrame:
    """One row per change of each page: (seq, page_no, pos, change), and other page columns.

    ``page_rows`` is at least the size of the largest page; a longer one is an error, since
    its positions would run into those of the next page.
    """
    keep = [c for c in pages.columns if c not in ("page_no", "body")]
    body, page = F.col("body"), F.col("page")
    parsed = pages.withColumn("page", _document(body))
    changes = F.when(
        _is_object(body, page), F.try_variant_get(page, "$[0].changes", "array<variant>")
    )
    items = parsed.select("page_no", *keep, F.posexplode(changes).alias("pos", "change")).where(F.schema_of_variant("change").startswith("OBJECT<"))
    pos = F.when(F.col("pos") < page_rows, F.col("pos").cast("bigint")).otherwise(
        F.raise_error(F.lit(f"a page holds more than page_rows={page_rows} changes"))
    )
    return items.select(
        (F.col("page_no") * page_rows + pos).alias("seq"),
        "page_no",
        pos.alias("pos"),
        *keep,
        "change",
    )


def page_item_rejects(pages: DataFrame) -> DataFrame:
    """What ``decode_pages`` drops of readable pages, for quarantine: (page_no, pos, item).

    Items that are no JSON objects, and with ``pos`` NULL the ``changes`` of a page whose list is
    none. Pages that are no JSON object themselves are those of ``rejects(pages, "body")``.
    """
    body, page = F.col("body"), F.col("page")
    parsed = pages.withColumn("page", _document(body)).where(_is_object(body, page))
    changes = F.try_variant_get("page", "$[0].changes", "variant")
    listed = parsed.withColumn("changes", changes).where("changes IS NOT NULL")
    is_list = F.schema_of_variant("changes").startswith("ARRAY<")
    items = listed.where(is_list).select(
        "page_no", F.posexplode(F.try_variant_get("changes", "$", "array<variant>")).alias("pos", "change")
    )
    bad = items.where(~F.coalesce(F.schema_of_variant("change").startswith("OBJECT<"), F.lit(False)))
    whole = listed.where(~is_list & ~F.is_variant_null("changes"))
    return bad.select("page_no", F.col("pos").cast("bigint").alias("pos"), F.to_json("change").alias("item")).unionByName(
        whole.select("page_no", F.lit(None).cast("bigint").alias("pos"), F.to_json("changes").alias("item"))
    )


def page_tokens(pages: DataFrame) -> DataFrame:
    """(page_no, next_token, has_more); no or an empty token ends the feed.

    A page whose body is no JSON object has no row: it must be fetched again.
    """
    body, page = F.col("body"), F.col("page")
    parsed = pages.select("page_no", "body", _document(body).alias("page"))
    token = F.coalesce(F.try_variant_get(page, "$[0].continuation_token", "string"), F.lit(""))
    return parsed.where(_is_object(body, page)).select(
        "page_no", token.alias("next_token"), (token != "").alias("has_more")
    )


def resume(feed: DataFrame, token: str | Column = START) -> DataFrame:
    """Everything after a token; the empty token is the start. Reaches the scan as a filter."""
    if isinstance(token, str):
        return feed if token == START else feed.where(F.col("seq") > int(token))
    bad = F.raise_error(F.concat(F.lit("no feed token: "), token)).cast("bigint")
    number = F.when(token == START, F.lit(None)).otherwise(F.coalesce(token.try_cast("bigint"), bad))
    return feed.where(number.isNull() | (F.col("seq") > number))


def read_page(feed: DataFrame, token: str | Column, page_size: int) -> DataFrame:
    """The next ``page_size`` feed rows after a token, in feed order."""
    return resume(feed, token).orderBy("seq").limit(page_size)


def paginate(feed: DataFrame, page_size: int) -> DataFrame:
    """Add ``page_no`` and ``pos``: the pages a reader gets who follows tokens to the end."""
    placed = dense_position(feed, "seq", "place")
    return placed.select(
        *feed.columns,
        block_of(F.col("place"), page_size).alias("page_no"),
        (F.col("place") % page_size).alias("pos"),
    )


def page_summary(feed: DataFrame, page_size: int) -> DataFrame:
    """One row per page: parsed changes, the token to go on with, and if there is more."""
    wire = F.col("wire")
    good = _is_object(wire, _document(wire))
    paged = paginate(feed.select("seq", good.alias("good")), page_size)
    last_page = feed.agg(block_of(F.count("*") - 1, page_size)).scalar()
    per_page = paged.groupBy("page_no").agg(
        F.count("*").alias("total_fetched"), F.count_if("good").alias("processed"), F.max("seq").alias("last_seq")
    )
    has_more = F.col("page_no") < last_page
    return per_page.select(
        "page_no",
        "total_fetched",
        "processed",
        F.when(has_more, F.col("last_seq").cast("string")).otherwise("").alias("next_token"),
        has_more.alias("has_more"),
    )


def fetch_all(events: DataFrame, max_changes: int | Column = 0) -> DataFrame:
    """All events of the pages a capped reader fetches; 0 means no cap.

    The reader looks at the cap before each page, so it takes every page for which the pages
    before hold fewer than ``max_changes`` events, and may get up to one page more than that.
    ``events`` need ``page_no``.
    """
    if not isinstance(max_changes, Column) and max_changes <= 0:
        return events
    counts = events.groupBy("page_no").agg(F.count("*").alias("n"))
    before = prefix_sums(counts, "page_no", "n")
    cap = max_changes if isinstance(max_changes, Column) else F.lit(max_changes)
    taken = F.when((cap <= 0) | (F.col("before") < cap), F.col("page_no"))
    last_page = before.agg(F.max(taken)).scalar()
    return events.where(F.col("page_no") <= last_page)


def changes_since(
    events: DataFrame, since: datetime | Column, max_changes: int | Column = 0
) -> DataFrame:
    """Events at or after a time. The cap counts from the start of the feed, before the filter."""
    bound = since if isinstance(since, Column) else F.lit(since)
    return fetch_all(events, max_changes).where(F.col("ts") >= bound)
