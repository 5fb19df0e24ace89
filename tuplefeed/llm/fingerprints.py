"""Exact duplicates by composable polynomial fingerprints and chunkwise comparison.

A text is read as the number that its UTF-8 bytes (plus one) write in base B, modulo several primes.
Such fingerprints compose: that of a text is the sum of those of its chunks, each shifted by B to the
number of bytes that follow. Chunks of huge texts are therefore hashed in tasks of their own and
summed like any other aggregate. Texts of equal length and fingerprint are then compared chunk by
chunk with the first of their group, and those that differ form the next group, until none differs.

Texts are equal when identical after each run of white space becomes one space; a null text counts as
empty. A null id sorts behind all others, and a group of null ids only has a null ``keep_id``. Of rows
that share id and text, exactly one stays. Other columns are not looked at. When texts are read again
for the comparison, rows are found by id and a hash of the raw text, and told apart by id and SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm.common import NO_ID, prepared, settled
from tuplefeed.llm.skew import join_counted

#: The largest primes below 2^31, and a base larger than any digit.
MODULI = (2147483647, 2147483629, 2147483587)
BASE = 1_000_003
CHUNK_BYTES = 1 << 20
#: Members of a group that meet one copy of its first text.
PER_COPY = 256

#: Bytes of pieces that a task hands on at once.
BATCH_BYTES = 1 << 23
PIECE = ["sha", "n_bytes", "chunk", "after", "piece"]
PIECE_SCHEMA = "sha string, n_bytes long, chunk long, after long, piece binary"
GROUP = ["n_bytes", "print_a", "print_b", "differing"]


def squeezed(data: bytes, chunk_bytes: int) -> list[bytes]:
    """The text with each run of white space as one space, in pieces of ``chunk_bytes``; the last is shorter.

    Works through slices, so that a huge text needs no list of all its words.
    """
    out, held, after_space = [], b"", False
    for start in range(0, len(data), chunk_bytes):
        part = data[start : start + chunk_bytes]
        spaced = b" " * (part[:1].isspace() and not after_space) + b" ".join(part.split())
        after_space = part[-1:].isspace()
        held += spaced + b" " * (after_space and not part.isspace())
        while len(held) >= chunk_bytes:
            out.append(held[:chunk_bytes])
            held = held[chunk_bytes:]
    return [*out, held] if held or not out else out


def cut(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Replace ``text`` by a row per piece: SHA-256 and size of the whole, number, bytes behind it, piece."""
    for batch in batches:
        kept = [n for n in batch.schema.names if n != "text"]
        made, held = [], 0
        for row, cell in enumerate(batch.column("text")):
            pieces = squeezed(cell.as_py(), chunk_bytes)
            sha, size, after = hashlib.sha256(b"".join(pieces)).hexdigest(), sum(map(len, pieces)), 0
            for number in range(len(pieces) - 1, -1, -1):
                made.append((row, sha, size, number, after, pieces[number]))
                after += len(pieces[number])
            held += size
            if held > BATCH_BYTES:
                yield _pieces(batch, kept, made)
                made, held = [], 0
        if made:
            yield _pieces(batch, kept, made)


def _pieces(batch: pa.RecordBatch, kept: list[str], made: list[tuple]) -> pa.RecordBatch:
    rows, *rest = zip(*made, strict=True)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = {n: batch.column(n).take(pa.array(rows)) for n in kept}
    made_columns = {n: pa.array(v, k) for n, v, k in zip(PIECE, rest, kinds, strict=True)}
    return pa.RecordBatch.from_pydict(columns | made_columns)


def _cut(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(lambda b: cut(b, chunk_bytes), f"{kept}, {PIECE_SCHEMA}")


def powers(count: int, modulus: int) -> np.ndarray:
    """BASE to 0, 1, ..., count - 1, by doubling."""
    out, at = np.ones(max(count, 1), np.uint64), 1
    while at < count:
        more = min(at, count - at)
        out[at : at + more] = out[:more] * np.uint64(pow(BASE, at, modulus)) % np.uint64(modulus)
        at += more
    return out


def hashes(data: np.ndarray, ends: np.ndarray, modulus: int, table: np.ndarray) -> np.ndarray:
    """The fingerprint of each chunk of ``data``; ``ends`` are where chunks end, none above 2^24 bytes.

    A digit times a power is below 2^40, so the sum over a chunk fits 64 bits.
    """
    sizes = np.diff(ends, prepend=0)
    out = np.zeros(len(ends), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        exponent = np.repeat(ends, sizes) - 1 - np.arange(len(data))
        terms = table[exponent] * (data.astype(np.uint64) + np.uint64(1))
        out[full] = np.add.reduceat(terms, (ends - sizes)[full]) % np.uint64(modulus)
    return out


def shifted(batches: Iterator[pa.RecordBatch], moduli: tuple[int, ...], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Replace (after, piece) by the piece's fingerprints times BASE to the power of ``after``."""
    tables = [powers(chunk_bytes, m) for m in moduli]
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        after = columns.pop("after").to_pylist()
        piece = columns.pop("piece").cast(pa.large_binary())
        ends = np.frombuffer(piece.buffers()[1], np.int64)[piece.offset : piece.offset + len(piece) + 1]
        data = np.frombuffer(piece.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        for k, (modulus, table) in enumerate(zip(moduli, tables, strict=True)):
            found = hashes(data, ends[1:] - ends[0], modulus, table).tolist()
            shift = [h * pow(BASE, n, modulus) % modulus if n else h for h, n in zip(found, after, strict=True)]
            columns[f"hash{k}"] = pa.array(shift, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def _raw(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, raw, text): ``raw`` is a hash of the text as it stands."""
    given = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs[key].cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(given).alias("raw"), given.cast("binary").alias("text"))


def prints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    moduli: tuple[int, ...] = MODULI, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(row, id, raw, sha, n_bytes, print_a, print_b) per row of ``docs``; ``row`` is unique.

    Texts of one chunk are hashed where they are read. Chunks of longer texts are dealt to other
    tasks, and their shifted fingerprints are summed.
    """
    prepared(docs.sparkSession)
    of_row = ["row", "id", "raw", "sha", "n_bytes"]
    numbers = [f"hash{k}" for k in range(len(moduli))]
    schema = ", ".join(["row long", "id long", "raw long", "sha string", "n_bytes long", *(f"{n} long" for n in numbers)])
    raw, raw_bytes = _raw(docs, key, text), F.octet_length("text")
    place = F.monotonically_increasing_id() * 2

    def hashed(pieces: DataFrame) -> DataFrame:
        return pieces.select(*of_row, "after", "piece").mapInArrow(lambda b: shifted(b, moduli, chunk_bytes), schema)

    whole = hashed(_cut(raw.where(raw_bytes <= chunk_bytes).withColumn("row", place), chunk_bytes))
    parts = hashed(_cut(raw.where(raw_bytes > chunk_bytes).withColumn("row", place + 1), chunk_bytes).repartition("row", "chunk"))
    summed = parts.groupBy(*of_row).agg(*[(F.sum(n) % m).alias(n) for n, m in zip(numbers, moduli, strict=True)])
    first, second, third = (F.col(n) for n in [*numbers, *numbers[:1] * 2][:3])
    return whole.unionByName(summed).select(
        *of_row, F.shiftleft(first, 31).bitwiseOR(second).alias("print_a"), third.alias("print_b")
    )


def _groups(rows: DataFrame) -> DataFrame:
    """Groups of more than one row: their size and the row that stays, the first by (id, row), null ids last."""
    first = F.min(F.struct((F.col("id") == NO_ID).alias("no_id"), "id", "row", "sha")).alias("first")
    found = rows.groupBy(*GROUP).agg(F.count("*").alias("group_size"), first).where("group_size > 1")
    return found.select(
        *GROUP, "group_size", F.col("first.id").alias("keep"), F.col("first.row").alias("keep_row"),
        F.col("first.sha").alias("keep_sha"),
    )


def _differing(raw: DataFrame, members: DataFrame, chunk_bytes: int) -> DataFrame:
    """(id, sha) of the texts that differ in some chunk from the first text of their group.

    Texts of groups are written once. A large group meets several copies of its first text, each of
    which a bounded number of members is dealt to; the sorted join streams both sides and holds one
    chunk of the first text.
    """
    is_first = (F.col("id") == F.col("keep")) & (F.col("sha") == F.col("keep_sha"))
    copies = F.call_function("div", F.col("group_size") + (PER_COPY - 1), F.lit(PER_COPY))
    known = members.select("id", "raw", F.col("sha").alias("known_sha"), *GROUP[1:], copies.alias("copies"), is_first.alias("is_first"))
    known = settled(known.distinct(), "fingerprint-members")
    pieces = settled(_cut(raw.join(known, ["id", "raw"]), chunk_bytes), "fingerprint-pieces").where("sha = known_sha")
    at = [*GROUP, "chunk", "copy"]
    firsts = pieces.where("is_first").dropDuplicates([*GROUP, "chunk"])
    copied = firsts.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    others = pieces.where("not is_first").withColumn("copy", F.pmod(F.xxhash64("id"), F.col("copies")))
    pairs = others.join(copied.select(*at, F.col("piece").alias("first_piece")).hint("merge"), at)
    return pairs.where("piece <> first_piece").select("id", "sha").distinct()


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    moduli: tuple[int, ...] = MODULI, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row: the id, ``keep_id`` (id of the row that stays), ``group_size``, ``kept`` and ``text_sha256``.

    ``moduli`` are up to three primes below 2^31; fewer or smaller ones only cost more rounds of comparison.
    """
    rows = prints(docs, key, text, moduli=moduli, chunk_bytes=chunk_bytes)
    rows = settled(rows.withColumn("differing", F.lit(0)), "fingerprints")
    raw = _raw(docs, key, text)
    compared = 0
    while True:
        groups = settled(_groups(rows), "fingerprint-groups")
        unproven = groups.where(F.col("differing") == compared)
        members = join_counted(rows.where(F.col("differing") == compared), unproven, GROUP, "group_size")
        differing = settled(_differing(raw, members, chunk_bytes), "fingerprint-differences")
        if differing.isEmpty():
            break
        moved = rows.join(differing.withColumn("moved", F.lit(1)), ["id", "sha"], "left")
        compared += 1
        rows = settled(
            moved.withColumn("differing", F.col("differing") + F.coalesce("moved", F.lit(0))).select(*rows.columns), "fingerprints"
        )
    found = join_counted(rows, groups, GROUP, "group_size", "left")
    shown = F.coalesce("keep", F.col("id"))
    return found.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(key),
        F.when(shown != NO_ID, shown).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


#: The same result as SQL.
ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (
    SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
        row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept
    FROM t)
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM g
"""
