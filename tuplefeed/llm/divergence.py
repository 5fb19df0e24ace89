"""How the sources of a language differ in their words: single-pass in-memory indexing and pair corrections.

Tasks index their documents in one pass: postings of (language, term) grow in memory until it is full,
and are then spilled as a run sorted by term, cut by a hash of the term into shards. One task per shard
merges its runs with a heap into document frequencies and counts per source, and keeps the terms of
enough documents. The number of shards grows with the bytes of text, so a shard's runs stay bounded.

With smoothed shares p of kept terms, the distance of sources a and b is the sum of |p_a - p_b|. Where a
source lacks a term its share is a constant z, so the sum over all V terms is
``V |z_a - z_b| + A(a, b) + A(b, a) + C(a, b)``: A corrects for the terms that one source has, and comes
from a histogram of its counts; C corrects once more for the terms that both have, and is added up while
postings stream through tasks, in blocks of sources of bounded size. No term's pairs become rows.

Null texts, languages and sources count as empty texts. A group without terms, and a language without
kept terms, has pairs of its shares z, or of distance 0 where there are no terms at all. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.llm.common import LOWERED, prepared, settled
from tuplefeed.llm.skew import join_counted

# Bytes of terms: letters, lower-cased, and all bytes of characters beyond ASCII; others part terms.
NO_TERM = re.compile(rb"[^A-Za-z\x80-\xff]")
IN_TERMS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in LOWERED)
LEAST_DOCS = 30
RANKS = 50
UNIT, PRIOR = 1_000_000_000, 5

#: Postings that a task holds before it spills them, and bytes of text that a shard stands for.
HELD = 2_000_000
SHARD_BYTES = 64 << 20
#: Bytes of a long text that are split into words at once.
SLICE_BYTES = 1 << 20
#: Sources in a block of pair corrections, and blocks of sums that a task holds.
BLOCK, BLOCKS = 256, 128

MERGED = "lang string, term string, total long, sources array<string>, counts array<long>"
KEPT = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("total", pa.int64()),
    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists, each of a slice that ends where no term does."""
    start = 0
    while start < len(text):
        cut = NO_TERM.search(text, start + SLICE_BYTES)
        end = cut.start() if cut else len(text)
        yield text[start:end].translate(IN_TERMS).split()
        start = end


def _summed(keys: np.ndarray, *numbers: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], *(np.add.reduceat(n[order], starts) if len(starts) else n for n in numbers)


class Memory:
    """Postings of one language: terms have numbers by arrival, a posting is term number and source."""

    def __init__(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.sources: defaultdict[bytes, int] = defaultdict()
        self.sources.default_factory = self.sources.__len__
        none = np.zeros(0, np.int64)
        self.postings, self.waiting, self.n_waiting = (none, none, none), [], 0

    def add(self, source: bytes, text: bytes) -> int:
        """Take a text in; returns how many postings it adds at most."""
        found = []
        for words in terms(text):
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            found.append(np.unique(ids, return_counts=True))
        if not any(len(ids) for ids, _ in found):
            return 0
        ids, counts = found[0] if len(found) == 1 else _summed(*map(np.concatenate, zip(*found, strict=True)))
        self.waiting.append((ids << 32 | self.sources[source], counts, np.ones(len(ids), np.int64)))
        self.n_waiting += len(ids)
        return len(ids)

    def settle(self) -> int:
        """Sum what waits into the postings, and return their number."""
        if self.waiting:
            self.postings = _summed(*map(np.concatenate, zip(self.postings, *self.waiting, strict=True)))
            self.waiting, self.n_waiting = [], 0
        return len(self.postings[0])

    def runs(self, lang: bytes, shards: int) -> Iterator[tuple[int, bytes]]:
        """The postings as one run per shard, an Arrow stream sorted by term."""
        self.settle()
        words = list(self.ids)
        ranks = np.empty(len(words), np.int64)
        ranks[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        seed = zlib.crc32(lang)
        shard = np.fromiter((zlib.crc32(w, seed) % shards for w in words), np.int64, len(words))
        names, (keys, counts, docs) = list(self.sources), self.postings
        of = keys >> 32
        order = np.lexsort((keys & 0xFFFFFFFF, ranks[of], shard[of]))
        for rows in np.split(order, np.flatnonzero(np.diff(shard[of][order])) + 1) if len(order) else []:
            numbers = of[rows]
            starts = np.flatnonzero(np.diff(numbers, prepend=-1))
            used, place = np.unique(keys[rows] & 0xFFFFFFFF, return_inverse=True)
            sources = pa.DictionaryArray.from_arrays(pa.array(place, pa.int32()), pa.array([names[k] for k in used], pa.binary()))
            ends = pa.array(np.append(starts, len(rows)), pa.int32())
            run = pa.table({
                "term": pa.array([words[k] for k in numbers[starts]], pa.binary()),
                "docs": np.add.reduceat(docs[rows], starts),
                "sources": pa.ListArray.from_arrays(ends, sources),
                "counts": pa.ListArray.from_arrays(ends, pa.array(counts[rows])),
            })
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, run.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(run, max_chunksize=5000)
            yield int(shard[numbers[0]]), sink.getvalue().to_pybytes()


def indexed(batches: Iterator[pa.RecordBatch], shards: int, held: int) -> Iterator[pa.RecordBatch]:
    """Index (lang, source, text) rows in memory, and spill whenever ``held`` postings are there."""
    memory: defaultdict[bytes, Memory] = defaultdict(Memory)
    waiting = 0
    for batch in batches:
        for lang, source, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            waiting += memory[lang].add(source, cell.as_py())
            if waiting >= held // 2 + 1:
                waiting = 0
                if sum(m.settle() for m in memory.values()) >= held:
                    yield from spilled(memory, shards)
                    memory.clear()
    yield from spilled(memory, shards)


def spilled(memory: dict[bytes, Memory], shards: int) -> Iterator[pa.RecordBatch]:
    for lang, postings in memory.items():
        for shard, run in postings.runs(lang, shards):
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "lang": [lang.decode(errors="replace")], "run": [run]})


def entries(number: int, run: bytes) -> Iterator[tuple]:
    """(term, number of the run, place, documents, postings) in order; the first three tell entries apart."""
    for batch in pa.ipc.open_stream(run):
        words, docs, sources, counts = batch.columns
        postings = (
            sources.offsets.to_numpy(), sources.values.indices.to_numpy(), sources.values.dictionary.to_pylist(), counts.values.to_numpy(),
        )
        for place, (term, n_docs) in enumerate(zip(words.to_pylist(), docs.to_pylist(), strict=True)):
            yield term, number, place, n_docs, postings


def merged(runs: list[bytes], least_docs: int) -> Iterator[tuple]:
    """(term, total, sources, counts) of the terms of enough documents, by heap over sorted runs."""
    for term, same in groupby(heapq.merge(*(entries(k, r) for k, r in enumerate(runs))), key=lambda e: e[0]):
        found = list(same)
        if sum(e[3] for e in found) < least_docs:
            continue
        summed = Counter()
        for _, _, place, _, (ends, sources, names, counts) in found:
            part = slice(ends[place], ends[place + 1])
            for source, count in zip(sources[part].tolist(), counts[part].tolist(), strict=True):
                summed[names[source]] += count
        yield term.decode(errors="replace"), summed.total(), [n.decode(errors="replace") for n in summed], list(summed.values())


def _merge(key: tuple, shard: pa.Table, least_docs: int) -> pa.Table:
    rows = [(key[1].as_py(), *row) for row in merged(shard.column("run").to_pylist(), least_docs)]
    columns = list(zip(*rows, strict=True)) or [[] for _ in KEPT]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, KEPT.types, strict=True)], schema=KEPT)


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum, over streamed terms, what C(a, b) gains from each; places a < b within a language.

    Terms of a batch stand as rows of a matrix with a column per source of a block; where a source
    lacks a term its share is its constant, and the gain is zero.
    """
    sums: dict[tuple[str, int, int], np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        of_row = np.repeat(np.arange(len(langs)), np.diff(batch.column(1).offsets.to_numpy()))
        at, p, z = (c.flatten().to_numpy() for c in batch.columns[1:])
        for lang in set(langs):
            mine = langs[of_row] == lang
            _, rows = np.unique(of_row[mine], return_inverse=True)
            blocks = _matrices(rows, at[mine], p[mine], z[mine])
            for a in blocks:
                for b in blocks:
                    if a > b:
                        continue
                    if (lang, a, b) not in sums:
                        if len(sums) >= BLOCKS:
                            yield from _block_sums(sums)
                            sums = {}
                        sums[lang, a, b] = np.zeros((BLOCK, BLOCK), np.int64)
                    _gain(sums[lang, a, b], *blocks[a], *blocks[b])
    yield from _block_sums(sums)


def _matrices(rows: np.ndarray, at: np.ndarray, p: np.ndarray, z: np.ndarray) -> dict[int, tuple]:
    """Per block of sources: its columns that occur, their constants, and the shares by term."""
    out, height = {}, rows.max(initial=-1) + 1
    for block in np.unique(at // BLOCK).tolist():
        here = at // BLOCK == block
        columns, first, place = np.unique(at[here] % BLOCK, return_index=True, return_inverse=True)
        without = z[here][first]
        shares = np.tile(without, (height, 1))
        shares[rows[here], place] = p[here]
        out[block] = columns, without, shares
    return out


def _gain(sums: np.ndarray, a: np.ndarray, z_a: np.ndarray, p_a: np.ndarray, b: np.ndarray, z_b: np.ndarray, p_b: np.ndarray) -> None:
    alone = np.stack([abs(p_a - z).sum(0) for z in z_b], 1)
    for k, (column, z) in enumerate(zip(a.tolist(), z_a, strict=True)):
        share = p_a[:, k, None]
        sums[column, b] += abs(share - p_b).sum(0) - alone[k] - abs(z - p_b).sum(0) + len(p_b) * abs(z - z_b)


def _block_sums(sums: dict[tuple[str, int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (lang, first, second), block in sums.items():
        a, b = np.nonzero(np.triu(block, 1) if first == second else block)
        columns = [pa.array([lang] * len(a), pa.string()), pa.array(a + first * BLOCK), pa.array(b + second * BLOCK), pa.array(block[a, b])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])


def share(count: Column, tokens: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + PRIOR) / (tokens + PRIOR kept)), exact; null without kept terms."""
    wide = "decimal(20,0)"
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + PRIOR).cast(wide)
    below = (tokens + kept * PRIOR).cast(wide)
    return F.when(kept > 0, F.call_function("div", above, below) + 1)


def index(docs: DataFrame, least_docs: int = LEAST_DOCS, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """(groups, terms): each (lang, source), and the kept terms with their counts per source."""
    prepared(docs.sparkSession)
    given = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    size = F.sum(F.octet_length("text").cast("long")).alias("bytes")
    groups = settled(given.groupBy("lang", "source").agg(size), "divergence-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    shards = max(-(-total // SHARD_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    raw = given.select(*(F.col(c).cast("binary").alias(c) for c in given.columns))
    runs = raw.mapInArrow(lambda b: indexed(b, shards, held), "shard int, lang string, run binary")
    kept = runs.groupBy("shard", "lang").applyInArrow(lambda k, t: _merge(k, t, least_docs), MERGED)
    return groups.drop("bytes"), settled(kept, "divergence-terms")


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, ranks: int = RANKS, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources of the language, all of
    them, as part ``pair``; terms that the source uses more than its language does, ``ranks`` of them, as
    part ``term``. Largest value first, equal ones by item in bytes."""
    groups, kept = index(docs, least_docs, held)
    postings = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("_at")).select(
        "lang", "term", "total", F.col("_at.sources").alias("source"), F.col("_at.counts").alias("count")
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("total").alias("lang_tokens"))
    held_by = postings.groupBy("lang", "source").agg(F.sum("count").alias("tokens"), F.count("*").alias("n_terms"))
    zero, known = F.lit(0).cast("long"), groups.join(held_by, ["lang", "source"], "left").join(langs, "lang", "left")
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place")
    stats = known.na.fill(0, ["tokens", "n_terms", "n_kept", "lang_tokens"]).select("*", place)
    stats = settled(stats.withColumn("without", share(zero, F.col("tokens"), F.col("n_kept"))), "divergence-stats")
    found = join_counted(postings, stats.where("n_terms > 0"), ["lang", "source"], "n_terms")
    shares = settled(
        found.select(
            "lang", "source", "term", "place", "without",
            share(F.col("count"), F.col("tokens"), F.col("n_kept")).alias("p"),
            share(F.col("total"), F.col("lang_tokens"), F.col("n_kept")).alias("q"),
        ),
        "divergence-shares",
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    top = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    return _pairs(stats, shares).withColumn("rank", F.row_number().over(best)).unionByName(top)


def _pairs(stats: DataFrame, shares: DataFrame) -> DataFrame:
    by_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p", "without")).alias("_of"))
    streamed = by_term.select("lang", F.col("_of.place").cast("array<bigint>").alias("places"), F.col("_of.p").alias("shares"), F.col("_of.without").alias("without"))
    both = streamed.mapInArrow(corrections, "lang string, a long, b long, value long")
    both = both.groupBy("lang", "a", "b").agg(F.sum("value").alias("both"))
    same_share = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    shapes = same_share.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("shape"))
    one = stats.join(shapes, ["lang", "source"], "left").select(
        "lang", "source", "place", "n_kept", F.coalesce("without", F.lit(0).cast("long")).alias("z"),
        F.coalesce("shape", F.array().cast("array<struct<p:bigint,n:bigint>>")).alias("shape"),
    )
    # A language's pairs are dealt to one task for each BLOCK of its sources.
    tasks = F.call_function("div", F.count("*").over(Window.partitionBy("lang")) - 1, F.lit(BLOCK))
    dealt = settled(one.withColumn("tasks", tasks), "divergence-shapes")
    a = dealt.select("lang", *(F.col(c).alias(f"{c}_a") for c in ("source", "place", "z", "shape")), "n_kept", F.call_function("div", F.col("place"), F.lit(BLOCK)).alias("task"))
    b = dealt.select("lang", *(F.col(c).alias(f"{c}_b") for c in ("source", "place", "z", "shape")), F.explode(F.sequence(F.lit(0).cast("long"), "tasks")).alias("task"))

    def only(shape: str, other: str) -> Column:
        gap = F.abs(F.col("z_a") - F.col("z_b"))
        return F.aggregate(shape, F.lit(0).cast("long"), lambda acc, x: acc + x["n"] * (F.abs(x["p"] - F.col(other)) - gap))

    apart = F.col("n_kept") * F.abs(F.col("z_a") - F.col("z_b")) + only("shape_a", "z_b") + only("shape_b", "z_a")
    met = a.join(b, ["lang", "task"]).where("place_a < place_b")
    summed = met.select("lang", "source_a", "source_b", F.col("place_a").cast("long").alias("a"), F.col("place_b").cast("long").alias("b"), apart.alias("apart"))
    whole = summed.join(both, ["lang", "a", "b"], "left").withColumn("value", F.col("apart") + F.coalesce("both", F.lit(0).cast("long")))
    ends = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    return whole.select("lang", "value", ends.alias("end")).select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value")


#: The same result as SQL, over all terms and sources without corrections.
ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
words AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.n, 0) + 5 * l.v) AS p,
        1 + 1000000000::HUGEINT * (k.total + 5) // (l.n + 5 * l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""
