"""N-gram Jaccard join by blocked products of the document by n-gram incidence matrix.

Documents are sets of n-gram hashes. Equal sets are one class from the start. Blocks, where few
n-grams of linked sets may differ (``binned``): n-grams fall into more bins than may differ, so linked
sets have the same n-grams in some bin, and unrelated ones hardly ever, however large the corpus is.
N-grams that many sets hold are left out of the bins. Else: in any order of n-grams that all
documents share, two linked sets of sizes a and b have one of their first
a - ceil(t * a) + 1 and b - ceil(t * b) + 1 n-grams in common (t the wanted similarity). The order
used puts rare ones first, so that passages which many documents share come last. How rare n-grams are
is estimated by a table of ``1 << BITS`` counters, whatever the size of the corpus. Estimates
only decide the order or what is left out, never a link. Classes that meet in a bin or a first n-gram,
and whose sizes allow a link step by step, form candidate groups.

Groups that are too large for a task are taken apart by bins, of n-grams counted among their own sets.

Within a group, rows of the incidence matrix are multiplied with the others, overlaps are
accumulated, and pairs outside the size bounds or below the wanted overlap are discarded. The first
row's product links most of a group of copies; rows that it links are one component already, so
only the others need products of their own. Groups of more than ``block`` n-grams are split, and
every pair of splits is multiplied in its own task. What leaves a task is a spanning forest.

Hot groups: exact copies show their n-grams once in a task; near copies meet in runs of an n-gram's
sets, never pair by pair. Rounds are settled in the shared folder.

What is linked are sets, numbered once, never ids: different texts may share an id or have none.

Defined results: a null or empty text has no n-grams and is linked with nothing; with fewer words
than n, all of them are one n-gram; repeated rows are in one class; a null id is no smallest id, and
``component_id`` is null only where no linked row has one; an empty table gives no rows; texts are
taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tuplefeed.llm.common import LOWERED, NO_ID, map_texts, packed, settled, texts_of, unpacked
from tuplefeed.llm.components import connected

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """Sorted distinct n-gram hashes of texts; words' hashes are remembered, up to ``keep``."""

    def __init__(self, n: int, keep: int = 250_000) -> None:
        self.n, self.keep = n, keep

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.keep:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        words = text.encode().translate(LOWERED).split()
        h = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        n = self.n if len(h) >= self.n else len(h)
        if n == 0:
            return h
        total = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            total = mixed(total * _M3 + h[k : k + len(total)])
        return np.unique(total)


BITS = 22
#: N-grams of sets that one task multiplies.
BLOCK_GRAMS = 4_000_000


def counter_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def leading(grams: np.ndarray, counters: np.ndarray, percent: int) -> np.ndarray:
    """The n-grams of a set of which it shares one with every set that is linked to it."""
    first = len(grams) + 1 + -len(grams) * percent // 100  # less ceil(t * n)
    return grams[np.lexsort((grams, counters[counter_of(grams)]))[:first]]


def binned(percent: int) -> bool:
    """Whether bins hold enough n-grams, five at least, to tell unrelated sets apart."""
    return 100 + percent >= 17 * (100 - percent)


def common(counters: np.ndarray) -> np.ndarray:
    """Which counters stand out among what chance puts into each."""
    mean = float(counters.mean())
    return counters > mean + 6 * mean**0.5 + 8


def ranges_of(size: int, percent: int) -> Iterator[tuple[int, int]]:
    """(lower, upper) of the ranges of sizes, upper excluded, in which a set meets linked ones: its own
    and each higher one that holds sizes it may be linked with."""
    lower, upper = 1, 2
    while lower * percent <= size * 100:
        if size < upper:
            yield lower, upper
        lower, upper = upper, max(upper + 1, upper * 3 // 2)


#: In how many ways a set is dealt into bins before its bins count as empty.
DEALS = 4


def bins(grams: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set of which it shares one with every other set that is linked to it.

    Of linked sets of sizes a and b, at most (1 - t) / (1 + t) * (a + b) n-grams are in one only, and
    each spoils one bin. So of the first bins that hold n-grams of a set, one more than may be spoiled, one
    is equal in the other set; what is first in the order of bins for one of the two is shown by both. A key
    is a bin and the sum of its n-grams, those in ``often`` left out. A set with fewer such bins shows them all, and
    its bins with all n-grams too, since two such sets may only be equal in empty ones; and in the same
    way, the bins that n-grams fall into by other hashes, and at last a key that all such sets have.
    """
    few, keys = grams[~often[counter_of(grams)]], [np.zeros(0, np.uint64)]

    def show(some: np.ndarray, salt: int, count: int, wanted: int, deal: int = 0) -> bool:
        """Whether as many bins as wanted have n-grams; so many keys are shown."""
        if deal:
            hashed = mixed(some + np.uint64(deal))
            order = np.argsort(hashed)
            some, hashed = some[order], hashed[order]
        else:
            hashed = some
        place = ((hashed >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)  # ascending, as hashes are
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
        if len(starts):
            shown = mixed(mixed(place[starts] * _M3 + np.uint64(salt)) + np.add.reduceat(some, starts))
            keys.append(shown[:wanted])
        return len(starts) >= wanted

    for lower, upper in ranges_of(len(grams), percent):
        differ = (100 - percent) * 2 * (upper - 1) // (100 + percent)
        if differ == 0:  # only equal sets are linked, and these are one class
            continue
        # More bins leave fewer sets without the wanted ones, with fewer n-grams in each.
        count, salt = differ + 2 + differ // (8 if binned(percent) else 4), (DEALS + 2) * lower
        if show(few, salt, count, differ + 1):
            continue
        if not any(show(grams, salt + 1 + deal, count, differ + 1, deal) for deal in range(DEALS)):
            keys.append(mixed(np.array([salt + DEALS + 1], np.uint64)))
    return np.concatenate(keys)


def linked_rows(
    sets: list[np.ndarray], percent: int, at_once: int = 64, products: int = 2_000_000
) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets. ``products`` bounds what is multiplied at once."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    row_ends = np.cumsum(sizes)
    grams = np.concatenate(sets)
    del sets  # a task's memory is that of a few numbers of four bytes per n-gram from here on
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    starts = np.append(True, grams[1:] != grams[:-1])
    del grams
    ends = np.append(np.flatnonzero(starts)[1:], len(starts))
    holders = np.repeat(np.arange(n, dtype=np.int32), sizes)[order]
    column = np.empty(len(order), np.int32)
    column[order] = np.cumsum(starts, dtype=np.int32) - np.int32(1)
    del order, starts
    held = np.diff(ends, prepend=0).astype(np.int32)  # rows that hold a column
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    forest: list[tuple[int, int]] = []

    def multiply(rows: np.ndarray) -> np.ndarray:
        """Which rows are linked with each of ``rows``."""
        cols = np.concatenate([column[row_ends[r] - sizes[r] : row_ends[r]] for r in rows])
        local = np.repeat(np.arange(len(rows)), sizes[rows])
        lengths = held[cols]
        upto, overlap, at = np.cumsum(lengths, dtype=np.int64), np.zeros(len(rows) * n, np.int64), 0
        while at < len(cols):  # the columns of a row that shares all its own may be a whole block
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + products, "right")))
            some, before = lengths[at:end], upto[at:end] - done
            place = np.repeat(ends[cols[at:end]] - before, some) + np.arange(before[-1])
            overlap += np.bincount(np.repeat(local[at:end], some) * n + holders[place], minlength=len(rows) * n)
            at = end
        overlap = overlap.reshape(len(rows), n)
        both = sizes[rows][:, None] + sizes[None, :]
        return (100 + percent) * overlap >= percent * both

    def join(rows: np.ndarray) -> np.ndarray:
        yes = multiply(rows)
        for k, other in zip(*np.nonzero(yes), strict=True):
            a, b = find(int(rows[k])), find(int(other))
            if a != b:
                root[max(a, b)] = min(a, b)
                forest.append((int(rows[k]), int(other)))
        return yes

    rest = np.flatnonzero(~join(np.array([0]))[0])
    # A row's work is the holders of its n-grams; rows are multiplied together up to a bound of that.
    work = np.add.reduceat(held[column], row_ends - sizes, dtype=np.int64)[rest]
    at = 0
    while at < len(rest):
        fitting = int(np.searchsorted(np.cumsum(work[at : at + at_once]), products, "right"))
        join(rest[at : at + max(1, min(fitting, products // n))])
        at += max(1, min(fitting, products // n))
    return forest


def _key(grams: np.ndarray, salt: np.uint64) -> int:
    """A hash of the set."""
    return int(mixed(mixed(grams) + salt).sum(dtype=np.uint64).astype(np.int64))


SLICES = 64
CLASS = "doc_id long, text_hash long, n_shingles long, first long, second long"


def classes(docs: DataFrame, n: int) -> DataFrame:
    """In one pass: per document its key, its size and the two hashes of its set, and per task its
    counters in slices (``slice``, ``part``, ``data``), which the other rows have as null.

    A counter says how often its n-grams stand in sets, up to 65,535; equal sets count once in a task.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, done, total = Shingles(n), set(), np.zeros(1 << BITS, np.uint32)
        out = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_hash", "n_shingles", "first", "second", "slice", "part")] + [("data", pa.binary())])

        def rows(count: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in out], schema=out)

        for b in batches:
            sets = [shingles.of(t) for t in b.column(1).to_pylist()]
            first = [_key(s, _M1) for s in sets]
            for key, grams in zip(first, sets, strict=True):
                if key not in done:
                    done.add(key)
                    np.add.at(total, counter_of(grams), 1)
            if len(done) > 1_000_000:
                done.clear()
            numbers = [list(map(len, sets)), first, [_key(s, _M2) for s in sets]]
            hashes = dict(zip(("n_shingles", "first", "second"), (pa.array(c, pa.int64()) for c in numbers), strict=True))
            yield rows(len(sets), doc_id=b.column(0), text_hash=b.column(2), **hashes)
        data = [packed(piece) for piece in np.split(np.minimum(total, 65_535), SLICES)]
        part = pa.array([TaskContext.get().partitionId()] * SLICES, pa.int64())
        yield rows(SLICES, slice=pa.array(range(SLICES), pa.int64()), part=part, data=pa.array(data, pa.binary()))

    return _keyed(docs).mapInArrow(make, f"{CLASS}, slice long, part long, data binary")


#: What tells rows apart; those equal in it are repeated.
KEY = ["doc_id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text_hash", F.xxhash64("text"))


def _counters(found: DataFrame) -> np.ndarray:
    """The counters of all tasks in ``classes``, summed."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.minimum(sum(unpacked(d) for d in rows["data"]), 65_535)
        return pd.DataFrame({"slice": rows["slice"][:1], "part": rows["part"][:1], "data": [packed(total)]})

    schema = "slice long, part long, data binary"
    some = found.where("slice IS NOT NULL").select("slice", "part", "data")
    some = some.groupBy("slice", F.floor(F.col("part") / 64).alias("some")).applyInPandas(add, schema)
    summed = {r["slice"]: unpacked(r["data"]) for r in some.groupBy("slice").applyInPandas(add, schema).collect()}
    none = np.zeros((1 << BITS) // SLICES, np.int64)
    return np.concatenate([summed.get(k, none) for k in range(SLICES)]).astype(np.uint16)


def _shown(docs: DataFrame, counters: np.ndarray, n: int, percent: int, grouped: bool = False) -> DataFrame:
    """(first, size, part): the bins or leading n-grams of sets, equal sets once in a task.

    ``grouped``: bins, and sets meet only others of their group, which is in ``doc_id``.
    """
    show, known = (bins, common(counters)) if grouped or binned(percent) else (leading, counters)
    sent = docs.sparkSession.sparkContext.broadcast(known)  # of a fixed size

    def make(pairs: Iterator[tuple[list, list[str]]]) -> Iterator[dict]:
        shingles, done = Shingles(n), set()
        for ids, texts in pairs:
            first, size, part = ([np.zeros(0, np.int64)] for _ in range(3))
            for group, text in zip(ids, texts, strict=True):
                grams = shingles.of(text)
                key = _key(grams, _M1)
                if key not in done and len(grams):
                    done.add(key)
                    keys = show(grams, sent.value, percent).view(np.int64)
                    part.append(mixed((keys ^ group).view(np.uint64)).view(np.int64) if grouped else keys)
                    first.append(np.full(len(part[-1]), key))
                    size.append(np.full(len(part[-1]), len(grams)))
            if len(done) > 1_000_000:
                done.clear()
            yield {"first": np.concatenate(first), "size": np.concatenate(size), "part": np.concatenate(part)}

    return map_texts(texts_of(docs), make, "first long, size long, part long")


def _candidates(shown: DataFrame, percent: int) -> DataFrame:
    """(first, group) for sets that meet others.

    The sets with an n-gram or a bin, by size, fall into runs in which each size allows a link with the one
    before; sets of a run are one group. Sets and runs are never turned into pairs of sets: each round
    takes the least set of each run and the least of these for each set, which takes its place. Rows
    that become equal, and runs left with one set, go, so rounds shrink; each row is one of ``shown``.
    """
    order = Window.partitionBy("part").orderBy("size", "first")
    fits = F.lag("size").over(order) * 100 >= F.col("size") * percent
    starts = shown.withColumn("start", F.when(F.coalesce(fits, F.lit(False)), F.lit(None)).otherwise(F.col("first")))
    run = F.last("start", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = starts.withColumn("start", run)
    rows = _open_runs(placed.select(F.col("first").alias("node"), "part", "start"), ["part", "start"])
    rows = rows.select("node", F.xxhash64("part", "start").alias("run"), "least")
    moves = []
    while True:
        parent = F.min("least").over(Window.partitionBy("node"))
        stepped = settled(rows.select("node", "run", parent.alias("parent")), "ngram-runs")
        if stepped.isEmpty():
            break
        moves.append(settled(stepped.select("node", "parent").distinct(), "ngram-moves"))
        merged = stepped.select(F.col("parent").alias("node"), "run").repartition("run").dropDuplicates(["run", "node"])
        rows = _open_runs(merged, ["run"])
    if not moves:
        return shown.select("first", F.col("first").alias("group")).limit(0)
    found = moves[0].select(F.col("node").alias("first"), F.col("parent").alias("group"))
    for move in moves[1:]:
        found = found.join(move.withColumnRenamed("node", "group"), "group", "left").select("first", F.coalesce("parent", "group").alias("group"))
    return found


def _open_runs(rows: DataFrame, run: list[str]) -> DataFrame:
    """The rows of runs with more than one set, with the least of them."""
    of_run = Window.partitionBy(*run)
    bounded = rows.withColumns({"least": F.min("node").over(of_run), "most": F.max("node").over(of_run)})
    return bounded.where("least < most").drop("most")


def _refined(docs: DataFrame, met: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """The candidate classes ``met`` with groups of more than ``block`` n-grams taken apart, as far as possible.

    Sets that are linked share a leading n-gram and a bin, so within a group they meet again in bins. N-grams
    are counted anew among the sets of these groups alone, fewer each round, so counters tell more of them apart.
    It ends when rounds no longer make a tenth of such groups go: what is left are near copies, mostly.
    """
    before, columns = None, met.columns
    while True:
        total = F.sum("n_shingles").alias("total")
        met = settled(met, "ngram-met")
        sized = met.join(met.groupBy("group").agg(total), "group")
        large = sized.where(F.col("total") > block).select(columns)
        held = large.agg(total).first()[0] or 0
        if held == 0 or (before is not None and held * 10 > before * 9):
            return met
        before = held
        # Each class by one row of it; a class is found by its first hash, as its group is.
        texts = _keyed(docs).join(large.select(*KEY, "group").distinct().hint("merge"), KEY)
        texts = settled(texts.select(F.col("group").alias("doc_id"), "text"), "ngram-large")
        counters = _counters(settled(classes(texts, n), "ngram-counts"))
        again = _candidates(_shown(texts, counters, n, percent, grouped=True), percent)
        apart = large.drop("group").join(again, "first").select(columns)
        met = sized.where(F.col("total") <= block).select(columns).union(apart)


def _links(docs: DataFrame, candidates: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """(a, b) over the nodes of candidate classes: ``node``, ``group``, ``n_shingles``, and the key of a row."""
    total = candidates.groupBy("group").agg(F.sum("n_shingles").alias("total"))
    placed = candidates.join(total, "group").withColumn("splits", F.ceil(F.col("total") / block).cast("int"))
    mine = F.pmod(F.xxhash64("node"), F.col("splits")).cast("int")
    tasks = F.transform(
        F.sequence(F.lit(0), F.col("splits") - 1), lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j"))
    )
    wanted = placed.select(*KEY, "node", "first", "group", "n_shingles", tasks.alias("tasks"))
    wanted = settled(wanted, "ngram-wanted")
    # Merged at every size: the list grows with the input, and no step should change with it. Texts are
    # shuffled and not their sets, which are larger and compress less.
    texts = _keyed(docs).join(wanted.hint("merge"), KEY).select("node", "first", "group", F.explode("tasks").alias("task"), "text")
    spread = texts.select("node", "first", "group", "task.i", "task.j", "text")

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        out, shingles = [], Shingles(n)
        for _, mine in rows.drop_duplicates().groupby(["group", "i", "j"]):
            sets = {}
            for node, first, text in zip(mine["node"], mine["first"], mine["text"], strict=True):
                grams = shingles.of(text)
                if _key(grams, _M1) == first:  # and no other text of the same key
                    sets[node] = grams
            ids = list(sets)
            if len(ids) > 1:
                out += [(ids[a], ids[b]) for a, b in linked_rows([sets.pop(i) for i in ids], percent)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    # Small groups share a frame, as many as a quarter of a block holds.
    buckets = 1 + (wanted.agg(F.sum("n_shingles")).first()[0] or 0) * 4 // block
    bucket = F.pmod(F.xxhash64("group", "i", "j"), F.lit(buckets))
    return spread.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(multiply, "a long, b long")


SAME = ["n_shingles", "first", "second"]


def _joined(docs: DataFrame, n: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The rows with the hashes of their sets, and each set with the least row (``least``) that links reach."""
    written = settled(classes(docs, n), "ngram-classes")
    found = written.where("slice IS NULL").drop("slice", "part", "data")
    # The least id there is; rows without one come last.
    least = F.min(F.struct((F.col("doc_id") == NO_ID).alias("no_id"), *KEY)).alias("least")
    # Numbers are given as the table is written, so that every later step reads the same.
    numbered = found.where("n_shingles > 0").groupBy(SAME).agg(least).withColumn("node", F.monotonically_increasing_id())
    kinds = settled(numbered.select(*SAME, "node", *(f"least.{c}" for c in KEY)), "ngram-kinds")
    met = kinds.join(_candidates(_shown(docs, _counters(written), n, percent), percent), "first")
    if not binned(percent):
        met = _refined(docs, met, n, percent, block)
    links = settled(_links(docs, met, n, percent, block), "ngram-links")
    reached = settled(kinds.join(connected(links, "ngram-components"), "node"), "ngram-reached")
    of_component = reached.groupBy("component").agg(least)
    linked = reached.join(of_component, "component").select(*SAME, "least")
    alone = kinds.join(reached, "node", "left_anti").select(*SAME, F.struct(*KEY).alias("least"))
    return found, linked.select(*SAME, F.struct(*(f"least.{c}" for c in KEY)).alias("least")).union(alone)


def components(docs: DataFrame, n: int = 5, percent: int = 80, block: int = BLOCK_GRAMS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, and the smallest id reachable by links."""
    found, kinds = _joined(docs, n, percent, block)
    out = found.join(kinds.select(*SAME, F.col("least.doc_id").alias("component")), SAME, "left")
    own = F.coalesce("component", "doc_id")
    return out.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(own, F.lit(NO_ID)).alias("component_id")
    )


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, block: int = BLOCK_GRAMS) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; all columns are kept.

    Rows without n-grams are linked with nothing, and only repeated ones go.
    """
    found, kinds = _joined(docs, n, percent, block)
    key = [_unused(docs, name) for name in ("__id", "__text")]
    place_name = _unused(docs, "__place")
    stays = kinds.select("least.*").union(found.where("n_shingles = 0").select(*KEY)).distinct().toDF(*key)
    keyed = docs.withColumns({
        key[0]: F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)),
        key[1]: F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))),
    })
    place = F.row_number().over(Window.partitionBy(key).orderBy(key))
    kept = keyed.join(stays, key, "left_semi").withColumn(place_name, place).where(F.col(place_name) == 1)
    return kept.drop(*key, place_name)
