"""Exact n-gram Jaccard join by a blocked sparse product of documents by n-grams.

Words are runs of code points that are not ASCII white space, in ASCII lower case. A document is the set of its distinct
runs of `shingle` words; shorter ones are one run, empty ones none, and those link with nothing. Two documents link when
|A and B| * `percent[1]` >= |A or B| * `percent[0]`; no link between different sets is missed but for colliding 64-bit hashes.

Bounds. With t the similarity, a link needs t <= |A| / |B| <= 1 / t, and A may miss B in at most k = floor((1 - t) |A|) of its
n-grams. Documents of equal sets are one row of the incidence matrix, and rows go as soon as a bound shows them linkless:
1. Of all n-grams those with a hash in the lowest quarter are counted over all rows. They are the same choice for every
   document, so a row that has more than k of them to itself has no link.
2. Rows left get all their n-grams, counted over the rows left. One with more than k to itself goes. Of the others only
   the k + 1 rarest columns are kept: two rows that link share one of them, as both count columns in one order.
3. Columns join rows to families: each row with the column's smallest. A link lies within a family.

Product. A family's incidence is multiplied by its transpose in blocks of bounded rows and entries, a block pair a group.
Overlaps add up over chunks of the columns that both blocks have; after each, pairs whose overlap cannot reach
t (|A| + |B|) / (1 + t) any more are discarded, and rows without a pair left leave the product. A block pair returns what it
connects, one edge a row, not its links. In large families about `HUBS` rows, chosen by a hash, are multiplied with all others
first; then only rows outside the largest component meet the whole family, in blocks of like sizes, as t allows no others.

Defined cases: a null text is empty; a null doc_id takes part in no link of its own and has the component of rows with its set;
rows of equal doc_id are one document for their component; repeated rows, ties and clashing columns do no harm; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.components import components
from sievelake.llm.storage import keep
from sievelake.llm.text import Words, blocks, mix

#: The lowest part of the hashes that the first bound counts, as a power of two.
QUARTER = 2
#: Rows and entries of a block.
ROWS, ENTRIES = 1000, 500_000
#: Columns multiplied at once.
CHUNK = 2048
#: Rows of a large family that are multiplied with all its rows first, about.
HUBS = 64
#: Ways a family's rows are dealt when they look for its size.
SALT = 16

_DESCRIBED = "doc_id long, n_shingles long, set_a long, set_b long, sampled array<long>"
_SETS = "node long, doc_id long, n long, shingles array<long>"


def _sums(u: np.ndarray) -> tuple[int, int]:
    m = mix(u)
    return int(m.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(m, initial=np.uint64(0)).astype(np.int64))


def _lists(many: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, many)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *many]).view(np.int64)))


def described(shingle: int):
    """For mapInArrow: (doc_id, text) to set sizes, digests of the sets and the n-grams of the lowest hashes."""
    most = np.uint64(1 << (64 - QUARTER))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, end, held in blocks(texts):
                with np.errstate(over="ignore"):
                    sets = Words(held).shingles(shingle)
                    digests = [_sums(u) for u in sets]
                low = [u[: np.searchsorted(u, most)] for u in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first).cast(pa.int64()),
                        pa.array([len(u) for u in sets], pa.int64()),
                        *[pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)],
                        _lists(low),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "sampled"],
                )

    return rows


def full_sets(shingle: int):
    """For mapInArrow: (text, node, doc_id, set_a, set_b) to the whole set, if it is the one that the node stands for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, facts = batch.column(0).to_pylist(), [batch.column(i).to_pylist() for i in range(1, 5)]
            for first, end, held in blocks(texts):
                with np.errstate(over="ignore"):
                    sets = Words(held).shingles(shingle)
                    own = [i for i, u in enumerate(sets) if _sums(u) == (facts[2][first + i], facts[3][first + i])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([facts[0][first + i] for i in own], pa.int64()),
                        pa.array([facts[1][first + i] for i in own], pa.int64()),
                        pa.array([len(sets[i]) for i in own], pa.int64()),
                        _lists([sets[i] for i in own]),
                    ],
                    names=["node", "doc_id", "n", "shingles"],
                )

    return rows


def _misses(n, over: int, under: int):
    """The n-grams a row of n may lack in a row it links with."""
    return F.floor(n * (under - over) / under).cast("long")


def join(docs: DataFrame, shingle: int = 5, percent: tuple[int, int] = (80, 100), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id that links reach, itself included)."""
    over, under = percent
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = keep(read.mapInArrow(described(shingle), _DESCRIBED))
    key = ["n_shingles", "set_a", "set_b"]
    rows = keep(
        base.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("doc_id"), F.min_by("sampled", "doc_id").alias("sampled"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    left = _not_alone(rows, over, under)
    names = ["node", F.col("doc_id").alias("head"), "set_a", "set_b"]
    texts = read.join(left.select(*names).hint("merge"), F.col("doc_id") == F.col("head")).select("text", "node", "doc_id", "set_a", "set_b")
    sets = keep(texts.mapInArrow(full_sets(shingle), _SETS).dropDuplicates(["node"]))
    families = _families(sets, over, under)
    labels = components(_connected(sets, families, over, under))

    groups = rows.join(labels.withColumnRenamed("node", "linked"), F.col("doc_id") == F.col("linked"), "left")
    groups = groups.select(*key, F.coalesce("component", "doc_id").alias("found"))
    placed = base.select("doc_id", *key).join(groups, key, "left")
    return placed.select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))


def _not_alone(rows: DataFrame, over: int, under: int) -> DataFrame:
    """The rows that the first bound leaves."""
    grams = rows.select("node", F.explode("sampled").alias("gram"))
    twice = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    shared = grams.join(twice, "gram", "left_semi").groupBy("node").agg(F.count("*").alias("shared"))
    facts = rows.select("node", "doc_id", "set_a", "set_b", F.col("n_shingles").alias("n"), F.size("sampled").alias("counted"))
    enough = F.coalesce("shared", F.lit(0)) >= F.col("counted") - _misses(F.col("n"), over, under)
    return keep(facts.join(shared, "node", "left").where(enough).select("node", "doc_id", "set_a", "set_b"))


def _families(sets: DataFrame, over: int, under: int) -> DataFrame:
    """doc_id, family of the rows that share one of their rarest columns with another."""
    grams = sets.select("node", F.explode("shingles").alias("gram"))
    twice = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    order = F.array_sort(F.collect_list(F.struct("df", "gram")))
    shared = grams.join(twice, "gram").groupBy("node").agg(order.alias("columns"))
    rarest = _misses(F.col("n"), over, under) + 1 - (F.col("n") - F.size("columns"))
    kept = (
        shared.join(sets.select("node", "doc_id", "n"), "node")
        .withColumn("rarest", rarest.cast("int"))
        .where("rarest > 0")
        .select("doc_id", F.explode(F.slice("columns", F.lit(1), F.col("rarest"))["gram"]).alias("gram"))
    )
    kept = keep(kept)
    first = kept.groupBy("gram").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("gram", "a")
    edges = keep(kept.join(first, "gram").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct())
    return components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("family"))


# ---- product


def linked(left: list[np.ndarray], right: list[np.ndarray], over: int, under: int) -> np.ndarray:
    """Which rows of two blocks link, as a matrix of booleans."""
    out = np.zeros((len(left), len(right)), bool)
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    # columns that both blocks have, numbered; entries of all others count for no overlap
    columns = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    entries = []
    for side, size in zip((left, right), sizes):
        grams, row = np.concatenate(side), np.repeat(np.arange(len(side)), size)
        at = np.minimum(np.searchsorted(columns, grams), max(len(columns) - 1, 0))
        hit = columns[at] == grams if len(columns) else np.zeros(len(grams), bool)
        at, row = at[hit], row[hit]
        order = np.argsort(at, kind="stable")
        entries.append((at[order], row[order]))
    need = -((sizes[0][:, None] + sizes[1][None, :]) * -over // (over + under))
    rest = [np.bincount(row, minlength=len(size)) for (_, row), size in zip(entries, sizes)]
    common = np.zeros(out.shape, np.float32)
    viable = np.minimum(rest[0][:, None], rest[1][None, :]) >= need
    for first in range(0, len(columns), CHUNK):
        rows = [np.flatnonzero(viable.any(axis=1)), np.flatnonzero(viable.any(axis=0))]
        if not len(rows[0]):
            return out
        parts = []
        for (at, row), own, size, left_over in zip(entries, rows, sizes, rest):
            a, b = np.searchsorted(at, [first, first + CHUNK])
            place = np.full(len(size), -1)
            place[own] = np.arange(len(own))
            part = np.zeros((len(own), min(CHUNK, len(columns) - first)), np.float32)
            here = place[row[a:b]]
            part[here[here >= 0], at[a:b][here >= 0] - first] = 1
            parts.append(part)
            left_over -= np.bincount(row[a:b], minlength=len(size))
        common[np.ix_(*rows)] += parts[0] @ parts[1].T
        viable &= common + np.minimum(rest[0][:, None], rest[1][None, :]) >= need
    return viable & (common >= need) if len(columns) else out


def connections(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """(smallest document, document) of what a matrix of links connects; `left` and `right` name its rows and columns."""
    least_left, least_right = left.copy(), right.copy()
    most = np.iinfo(np.int64).max
    while True:
        now = np.minimum(least_left, np.where(links, least_right[None, :], most).min(axis=1, initial=most))
        then = np.minimum(least_right, np.where(links, now[:, None], most).min(axis=0, initial=most))
        if (now == least_left).all() and (then == least_right).all():
            break
        least_left, least_right = now, then
    pairs = {(int(a), int(b)) for side, least in ((left, least_left), (right, least_right)) for a, b in zip(least, side) if a != b}
    return sorted(pairs)


def product(over: int, under: int):
    """For mapInArrow: rows sorted by block pair to what each pair connects. Side 0 is the left block, 1 the right, 2 both."""

    def block(docs: list[int], sides: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        left, right = ([i for i, s in enumerate(sides) if s in (own, 2)] for own in (0, 1))
        if not left or not right:
            return []
        ids = np.array(docs, np.int64)
        links = linked([sets[i] for i in left], [sets[i] for i in right], over, under)
        return connections(links, ids[left], ids[right])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, ([], [], []), []
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            docs, sides = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            lists = batch.column(6)
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values).view(np.uint64)
            for i, key in enumerate(keys):
                if key != now:
                    out += block(*held)
                    now, held = key, ([], [], [])
                for values, value in zip(held, (docs[i], sides[i], flat[offsets[i] : offsets[i + 1]].copy())):
                    values.append(value)
            if out:
                yield _pairs(out)
                out = []
        out += block(*held)
        if out:
            yield _pairs(out)

    return rows


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs)], names=["a", "b"])


def _multiplied(blocks_: DataFrame, over: int, under: int) -> DataFrame:
    """`blocks_` has family, size, r, m, doc_id, side, shingles; one exchange deals every block pair on its own."""
    key = ["family", "size", "r", "m"]
    dealt = blocks_.select(*key, "doc_id", "side", "shingles").repartition(*key).sortWithinPartitions(*key)
    return keep(dealt.mapInArrow(product(over, under), "a long, b long").distinct())


def _connected(sets: DataFrame, families: DataFrame, over: int, under: int) -> DataFrame:
    """a, b: pairs that links connect, in all families."""
    members = keep(sets.select("node", "doc_id", "n").join(families, "doc_id"))
    count = F.greatest(F.ceil(F.count("*") / ROWS), F.ceil(F.sum("n") / ENTRIES)).cast("int")
    sizes = members.groupBy("family").agg(count.alias("parts"), F.count("*").alias("rows"))
    salted = F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")
    large = sizes.where("parts > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    placed = keep(members.withColumn("salt", salted).join(large, ["family", "salt"], "left").drop("salt"))
    held = sets.select("node", "shingles")
    zero, both = F.lit(0), F.lit(2)

    small = placed.where("parts IS NULL").select("node", "doc_id", "family", zero.alias("size"), zero.alias("r"), zero.alias("m"), both.alias("side"))
    # of large families, hubs with all rows
    big = placed.where("parts IS NOT NULL")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    hub = F.pmod(F.xxhash64("node", F.lit(2)), F.greatest(F.lit(1), F.floor(F.col("rows") / HUBS))) == 0
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    with_hubs = big.select("node", "doc_id", "family", zero.alias("size"), part.alias("r"), zero.alias("m"), F.when(hub, 2).otherwise(0).alias("side")).unionAll(
        big.where(hub).withColumn("own", part).select("node", "doc_id", "family", zero.alias("size"), every.alias("r"), zero.alias("m"), F.lit(1).alias("side"), "own").where("r <> own").drop("own")
    )
    first = _multiplied(small.unionAll(with_hubs).join(held, "node"), over, under)
    return first.unionAll(_rest(big, first, held, over, under))


def _rest(big: DataFrame, first: DataFrame, held: DataFrame, over: int, under: int) -> DataFrame:
    """What connects the rows of large families that lie outside their largest component with any of the family."""
    labels = components(first).select(F.col("node").alias("named"), "component")
    known = keep(big.join(labels, F.col("doc_id") == F.col("named"), "left").withColumn("component", F.coalesce("component", "doc_id")).drop("named"))
    counted = known.groupBy("family", "component").agg(F.count("*").alias("c"))
    largest = counted.groupBy("family").agg(F.max_by("component", F.struct("c", "component")).alias("largest"))
    largest = largest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")
    # sizes that may link lie in one bin or in two neighbouring ones; the base is a little wider than the bound
    width = math.log(under / over) * 1.0001 + 1e-9
    level = F.floor(F.log(F.col("n")) / width).cast("int")
    told = keep(known.withColumn("salt", salted).join(largest, ["family", "salt"]).withColumn("level", level).withColumn("rest", F.col("component") != F.col("largest")))
    blocks_ = F.greatest(F.ceil(F.count("*") / ROWS), F.ceil(F.sum("n") / ENTRIES)).cast("int")
    rests = told.where("rest").groupBy("family", F.col("level").alias("size")).agg(blocks_.alias("rests"))
    near = rests.select("family", "size", "rests", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("level"))
    alls = told.groupBy("family", "level").agg(blocks_.alias("alls"))
    met = near.join(alls, ["family", "level"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    # the bin of the other side is part of the block's number
    own = F.xxhash64("node", F.lit(3))
    m_of = lambda m: m + (F.col("level") - F.col("size") + 1) * 1_000_000
    facts = ["node", "doc_id", "family", "size"]
    mine = told.where("rest").select("node", "doc_id", "family", F.col("level").alias("size"), "salt")
    left = mine.join(met, ["family", "size", "salt"]).select(
        *facts, F.pmod(own, F.col("rests")).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("alls") - 1)).alias("m"), "level", F.lit(0).alias("side")
    )
    right = told.select("node", "doc_id", "family", "level", "salt").join(met, ["family", "level", "salt"]).select(
        *facts, F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("r"), F.pmod(own, F.col("alls")).cast("int").alias("m"), "level", F.lit(1).alias("side")
    )
    dealt = left.unionAll(right).withColumn("m", m_of(F.col("m"))).drop("level")
    return _multiplied(dealt.join(held, "node"), over, under)
