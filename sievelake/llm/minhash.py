"""Near-duplicate groups by circulant MinHash.

Words are runs of code points that are not ASCII white space, in ASCII lower case. A document is the set
of its distinct shingles of `shingle` words; shorter ones are one shingle, empty ones none, and those
link with nothing. Two documents are linked when |A and B| * `percent[1]` >= |A or B| * `percent[0]`, and a group is
what links connect.

Signature. Circulant MinHash needs two permutations of a universe of 2^20 places. The first, a hash,
places the shingles; the second is a fixed table, and coordinate k of the signature is the minimum of the
table, circularly shifted by k, over the document's places. So for one shingle all coordinates are one
contiguous slice of the table.

Search. `BANDS` bands of `ROWS` coordinates are hashed; documents that share a band are candidates, and
a link of similarity 0.85 is missed with a chance of 2e-8, one of 0.8 with 3e-6. Candidates are
confirmed on their full sets. Documents of equal sets make a class first, and one of each class goes on.
Candidates are never all pairs of a band:
1. Each member of a band is paired with the band's smallest member if two necessary conditions hold: the sizes'
   ratio, and a bound on differing signature bits that a true link exceeds with a chance below 1e-9. Those pairs
   make families. Between families, pairs of one band that meet both conditions, few as they are, are noted.
2. The full sets of these documents are made once. Every document is compared with the partner it shares most
   bands with, and pairs between families are compared; what is confirmed makes components.
3. What is left are links between components of a family. Members outside its largest component
   are compared with the whole family in blocks of bounded size, each block's common shingles being counted by
   one matrix product; only links come out.
Any pair of one band that is never compared is already connected, so no group is lost.

Defined cases: a null text is empty; a null doc_id takes part in no link of its own: it is kept unless its
set equals that of a row with an id; rows of equal doc_id are one document, so they stay or go together; extra
columns are not looked at by `near_duplicates` and carried by `drop_near_duplicates`.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.components import components
from sievelake.llm.storage import keep
from sievelake.llm.text import Words, blocks, mix

UNIVERSE_BITS = 20
BANDS = 24
ROWS = 4
SEED = 20260101
#: Members of a band, and documents and shingles of the two sides of a block, that are compared at once.
BAND_ROWS = 500
REST_ROWS, REST_SHINGLES = 500, 250_000
ALL_ROWS, ALL_SHINGLES = 1000, 500_000
#: Ways a family's rows are dealt when they look for its facts.
SALT = 16
#: What a band's member is compared by.
FACTS = ("doc_id", "n", "bits_a", "bits_b")

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bits_a long, bits_b long, bands array<long>"


def _table() -> np.ndarray:
    """The second permutation; its first places once more at the end, as it is read in a circle."""
    table = np.random.default_rng(SEED).permutation(1 << UNIVERSE_BITS).astype(np.int32)
    return np.concatenate([table, table[: BANDS * ROWS]])


def signature(shingles: np.ndarray, slices: np.ndarray) -> np.ndarray:
    places = (mix(shingles ^ np.uint64(SEED)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    least = None
    for i in range(0, len(places), 4096):
        part = slices[places[i : i + 4096]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def signed(shingle: int):
    """For mapInArrow: (doc_id, text) to set digests, signature bits and band hashes."""

    def rows(batches):
        table = _table()
        slices = np.lib.stride_tricks.sliding_window_view(table, BANDS * ROWS)
        number = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, end, held in blocks(texts):
                sizes, digests, bits, bands = [], [], [], []
                with np.errstate(over="ignore"):
                    for u in Words(held).shingles(shingle):
                        sizes.append(len(u))
                        if not len(u):
                            digests.append((0, 0))
                            bits.append((0, 0))
                            bands.append(np.array([], dtype=np.int64))
                            continue
                        m = mix(u)
                        digests.append((int(m.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(m).astype(np.int64))))
                        sig = signature(u, slices)
                        packed = np.packbits((sig & 1).astype(np.uint8))
                        packed = np.concatenate([packed, np.zeros(16 - len(packed), np.uint8)]).view(np.int64)
                        bits.append((int(packed[0]), int(packed[1])))
                        h = mix(number + np.uint64(1))
                        for column in sig.reshape(BANDS, ROWS).T:
                            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
                        bands.append(h.view(np.int64))
                ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first).cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        *[pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)],
                        *[pa.array([b[i] for b in bits], pa.int64()) for i in (0, 1)],
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands), pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bits_a", "bits_b", "bands"],
                )

    return rows


def shingled(shingle: int):
    """For mapInArrow: (doc_id, text, partner) to the sorted set of shingle hashes, as bytes."""

    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, end, held in blocks(texts):
                sets = [u.tobytes() for u in Words(held).shingles(shingle)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first),
                        pa.array(sets, pa.binary()),
                        batch.column(2).slice(first, end - first),
                    ],
                    names=["doc_id", "shingles", "partner"],
                )

    return rows


def confirmed(over: int, under: int):
    """For mapInArrow: (a, b, set of a, set of b) to the pairs that are similar enough."""

    def rows(batches):
        for batch in batches:
            keep_, left, right = [], batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep_.append(common * under >= (len(both) - common) * over)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep_, pa.bool_())
            )

    return rows


def most_differing_bits(similarity: float, bits: int = BANDS * ROWS, chance: float = 1e-9) -> int:
    """The least number that a true link's differing bits exceed with a chance below `chance`."""
    p, tail = (1 - similarity) / 2, 1.0
    for k in range(bits + 1):
        tail -= math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
        if tail < chance:
            return k
    return bits


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: tuple[int, int] = (80, 100),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id of its group), kept."""
    over, under = percent
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = keep(read.mapInArrow(signed(shingle), _SIGNED))

    key = ["n_shingles", "set_a", "set_b"]
    classes = keep(
        base.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("class")).where("class IS NOT NULL")
    )
    heads = base.join(
        classes.select(F.col("class").alias("doc_id"), *key), ["doc_id", *key], "left_semi"
    ).dropDuplicates(["doc_id", *key])
    members = keep(
        heads.select("doc_id", F.col("n_shingles").alias("n"), "bits_a", "bits_b", F.explode("bands").alias("band"))
    )

    # each member of a band with the band's smallest
    small = members.groupBy("band").agg(F.min(F.struct(*FACTS)).alias("s"), F.count("*").alias("c"))
    small = small.where("c > 1").select("band", *[F.col(f"s.{x}").alias(f"s_{x}") for x in FACTS])
    differ = F.bit_count(F.col("bits_a").bitwiseXOR(F.col("s_bits_a"))) + F.bit_count(
        F.col("bits_b").bitwiseXOR(F.col("s_bits_b"))
    )
    possible = (
        (F.col("doc_id") > F.col("s_doc_id"))
        & (F.least("n", "s_n") * under >= F.greatest("n", "s_n") * over)
        & (differ <= most_differing_bits(over / under))
    )
    pairs = keep(
        members.join(small, "band")
        .where(possible)
        .groupBy(F.col("s_doc_id").alias("a"), F.col("doc_id").alias("b"))
        .agg(F.count("*").alias("shared"))
    )
    families = keep(components(pairs.select("a", "b")).withColumnRenamed("component", "family"))
    crossing = _between_families(members, families, possible)

    # the full sets of all documents that may have a link, made once, each with the partner to be confirmed first
    partner = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("partner"))
    named = (
        families.select(F.col("node").alias("named"))
        .unionAll(crossing.select("a"))
        .unionAll(crossing.select("b"))
        .distinct()
        .join(partner, F.col("named") == F.col("b"), "left")
        .select("named", "partner")
    )
    texts = read.join(named.hint("merge"), read["doc_id"] == F.col("named")).select("doc_id", "text", "partner")
    sets = keep(texts.mapInArrow(shingled(shingle), "doc_id long, shingles binary, partner long"))

    first = sets.where("partner IS NOT NULL").select(F.col("partner").alias("a"), F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    whole = sets.select("doc_id", "shingles")
    asked = first.select("a").distinct()
    partners = whole.join(asked, whole["doc_id"] == asked["a"], "left_semi").toDF("a", "left")
    sides = first.join(partners.hint("merge"), "a")
    across = crossing.join(whole.toDF("b", "right"), "b").join(whole.toDF("a", "left"), "a")
    links = keep(
        sides.select("a", "b", "left", "right")
        .unionAll(across.select("a", "b", "left", "right"))
        .mapInArrow(confirmed(over, under), "a long, b long")
        .distinct()
    )
    labels = keep(
        families.join(components(links), "node", "left").select(
            "node", "family", F.coalesce("component", "node").alias("component")
        )
    )
    inner = _within_families(whole, labels, over, under)
    labels = components(links.unionAll(inner))

    groups = classes.join(labels, classes["class"] == labels["node"], "left").select(
        *key, F.coalesce("component", "class").alias("component_id")
    )
    placed = base.select("doc_id", *key).join(groups, key, "left")
    component = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.when(component.isNull(), True).otherwise(F.coalesce(F.col("doc_id") == component, F.lit(False))).alias("kept"),
    )


def _between_families(members: DataFrame, families: DataFrame, possible: Column) -> DataFrame:
    """Pairs of one band, of different families, that may be linked.

    Bands of more than `BAND_ROWS` such members are dealt in parts, each of which meets the whole band.
    """
    placed = members.join(families.select(F.col("node").alias("doc_id"), "family"), "doc_id", "left")
    placed = placed.withColumn("family", F.coalesce("family", "doc_id"))
    met = placed.groupBy("band").agg(F.min("family").alias("x"), F.max("family").alias("y"), F.ceil(F.count("*") / BAND_ROWS).cast("int").alias("parts"))
    met = met.where("x < y").select("band", "parts")
    placed = keep(placed.join(met, "band"))
    one = placed.withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    other = placed.select(F.col("band").alias("s_band"), every.alias("s_part"), *[F.col(x).alias(f"s_{x}") for x in (*FACTS, "family")])
    same = (F.col("band") == F.col("s_band")) & (F.col("part") == F.col("s_part"))
    return keep(
        one.join(other, same & (F.col("family") != F.col("s_family")) & possible)
        .select(F.col("s_doc_id").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )


def _within_families(sets: DataFrame, labels: DataFrame, over: int, under: int) -> DataFrame:
    """Links of members outside their family's largest component with any member of the family.

    Both sides are dealt into blocks of bounded counts of documents and shingles; every block of the
    one meets every block of the other. What a block is follows from ids and counts alone; sets join at last, by document, and one
    exchange by family and both blocks deals the pairs of a large family over many tasks.
    """
    facts = sets.select(F.col("doc_id").alias("node"), (F.octet_length("shingles") / 8).cast("long").alias("n"))
    told = keep(labels.join(facts.distinct(), "node"))
    sizes = told.groupBy("family", "component").agg(F.count("*").alias("n"))
    largest = (
        sizes.groupBy("family")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("c"))
        .where("c > 1")
        .drop("c")
    )
    # a family's rows look for its facts in `SALT` parts
    salt, salts = F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    salted = told.withColumn("salt", salt)
    held = keep(salted.join(largest.withColumn("salt", salts), ["family", "salt"]).withColumn("rest", F.col("component") != F.col("largest")))

    def parts(rows: DataFrame, name: str, docs: int, shingles: int) -> DataFrame:
        by = F.greatest(F.ceil(F.count("*") / docs), F.ceil(F.sum("n") / shingles))
        return rows.groupBy("family").agg(by.cast("int").alias(name))

    counted = parts(held.where("rest"), "rests", REST_ROWS, REST_SHINGLES).join(parts(held, "alls", ALL_ROWS, ALL_SHINGLES), "family")
    dealt = held.join(counted.withColumn("salt", salts), ["family", "salt"])
    own = F.xxhash64("node")
    rest = dealt.where("rest").select(
        "family", "node", "component", F.pmod(own, "rests").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("alls") - 1)).alias("m"), F.lit(0).alias("side")
    )
    whole = dealt.select(
        "family", "node", "component", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("r"), F.pmod(own, "alls").cast("int").alias("m"), F.lit(1).alias("side")
    )
    blocks_ = rest.unionAll(whole.select(rest.columns)).join(sets, F.col("node") == F.col("doc_id"))
    blocks_ = blocks_.select("family", "r", "m", "doc_id", "component", "shingles", "side").repartition("family", "r", "m")
    links = blocks_.groupBy("family", "r", "m").applyInArrow(_block_links(over, under), "a long, b long")
    return keep(links.distinct())


def _block_links(over: int, under: int):
    """For applyInArrow: two sides of documents to links between them, one per document and component."""

    def rows(table: pa.Table) -> pa.Table:
        side = np.asarray(table["side"])
        doc, component = np.asarray(table["doc_id"]), np.asarray(table["component"])
        shingles = table["shingles"].combine_chunks() if table.num_rows else []
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in shingles]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        word, place = np.unique(np.concatenate(sets), return_inverse=True)
        # only what stands on both sides can be common
        shared = np.zeros(len(word), np.int8)
        for bit, own in ((1, left), (2, right)):
            here = np.zeros(len(sets), bool)
            here[own] = True
            shared[place[here[owner]]] |= bit
        number = np.cumsum(shared == 3) - 1
        useful = shared[place] == 3
        column, owner = number[place[useful]], owner[useful]
        row = np.zeros(len(sets), np.int64)
        row[left], row[right] = np.arange(len(left)), np.arange(len(right))
        on_left = side[owner] == 0
        common = np.zeros((len(left), len(right)), np.float32)
        for first in range(0, int(number[-1]) + 1, 2048):
            some = (column >= first) & (column < first + 2048)
            x, y = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
            x[row[owner[some & on_left]], column[some & on_left] - first] = 1
            y[row[owner[some & ~on_left]], column[some & ~on_left] - first] = 1
            common += x @ y.T
        total = size[left][:, None] + size[right][None, :]
        i, j = np.nonzero(common.astype(np.int64) * (under + over) >= over * total)
        a, b = doc[left[i]], doc[right[j]]
        c = component[right[j]]
        differs = component[left[i]] != c
        a, b, c = a[differs], b[differs], c[differs]
        _, once = np.unique(np.stack([a, c]), axis=1, return_index=True)
        return pa.table({"a": np.minimum(a, b)[once], "b": np.maximum(a, b)[once]})

    return rows


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: tuple[int, int] = (80, 100),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` without those that another row of their group stands for."""
    found = near_duplicates(docs, shingle, percent, doc_id, text)
    gone = keep(found.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, docs[doc_id].cast("long") == gone["gone"], "left_anti")
