"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as their words (white space as in str.split) in lower case, joined by single blanks. A test
item of length L may differ from a passage by k = floor(L * error_rate) edits. Cut into k + 1 pieces, at least
one piece then stands unchanged in the passage: so all pieces are looked for exactly, in one pass over the
text, and around each hit the item is verified with Myers' bit-parallel edit distance, whose ends in
the text are free. Windows of one item that overlap are merged first, so that the work on an item is
at most in proportion to the text.

Items are dealt into blocks of about `block_chars` characters; a block goes to the executors as a broadcast
of that bounded size, documents are read once per block, and only matches are written. Texts
are taken whole.

Defined cases: items that are null or have no word match nothing; items of equal text are one, reported under
the smallest item_id; an item shorter than 1 / error_rate characters has to occur exactly; a
null text has no match; a null doc_id is reported as null, and rows with it stay in `drop_contaminated`;
rows of equal doc_id are one document; empty tables give empty results; extra columns are carried.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import folder, keep

ERROR_RATE = 0.05
BLOCK_CHARS = 2_000_000
_FOUND = "doc_id long, item_id long, distance long, budget long, end long, passages long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces (place, text) that make up the item, of lengths that differ by one at most."""
    bounds = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


class Pattern:
    """Myers' bit-parallel matching; Python's integers take patterns of any length."""

    def __init__(self, item: str):
        self.length = len(item)
        self.high = 1 << (self.length - 1)
        self.mask = (1 << self.length) - 1
        self.places: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.places[c] |= 1 << i
        self.places.default_factory = None

    def passages(self, text: str, begin: int, stop: int, budget: int):
        """(distance, end) of each run of ends at most `budget` edits away: the best one, the first of equals."""
        plus, minus, distance = self.mask, 0, self.length
        high, mask, places = self.high, self.mask, self.places
        best: tuple[int, int] | None = None
        for at in range(begin, stop):
            hits = places.get(text[at], 0)
            across = (((hits & plus) + plus) ^ plus) | hits | minus
            up = minus | ~(across | plus) & mask
            down = plus & across
            if up & high:
                distance += 1
            elif down & high:
                distance -= 1
            up <<= 1
            down <<= 1
            plus = (down | ~(hits | minus | up)) & mask
            minus = up & (hits | minus) & mask
            if distance <= budget:
                if best is None or distance < best[0]:
                    best = (distance, at + 1)
            elif best is not None:
                yield best
                best = None
        if best is not None:
            yield best


class Matcher:
    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        import ahocorasick

        self.items = [(item_id, item, int(len(item) * error_rate)) for item_id, item in items]
        self.patterns: dict[int, Pattern] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, item, budget) in enumerate(self.items):
            for at, piece in pieces(item, budget):
                places[piece].append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str):
        """(item number, best distance, its end, passages) of each item found in a normalised text."""
        if not self.items:
            return
        windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (length, where) in self.automaton.iter(text):
            start = end - length + 1
            for number, at in where:
                _, item, budget = self.items[number]
                first = max(0, start - at - budget)
                stop = min(len(text), start - at + len(item) + budget)
                own = windows[number]
                if own and first <= own[-1][1] and first >= own[-1][0]:
                    own[-1] = (own[-1][0], max(own[-1][1], stop))
                else:
                    own.append((first, stop))
        for number, own in windows.items():
            _, item, budget = self.items[number]
            pattern = self.patterns.setdefault(number, Pattern(item))
            found: list[tuple[int, int]] = []
            merged: list[list[int]] = []
            for first, stop in sorted(own):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([first, stop])
            for first, stop in merged:
                found.extend(pattern.passages(text, first, stop, budget))
            if found:
                yield number, *min(found), len(found)


def finder(items, error_rate: float):
    """For mapInArrow: (doc_id, text) to one row per document and item found. `items` is a broadcast."""

    def rows(batches):
        matcher = Matcher(items.value, error_rate)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for number, distance, end, passages in matcher.matches(normal(text.as_py())):
                    item_id, _, budget = matcher.items[number]
                    out.append((doc_id, item_id, distance, budget, end, passages))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "item_id", "distance", "budget", "end", "passages"],
            )

    return rows


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance of the best passage, budget, its end in the normalised text, passages found."""
    spark = docs.sparkSession
    items = keep(
        benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
        .where("text IS NOT NULL")
        .groupBy("text")
        .agg(F.min("item_id").alias("item_id"))
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-chars // block_chars))
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    target = folder(spark)
    for block in range(count):
        mine = items.where(F.pmod(F.crc32(F.encode("text", "UTF-8")), F.lit(count)) == block)
        part = [(row["item_id"], normal(row["text"])) for row in mine.collect()]
        held = spark.sparkContext.broadcast([x for x in part if x[1]])
        found = read.mapInArrow(finder(held, error_rate), _FOUND)
        found.distinct().write.mode("append").parquet(target)
    return spark.read.schema(_FOUND).parquet(target)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` in which no test item is found."""
    found = contaminated(docs, benchmark, doc_id=doc_id, **options)
    gone = keep(found.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, docs[doc_id].cast("long") == gone["gone"], "left_anti")
