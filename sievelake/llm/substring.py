"""Substring dedup by hashing units of text.

A text is cut into units, in several ways at once: into lines, into paragraphs (lines up to an empty one), and into
the sentences of its lines. A unit is normalised to its words in ASCII lower case joined by single blanks, and known by
its kind and 128 bits of hash. Of all equal units of a kind the earliest by (doc_id, start) stays; the rest is to be removed, with
its offsets in the original text. What a text loses is the union of its units' spans.

Lines and paragraphs count from one word on. Passages that repeat across documents often stand inside a line, where neither
of them sees them; sentences do, of which those of fewer than five words are left alone, as they repeat by chance.
`units` names the kinds and the least words of each.

Defined cases: a null or empty text has no units; a null doc_id ranks last; rows of equal doc_id and text
are one document; extra columns are not looked at.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep
from sievelake.llm.text import WORD

#: Each pattern's matches, put together, are the whole text.
UNITS = {
    "sentence": r"[^\n.!?]*[.!?]+[ \t]*\n?|[^\n.!?]+\n?|\n",
    "line": r"[^\n]*\n|[^\n]+",
    "paragraph": r"(?:[^\n]+\n?)+\n*|\n+",
}
#: Kinds of units, with the least words of each.
DEFAULT = {"line": 1, "paragraph": 1, "sentence": 5}
KINDS = list(UNITS)
SCHEMA = "kind int, doc long, content long, start int, end int, words int, a long, b long"
_BATCH = 100_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def cut(units: dict[str, int]):
    """For mapInPandas: (doc, content, text) to one row per unit."""
    kinds = [(KINDS.index(kind), re.compile(UNITS[kind]), least) for kind, least in units.items()]
    word = re.compile(WORD)
    mask = (1 << 64) - 1

    def rows(doc, content, text):
        lower = text.encode("utf-8", "replace").lower().decode("utf-8")
        for kind, pattern, least in kinds:
            for m in pattern.finditer(lower):
                words = word.findall(m[0])
                if len(words) >= max(least, 1):
                    digest = xxhash.xxh3_128_intdigest(" ".join(words))
                    yield kind, doc, content, m.start(), m.end(), len(words), _signed(digest & mask), _signed(digest >> 64)

    def batches(frames):
        out = []
        for frame in frames:
            ids = frame["doc"].astype("object").where(frame["doc"].notna(), None)
            for doc, content, text in zip(ids, frame["content"], frame["text"]):
                for row in rows(None if doc is None else int(doc), content, text or ""):
                    out.append(row)
                    if len(out) >= _BATCH:
                        yield _frame(out)
                        out = []
        yield _frame(out)

    return batches


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["kind", "doc", "content", "start", "end", "words", "a", "b"]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({n: "Int64" if n == "doc" else "int64" for n in names})


def _rank(*parts: Column) -> Column:
    doc, content, start = parts
    return F.struct(
        doc.isNull().alias("unknown"), doc.alias("doc"), content.alias("content"), start.alias("start")
    )


def repeated_units(docs: DataFrame, units: dict[str, int] = DEFAULT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit to remove: unit (its kind), doc_id, start and end (code points), n_words, and the kept first_doc_id, first_start.

    Units are cut once and written. Digests are grouped with partial minima; the join back meets only
    digests found twice or more, one row each, so that Spark can split a hot digest's units.
    """
    read = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("content"), F.col(text).alias("text")
    )
    found = keep(read.mapInPandas(cut(units), SCHEMA))
    rank = _rank(F.col("doc"), F.col("content"), F.col("start"))
    first = (
        found.groupBy("kind", "a", "b")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return (
        found.join(first, ["kind", "a", "b"])
        .where(rank > F.col("first"))
        .select(
            F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1).alias("unit"),
            F.col("doc").alias("doc_id"),
            F.col("content"),
            F.col("start").cast("long").alias("start"),
            F.col("end").cast("long").alias("end"),
            F.col("words").cast("long").alias("n_words"),
            F.col("first.doc").alias("first_doc_id"),
            F.col("first.start").cast("long").alias("first_start"),
        )
    )


def _union(spans: Column) -> Column:
    """Sorted spans (start, end), those that touch or overlap made one."""
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def with_next(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        return F.when((F.size(done) > 0) & (last["end"] >= span["start"]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, none, with_next)


def drop_repeated_units(docs: DataFrame, units: dict[str, int] = DEFAULT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the spans of the repeated units; all rows and columns stay. A text that loses all becomes empty."""
    removed = (
        repeated_units(docs, units, doc_id, text)
        .groupBy(F.col("doc_id").alias("doc"), "content")
        .agg(_union(F.array_sort(F.collect_set(F.struct("start", "end")))).alias("spans"))
    )
    names, text_of = docs.columns, F.col(f"row.`{text}`")
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    joined = whole.join(
        removed,
        F.col(f"row.`{doc_id}`").cast("long").eqNullSafe(F.col("doc")) & (F.xxhash64(text_of) == F.col("content")),
        "left",
    )
    zero = F.array(F.lit(0).cast("long"))
    begins = F.concat(zero, F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text_of).cast("long")))
    pieces = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda p: text_of.substr((p["b"] + 1).cast("int"), (p["e"] - p["b"]).cast("int")),
    )
    left = F.when(F.col("spans").isNull(), text_of).otherwise(F.array_join(pieces, ""))
    return joined.select(*[(left if n == text else F.col(f"row.`{n}`")).alias(n) for n in names])
