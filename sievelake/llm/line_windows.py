"""Line dedup by overlapping windows of three lines.

A line is what stands between line feeds; lines without a word are passed over but keep their number.
Lines are compared in ASCII lower case with white space runs as one blank. Three consecutive lines make
a window, known by 128 bits of hash. Of all equal windows the earliest by (doc_id, line) stays; the
lines of every later one are covered, and lines covered by any window are removed.

Defined cases: a null or empty text has no lines; texts of fewer than three lines have no windows and
stay whole; a null doc_id ranks after all others; rows of equal doc_id and text are one document, so
they stand or fall together; columns other than the two named are carried and may have any name.
All of it is DataFrame functions, no Python; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep
from sievelake.llm.text import SPACE, WORD, ascii_lower, fresh

WINDOW = 3


def _numbered(text: Column) -> Column:
    """The lines with a word, each with its number and two hashes of its normalised form."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))
    inked = F.filter(lines, lambda x: x["line"].rlike(WORD))

    def hashed(x: Column) -> Column:
        plain = F.trim(F.regexp_replace(ascii_lower(x["line"]), SPACE, " "))
        return F.struct(x["no"].alias("no"), F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(7), plain).alias("b"))

    return F.transform(inked, hashed)


def _windows(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    read = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.col(text)).alias("content"),
        _numbered(F.col(text)).alias("lines"),
    )

    def window(i: Column) -> Column:
        run = F.slice("lines", i + 1, size)
        return F.struct(
            F.transform(run, lambda x: x["no"]).alias("covers"),
            F.xxhash64(F.transform(run, lambda x: x["a"])).alias("a"),
            F.xxhash64(F.transform(run, lambda x: x["b"])).alias("b"),
        )

    counted = read.where(F.size("lines") >= size)
    every = F.transform(F.sequence(F.lit(0), F.size("lines") - size), window)
    return counted.select("doc", "content", F.explode(every).alias("w")).select(
        "doc", "content", "w.covers", "w.a", "w.b"
    )


def _rank(window: DataFrame) -> Column:
    """Earliest first; nulls last."""
    return F.struct(
        window["doc"].isNull().alias("unknown"),
        window["doc"].alias("doc"),
        window["content"].alias("content"),
        window["covers"][0].alias("line"),
    )


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """Per document with repeats: doc, content (hash of the text), `covered`: sorted numbers of its lines to remove.

    Windows are hashed once and written. They are counted with partial sums on the map side. The join back sees the groups that occur
    more than once only; Spark splits a hot group's side, as the other side has one row for it.
    """
    windows = keep(_windows(docs, doc_id, text, size))
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(_rank(windows)).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    later = windows.join(first, ["a", "b"]).where(_rank(windows) > F.col("first"))
    return (
        later.select("doc", "content", F.explode("covers").alias("line"))
        .groupBy("doc", "content")
        .agg(F.array_sort(F.collect_set("line")).alias("covered"))
    )


def spans(covered: Column) -> Column:
    """Covered line numbers merged into runs [first, last]."""
    opens = F.filter(covered, lambda x: ~F.array_contains(covered, x - 1))
    closes = F.filter(covered, lambda x: ~F.array_contains(covered, x + 1))
    return F.arrays_zip(opens.alias("first_line"), closes.alias("last_line"))


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """`docs` with the covered lines taken out of the text; all rows and columns stay."""
    key, content, covered = (fresh(docs, x) for x in ("doc_key", "content_key", "covered_lines"))
    found = repeated_lines(docs, doc_id, text, size).toDF(key, content, covered)
    joined = docs.join(
        found,
        docs[doc_id].eqNullSafe(found[key]) & (F.xxhash64(docs[text]) == found[content]),
        "left",
    )
    rest = F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.col(covered), i))
    cleaned = F.when(F.col(covered).isNull(), F.col(text)).otherwise(F.array_join(rest, "\n"))
    return joined.withColumn(text, cleaned).select(*docs.columns)
