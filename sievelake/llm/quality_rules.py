"""Quality rules with adaptive thresholds per language and source, in DataFrame functions only.

Each document is measured by a few ratios in thousandths. Per (lang, source) every measure is kept in a
quantile sketch: counts of logarithmic bins of base `GAMMA`, which locate any quantile with a relative
error of at most (GAMMA - 1) / 2. Sketches merge by adding counts, in any order, with the same
result; so Spark sums them on the map side, and a group of fewer than `MIN_GROUP` documents takes
the merged sketch of its language, or that of all documents. A document fails a measure when it lies
above upper quartile + REACH * (upper - lower quartile) + the measure's slack, its group's own fence.
The fences, a row per group and measure, are joined back to the documents.

Defined cases: null or empty text measures 0 everywhere and has no words, so it fails the base rule; null
lang and source are the value ''; an empty table gives an empty result; rows of equal doc_id are
judged one by one; extra columns are carried by `keep_good`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep
from sievelake.llm.text import SPACE, WORD, fresh

GAMMA = 1.04
REACH = 6.0
MIN_GROUP = 200
#: Measure: thousandths that its fence has on top.
SLACK = {"symbols": 60, "dup_lines": 300, "repeats": 150, "word_length": 2500, "capitals": 300, "bars": 60}
REPEAT_WINDOW = 8


def repeated_words(words: Column) -> Column:
    """Words within windows of eight that occur twice or more in the text.

    Texts whose window hashes are all distinct, nearly all, are done at that. In the others, windows are
    sorted by hash to find those with an equal neighbour; what they cover is summed in order of place.
    """
    n = REPEAT_WINDOW
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(words, i, n)),
    )
    sorted_ = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        twin = F.filter(
            s,
            lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]),
        )
        return F.array_sort(F.transform(twin, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n))).cast("long")
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def once(value: Column, use) -> Column:
        """`use` of a value that is worked out a single time."""
        return F.element_at(F.transform(F.array(value), use), 1)

    exact = once(sorted_, lambda s: once(places(s), covered))
    alike = F.size(F.array_distinct(windows)) < F.size(words) - (n - 1)
    return F.when((F.size(words) > n) & alike, exact).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    """doc_id, lang, source and the counts that base rules and measures are made of."""
    some = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        some.alias("text"),
        F.regexp_extract_all(some, F.lit(WORD), 0).alias("words"),
        F.filter(F.split(some, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    return read.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(r"\|")).cast("long").alias("n_bars"),
    )


def measures() -> dict[str, Column]:
    def rate(count: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.floor(F.col(count) * 1000 / F.col(of))).otherwise(0).cast("long")

    return {
        "symbols": rate("n_symbols", "n_words"),
        "dup_lines": rate("n_dup_lines", "n_lines"),
        "repeats": rate("n_repeat_words", "n_words"),
        "word_length": rate("word_chars", "n_words"),
        "capitals": rate("n_capitals", "word_chars"),
        "bars": rate("n_bars", "n_words"),
    }


def bin_of(value: Column) -> Column:
    """0 for 0; else the number of the logarithmic bin, from 1."""
    return F.when(value <= 0, 0).otherwise(F.ceil(F.ln(value) / F.lit(math.log(GAMMA))) + 1).cast("long")


def middle_of(bin_: Column) -> Column:
    """The value that stands for a bin."""
    return F.when(bin_ == 0, 0.0).otherwise(F.pow(F.lit(GAMMA), bin_ - 1) * (2 / (1 + GAMMA)))


def sketches(rated: DataFrame) -> DataFrame:
    """lang, source, measure, bin, n: one sketch for each of the first three."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in SLACK])
    return (
        rated.select("lang", "source", F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.measure", "p.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fences(base: DataFrame) -> DataFrame:
    """level (0 group, 1 language, 2 all), lang, source, and one fence per measure, of groups large enough."""
    levels = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        names = {k: (F.col(k) if k in keys else F.lit(None).cast("string")) for k in ("lang", "source")}
        merged = base.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
        steps = merged.groupBy(*keys, "measure").agg(
            F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total")
        )

        def quantile(q: float) -> Column:
            need = F.ceil(F.col("total") * F.lit(q))
            walk = F.aggregate(
                "bins",
                F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("bin")),
                lambda acc, x: F.struct(
                    (acc["sum"] + x["n"]).alias("sum"),
                    F.when((acc["bin"] < 0) & (acc["sum"] + x["n"] >= need), x["bin"])
                    .otherwise(acc["bin"])
                    .alias("bin"),
                ),
            )
            return middle_of(walk["bin"])

        slack = F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair])
        fence = F.col("q3") + REACH * (F.col("q3") - F.col("q1")) + F.element_at(slack, F.col("measure"))
        levels.append(
            steps.withColumn("q1", quantile(0.25))
            .withColumn("q3", quantile(0.75))
            .where((F.col("total") >= MIN_GROUP) | F.lit(level == 2))
            .select(*[c.alias(n) for n, c in names.items()], "measure", fence.alias("fence"))
            .groupBy("lang", "source")
            .agg(*[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(m) for m in SLACK])
            .select(F.lit(level).alias("level"), "lang", "source", *SLACK)
        )
    return levels[0].unionAll(levels[1]).unionAll(levels[2])


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Per row of `docs`: doc_id, counts, base_failed, failed (names of failed measures), kept.

    Texts are read once: counts are written as a table, from which sketches, fences and verdicts are made.
    The join spreads by (lang, source); a hot pair's documents are split by Spark, as the pair has one row
    of fences; languages and the whole are joined likewise.
    """
    counts = keep(measured(docs, doc_id, text, lang, source))
    rated = counts.select("*", *[c.alias(m) for m, c in measures().items()])
    found = keep(fences(sketches(rated)))
    out = rated
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        of_level = found.where(F.col("level") == level).select(
            *keys, F.struct(*[F.col(m) for m in SLACK]).alias(f"fence{level}")
        )
        if keys:
            out = out.join(of_level, keys, "left")
        else:
            row = of_level.first()
            whole = row[0].asDict() if row else dict.fromkeys(SLACK)
            out = out.withColumn(
                "fence2", F.struct(*[F.lit(whole[m]).cast("double").alias(m) for m in SLACK])
            )
    fence = F.coalesce("fence0", "fence1", "fence2")
    failed = F.array_compact(
        F.array(*[F.when(F.col(m) > fence[m], F.lit(m)) for m in SLACK])
    )
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        failed.alias("failed"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )
