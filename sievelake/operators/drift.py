"""How the files of a batch differ from the profile's schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.profiles import TRIPS, Profile
from sievelake.sources.schemas import KINDS, fits
from sievelake.sources.small import small_frame

#: Why a batch is refused, in the order in which reasons are given.
REFUSALS = ("unreadable", "missing", "unfit", "doubled")
REPORT = ("missing", "absent", "added", "respelled", "widened", "unfit", "doubled", "unreadable")


def _text(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(names)), ", ")


def schema_drift(columns: DataFrame, profile: Profile = TRIPS, cast: bool = False) -> DataFrame:
    """One row per batch: `accepted`, and as sorted lists of names

    missing: required columns that not every readable file has; absent: optional columns of which that holds; added: columns unknown to the
    profile; respelled: those that have a canonical name at once; widened: types that fit the table's; unfit: types
    that do not; doubled: canonical names that two columns of a file share; unreadable: what kept files from being read.

    `columns` is a listing of files' columns with the `batch_id` they belong to. Names are compared case-sensitively. With
    `cast` columns take the table's type when they are read, so none is unfit.
    """
    spark = columns.sparkSession
    kinds = dict(profile.columns)
    canonical = {**{c: c for c, _ in profile.columns}, **profile.renames}
    known = [(n, c, kinds.get(c), n not in profile.renames) for n, c in canonical.items()]
    names = small_frame(spark, known, "name STRING, canonical STRING, wanted STRING, respelled BOOLEAN")
    pairs = [(found, wanted) for found in KINDS for wanted in sorted(set(kinds.values())) if fits(found, wanted)]
    fit = small_frame(spark, pairs, "kind STRING, wanted STRING").withColumn("fits", F.lit(True))

    readable = F.count_distinct(F.when(F.col("error").isNull(), F.col("path")))
    files = columns.groupBy("batch_id").agg(
        F.count_distinct("path").alias("n_files"), readable.alias("n_readable"), F.collect_set("error").alias("errors")
    )
    named = columns.where("name IS NOT NULL").join(names, "name", "left")
    named = named.withColumn("own", F.coalesce("canonical", "name"))

    def everywhere(by: str, alias: str) -> DataFrame:
        """Names that every file of a batch has, be it in different types."""
        found = named.groupBy("batch_id", by).agg(F.count_distinct("path").alias("n")).join(files.select("batch_id", "n_readable"), "batch_id")
        return found.where("n = n_readable").groupBy("batch_id").agg(F.collect_set(by).alias(alias))

    twice = named.groupBy("batch_id", "path", F.lower("own").alias("low")).agg(F.count("*").alias("n")).where("n > 1")
    twice = twice.groupBy("batch_id").agg(F.collect_set("low").alias("doubled"))
    told = named.select("batch_id", "name", "canonical", "kind", "wanted", "respelled").distinct().join(fit, ["kind", "wanted"], "left")
    differs = F.col("wanted").isNotNull() & (F.col("wanted") != F.col("kind"))
    label = F.concat_ws(" ", "canonical", "kind")
    misfit = F.lit(False) if cast else F.col("fits").isNull()

    def those(condition: Column, value: Column) -> Column:
        return F.collect_set(F.when(condition, value))

    sorts = told.groupBy("batch_id").agg(
        those(F.col("canonical").isNull(), F.col("name")).alias("added"),
        those(F.col("respelled"), F.col("name")).alias("respelled"),
        those(differs & ~misfit, label).alias("widened"),
        those(differs & misfit, label).alias("unfit"),
    )
    both = files
    for part in (everywhere("name", "names"), everywhere("own", "owns"), sorts, twice):
        both = both.join(part, "batch_id", "left")
    none = F.array().cast("array<string>")
    held = {c: F.coalesce(c, none) for c in ("names", "owns", "added", "respelled", "widened", "unfit", "doubled", "errors")}
    required, needed = list(profile.required), {profile.renames.get(n, n) for n in profile.required}
    optional = [c for c, _ in profile.columns if c not in needed]

    def without(wanted: list[str], there: str) -> Column:
        listed = F.array_except(F.array(*map(F.lit, wanted)), held[there])
        return _text(F.when(F.col("n_readable") > 0, listed).otherwise(none))

    out = both.select(
        "batch_id",
        "n_files",
        without(required, "names").alias("missing"),
        without(optional, "owns").alias("absent"),
        *[_text(held[name]).alias(name) for name in ("added", "respelled", "widened", "unfit", "doubled")],
        _text(held["errors"]).alias("unreadable"),
    )
    refused = F.lit(False)
    for reason in REFUSALS:
        refused = refused | (F.col(reason) != "")
    return out.withColumn("accepted", ~refused)


def refusal(row) -> str:
    """Why a batch of a drift report is refused."""
    said = {
        "unreadable": "unreadable source",
        "missing": "missing required columns",
        "unfit": "columns whose type does not fit the table's",
        "doubled": "columns that share a name",
    }
    return "; ".join(f"{said[reason]}: {row[reason]}" for reason in REFUSALS if row[reason])
