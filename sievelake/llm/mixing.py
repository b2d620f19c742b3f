"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The cells' token sums are raked in turn until
the sums by source, by language and by topic meet their targets; the ratio of raked to observed tokens is
a cell's weight. Documents are then drawn by Poisson sampling: each one stays with its cell's
calibrated probability min(1, c * weight), c being such that the expected tokens are `fraction` of
all, and the draw is a hash of doc_id, so that it is the same wherever and however often it is made.

Targets are shares by value. Those not given are tempered: observed share to the power `alpha`, scaled to
one, which lifts small values and lowers a hot one. All statistics cover all rows: rows are
reduced to cells on the map side, and raking works on the table of cells, which stays in Spark.

Defined cases: null source, language or topic is the value '' ; null tokens count as 0; a null doc_id
draws like the text ''; a cell without tokens keeps weight 1; targets naming absent values are
scaled over those present; an empty table gives an empty result; extra columns are carried.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep
from sievelake.llm.text import WORD, fresh

ROUNDS = 10
ALPHA = 0.7
FRACTION = 0.9
MARGINS = ("source", "lang", "topic")


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """Documents carry no topic; this one tells forms of text apart, by what their lines look like."""
    some = F.coalesce(text, F.lit(""))
    return (
        F.when(F.regexp_count(some, F.lit(r" \| ")) >= 5, "list")
        .when(F.regexp_count(some, F.lit("[#*$%&<>{}]")) >= 20, "symbols")
        .when(F.lower(some).contains("licens"), "licensed")
        .when(F.length(some) < 600, "short prose")
        .otherwise("prose")
    )


def draw_of(doc_id: Column) -> Column:
    """A number in [0, 1) from 32 bits of the id's MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def _targets(cells: DataFrame, margin: str, given: Mapping[str, float] | None, alpha: float) -> DataFrame:
    """margin value, `target`: tokens it shall have; in sum the tokens there are."""
    seen = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("seen")).where("seen > 0")
    if given:
        listed = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
        wish = F.coalesce(F.element_at(listed, F.col(margin)).cast("double"), F.lit(0.0))
    else:
        wish = F.pow("seen", F.lit(alpha))
    wished = seen.select(margin, "seen", wish.alias("wish"))
    total = wished.agg(F.sum("seen").alias("all"), F.sum("wish").alias("wishes")).first()
    scale = (total["all"] or 0.0) / (total["wishes"] or 1.0)
    return keep(wished.select(margin, (F.col("wish") * F.lit(scale)).alias("target")))


def raked_cells(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    alpha: float = ALPHA,
    rounds: int = ROUNDS,
) -> DataFrame:
    """source, lang, topic, tokens, weight. `cells` has the first four, one row each.

    A step is a sum by one margin (partial sums first) joined back to the cells. Both read the table that the
    step before has written, so that every plan is as small as the first.
    """
    goals = {m: _targets(cells, m, (targets or {}).get(m), alpha) for m in MARGINS}
    state = keep(cells.withColumn("raked", F.col("tokens").cast("double")))
    for _ in range(rounds):
        for margin in MARGINS:
            sums = state.groupBy(margin).agg(F.sum("raked").alias("now"))
            factor = sums.join(goals[margin], margin).select(
                margin, F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(1.0).alias("factor")
            )
            scaled = F.col("raked") * F.coalesce("factor", F.lit(1.0))
            state = keep(state.join(factor, margin, "left").select(*MARGINS, "tokens", scaled.alias("raked")))
    weight = F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(1.0)
    return state.select(*MARGINS, "tokens", weight.alias("weight"))


def calibrated(cells: DataFrame, fraction: float = FRACTION, turns: int = 8) -> DataFrame:
    """Adds `probability`. Each turn gives what cells at probability 1 cannot take to the others."""
    scale = fraction
    for _ in range(turns):
        full = F.col("weight") * F.lit(scale) >= 1
        row = cells.agg(
            F.sum("tokens").alias("all"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("weight"))).alias("rest"),
        ).first()
        if not row["rest"]:
            break
        scale = (fraction * row["all"] - row["full"]) / row["rest"]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    alpha: float = ALPHA,
    fraction: float = FRACTION,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    tokens: Column | None = None,
) -> DataFrame:
    """`docs` with struct column `mix` (or `mix_`, ...): topic, tokens, weight, probability, draw, selected."""
    name = fresh(docs, "mix")
    topic = topic_of(F.col(text)) if topic is None else F.coalesce(topic, F.lit(""))
    tokens = tokens_of(F.col(text)) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))
    key = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (source, lang)]
    cells = keep(
        docs.select(key[0].alias("source"), key[1].alias("lang"), topic.alias("topic"), tokens.alias("tokens"))
        .groupBy(*MARGINS)
        .agg(F.sum("tokens").alias("tokens"))
    )
    fitted = calibrated(raked_cells(cells, targets, alpha), fraction)
    fitted = keep(fitted.select(F.struct(*MARGINS).alias("cell"), "weight", "probability"))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct(key[0].alias("source"), key[1].alias("lang"), topic.alias("topic")).alias("of"),
        tokens.alias("tokens"),
        draw_of(F.col(doc_id)).alias("draw"),
    )
    joined = row.join(fitted, F.col("of") == F.col("cell"), "left")
    mixed = F.struct(
        F.col("of.topic").alias("topic"),
        "tokens",
        "weight",
        "probability",
        "draw",
        (F.col("draw") < F.col("probability")).alias("selected"),
    )
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], mixed.alias(name))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix selects, with the columns of `docs`."""
    name = fresh(docs, "mix")
    return mix(docs, **options).where(F.col(f"`{name}`.selected")).select(*[f"`{c}`" for c in docs.columns])
