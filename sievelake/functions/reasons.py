"""Reason codes and severity of a row, as Column expressions.

Each code adds a one-element or an empty array and the arrays are concatenated.
That keeps rule order, yields `[]` and never null, and stays inside whole-stage
code generation, which a lambda (`filter`, `array_compact`) would leave. Clean
rows, nearly all of them, skip the concatenation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievelake.profiles import QUARANTINE, VALID, WARNING, Profile, Rule


def fires(rule: Rule) -> Column:
    return F.expr(rule.fires_when)


def any_fires(rules: Sequence[Rule]) -> Column:
    """True when at least one rule fires; null or false otherwise."""
    return reduce(or_, [fires(rule) for rule in rules], F.lit(False))


def fired_codes(rules: Sequence[Rule]) -> Column:
    none = F.array().cast("array<string>")
    if not rules:
        return none
    each = [F.when(fires(rule), F.array(F.lit(rule.code))).otherwise(none) for rule in rules]
    return F.when(any_fires(rules), F.concat(*each)).otherwise(none)


def validation_status(profile: Profile) -> Column:
    """Worst severity that fired. Read off the predicates, so counts never build the arrays."""
    return (
        F.when(any_fires(profile.rules_of(QUARANTINE)), F.lit(QUARANTINE))
        .when(any_fires(profile.rules_of(WARNING)), F.lit(WARNING))
        .otherwise(F.lit(VALID))
    )
