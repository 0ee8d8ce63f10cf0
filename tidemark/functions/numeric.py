"""Numeric expressions: bins, guarded ratios, scores, loan delinquency."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.rules import RiskRule, RiskTerm


def fixed_bin(c: Column, ceilings: Sequence[float]) -> Column:
    """1-based group by left-closed edges; the last group is open and NULL stays NULL."""
    steps = [(c >= F.lit(edge)).cast("int") for edge in ceilings]
    return reduce(add, steps) + F.lit(1)


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)


def log1p_if_non_negative(c: Column) -> Column:
    return F.when(c >= 0, F.log1p(c))


def risk_term(term: RiskTerm) -> Column:
    c = F.col(term.column)
    hit = {
        ">": lambda: c > F.lit(term.threshold),
        "<": lambda: c < F.lit(term.threshold),
        "in": lambda: c.isin(*term.threshold),
    }[term.op]()
    return F.when(hit, F.lit(term.points)).otherwise(F.lit(0))


def risk_score(rule: RiskRule = RiskRule()) -> Column:
    """Sum of the rule's points; a NULL input scores zero."""
    return reduce(add, [risk_term(t) for t in rule.terms])


def missed_installments(overdue: Column, due: Column) -> Column:
    """Whole instalments behind; nothing due or NULL counts as none."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))
