"""Rule sets as data: a flag, the words for a person, and a predicate in SQL."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

PREDICATE, REFERENCE, DUPLICATE = "predicate", "reference", "duplicate"

# What becomes of a row when no rule is true but one of them is null.
NULL_PASSES, NULL_DROPS = "pass", "drop"


@dataclass(frozen=True)
class Rule:
    flag: str
    message: str
    predicate: str = ""
    kind: str = PREDICATE
    column: str = ""
    reference: str = ""

    def test(self, as_of: datetime) -> Column:
        """The flag as an expression; ``{now}`` in a predicate stands for the given time."""
        return F.expr(self.predicate.replace("{now}", f"timestamp'{as_of:%Y-%m-%d %H:%M:%S.%f}'"))


@dataclass(frozen=True)
class RuleSet:
    """Everything needed to turn one all-string source into valid and faulty rows.

    Rules are listed in the order in which their messages are joined.
    """

    source: str
    key: str
    casts: Mapping[str, str]
    rules: tuple[Rule, ...]
    null_verdict: str = NULL_PASSES
    rank: str = "_duplicate_rank"
    clean_drops: tuple[str, ...] = ("_duplicate_rank", "quarantine_reason")
    late_columns: Mapping[str, str] = field(default_factory=dict)
    newest_by: str = "_ingested_at_utc"
    # The business date by which a growing source is kept, if it is judged load by load.
    day: str = ""

    @property
    def flags(self) -> list[str]:
        return [rule.flag for rule in self.rules]

    @property
    def duplicate_flag(self) -> str:
        return next(rule.flag for rule in self.rules if rule.kind == DUPLICATE)

    @property
    def clock_flags(self) -> list[str]:
        """Flags whose outcome changes as time passes."""
        return [rule.flag for rule in self.rules if "{now}" in rule.predicate]

    def of_kind(self, kind: str) -> list[Rule]:
        return [rule for rule in self.rules if rule.kind == kind]


def blank(column: str) -> Rule:
    return Rule(f"is_missing_{column}", f"Missing {column}", f"{column} is null or {column} = ''")


def absent(column: str, message: str | None = None, flag: str | None = None) -> Rule:
    return Rule(flag or f"is_missing_{column}", message or f"Missing {column}", f"{column} is null")


def outside(column: str, accepted: tuple[str, ...]) -> Rule:
    values = ", ".join(f"'{v}'" for v in accepted)
    return Rule(f"is_invalid_{column}", f"Invalid {column}", f"{column} not in ({values})")


def unknown(column: str, reference: str) -> Rule:
    return Rule(
        f"is_unknown_{column}",
        f"{column} does not exist in {reference}",
        kind=REFERENCE,
        column=column,
        reference=reference,
    )


def duplicate(column: str, flag: str | None = None) -> Rule:
    return Rule(flag or f"is_duplicate_{column}", f"Duplicate {column}", kind=DUPLICATE, column=column)
