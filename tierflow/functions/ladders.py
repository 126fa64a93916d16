"""First-match decision ladders kept as rule text and bound to any column names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ladder:
    """Ordered (label, predicate) steps with a default label.

    A predicate that is null does not match, so a missing value falls through to
    the later steps.
    """

    steps: tuple[tuple[str, str], ...]
    default: str

    @classmethod
    def from_text(cls, text: str) -> Ladder:
        """One `label: predicate` line per step; the last line holds the default label."""
        *steps, default = [line.strip() for line in text.strip().splitlines()]
        pairs = [step.split(":", 1) for step in steps]
        return cls(tuple((label.strip(), rule.strip()) for label, rule in pairs), default)

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.steps] + [self.default]

    def bind(self, **columns: str) -> Column:
        """The ladder as one CASE expression; `columns` names the column of each slot."""
        chain = None
        for label, rule in self.steps:
            test = F.expr(rule.format(**columns))
            chain = F.when(test, label) if chain is None else chain.when(test, label)
        return F.lit(self.default) if chain is None else chain.otherwise(self.default)
