"""Fields cut out of free text at anchors.

A rule names where a slice starts (a fixed position or an anchor pattern, shifted) and where it
ends (a length, or another anchor).  Anchors are regular expressions; one may be sought from
another's match on, so chains such as "the first digit behind the colon" are one rule.
All of it is built-in column work with the reference dialect's positions: 1-based, 0 for
"not found", start 0 counts as 1, negative starts count from the end, lengths below 0
give empty text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: More characters than any text has.
TO_THE_END = 2 ** 31 - 1


@dataclass(frozen=True)
class Anchor:
    """The first match of ``pattern``, at or behind the match of ``after`` if that is given."""

    pattern: str
    after: Anchor | None = None

    def at(self, text: Column) -> Column:
        if self.after is None:
            return F.regexp_instr(text, F.lit(self.pattern))
        low = F.greatest(self.after.at(text), F.lit(1))
        found = F.regexp_instr(F.substring(text, low, F.lit(TO_THE_END)), F.lit(self.pattern))
        return F.when(found > 0, found + low - 1).otherwise(F.when(text.isNotNull(), F.lit(0)))


@dataclass(frozen=True)
class Slice:
    """Text from ``start`` (position or anchor, plus ``shift``) on: ``length`` characters, or up to
    the anchor ``until`` less ``less``.  ``drop`` is removed from the result; texts that
    don't match the LIKE pattern ``when`` give null."""

    start: Anchor | int
    shift: int = 0
    length: int | None = None
    until: Anchor | None = None
    less: int = 0
    drop: str | None = None
    when: str | None = None

    def of(self, text: Column) -> Column:
        base = F.lit(0) if isinstance(self.start, int) else self.start.at(text)
        first = F.lit(self.start) if isinstance(self.start, int) else base
        if self.until is not None:
            length = self.until.at(text) - base - F.lit(self.less)
        else:
            length = F.lit(TO_THE_END if self.length is None else self.length)
        out = F.substring(text, first + F.lit(self.shift), length)
        if self.drop is not None:
            out = F.replace(out, F.lit(self.drop), F.lit(""))
        return out if self.when is None else F.when(text.like(self.when), out)


@dataclass(frozen=True)
class Match:
    """The first match of a pattern as a whole; null without one."""

    pattern: str

    def of(self, text: Column) -> Column:
        return F.regexp_substr(text, F.lit(self.pattern))


@dataclass(frozen=True)
class Kinds:
    """One rule for texts LIKE ``like``, another one for all others (null texts included)."""

    like: str
    then: Slice | Match
    otherwise: Slice | Match

    def of(self, text: Column) -> Column:
        return F.when(text.like(self.like), self.then.of(text)).otherwise(self.otherwise.of(text))


def mine(df: DataFrame, rules: Mapping[str, tuple[str, Slice | Match | Kinds]]) -> DataFrame:
    """``df`` with a column for each rule (name -> (source column, rule)), in order: a rule may cut a
    slice that an earlier one made."""
    for name, (source, rule) in rules.items():
        df = df.withColumn(name, rule.of(F.col(source)))
    return df


def tier(item: Column, limits: tuple[int, ...], names: tuple[str, ...]) -> Column:
    """The name of the first limit that ``item`` is below, else the last name."""
    out = F.when(item < limits[0], F.lit(names[0]))
    for limit, name in zip(limits[1:], names[1:]):
        out = out.when(item < limit, F.lit(name))
    return out.otherwise(F.lit(names[len(limits)]))
