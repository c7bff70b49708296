"""Declared constraints as checks over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


@dataclass(frozen=True)
class Unique:
    """No two rows share ``columns``; with ``where`` only among the rows it selects. Rows with a
    NULL in the key do not collide."""

    name: str
    columns: tuple[str, ...]
    where: str | None = None

    def applies(self) -> Column:
        """Whether a row's key takes part."""
        known = [F.col(c).isNotNull() for c in self.columns]
        return reduce(Column.__and__, known, F.coalesce(F.expr(self.where), F.lit(False)) if self.where else F.lit(True))


@dataclass(frozen=True)
class ForeignKey:
    """Every non-NULL value of ``column`` exists in the parent."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str

    def violations(self, df: DataFrame) -> DataFrame:
        parents = self.parent.select(F.col(self.parent_column).alias(self.column))
        children = df.where(F.col(self.column).isNotNull()).groupBy(self.column).agg(F.count(F.lit(1)).alias("n"))
        return children.join(parents, self.column, "left_anti").select(
            _key([self.column]).alias("key"), F.concat(F.col("n").cast("string"), F.lit(" orphans")).alias("detail")
        )


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str
    key: tuple[str, ...]

    def broken(self) -> Column:
        return F.col(self.column).isNull()

    def detail(self) -> Column:
        return F.lit(f"{self.column} is missing")


@dataclass(frozen=True)
class MaxLength:
    name: str
    column: str
    length: int
    key: tuple[str, ...]

    def broken(self) -> Column:
        return F.char_length(self.column) > self.length

    def detail(self) -> Column:
        return F.concat(F.lit(f"{self.column} has "), F.char_length(self.column).cast("string"), F.lit(" characters"))


@dataclass(frozen=True)
class KnownValue:
    """Every non-NULL value is one of a short list, such as the names of a dictionary."""

    name: str
    column: str
    allowed: tuple[str, ...]
    key: tuple[str, ...]

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.allowed)

    def detail(self) -> Column:
        return F.concat(F.lit("unknown "), F.col(self.column))


Rule = Unique | ForeignKey | NotNull | MaxLength | KnownValue


def _broken_rows(df: DataFrame, rules: Sequence[NotNull | MaxLength | KnownValue]) -> DataFrame:
    """All rules about single rows, in one pass. Rows that keep all of them, nearly all rows as a rule,
    go first; only the others are taken apart."""
    broken = df.where(reduce(Column.__or__, [F.coalesce(r.broken(), F.lit(False)) for r in rules]))
    judged = [F.when(r.broken(), F.struct(F.lit(r.name).alias("rule"), _key(r.key).alias("key"), r.detail().alias("detail"))) for r in rules]
    return broken.select(F.explode(F.array(*judged)).alias("found")).where("found IS NOT NULL").select("found.*")


def _repeated_keys(df: DataFrame, rules: Sequence[Unique]) -> DataFrame:
    """All uniqueness rules in one pass: every rule is a grouping set of its own typed columns, which are
    NULL in rows that do not take part. Rows are counted before and after the one shuffle."""
    own = [[f"_{i}_{c}" for c in r.columns] for i, r in enumerate(rules)]
    keys = df.select(*[F.when(r.applies(), F.col(c)).alias(k) for r, ks in zip(rules, own) for c, k in zip(r.columns, ks)])
    counted = keys.groupingSets([[F.col(k) for k in ks] for ks in own], *[k for ks in own for k in ks]).agg(F.count(F.lit(1)).alias("_n"))
    # A group belongs to the rule whose columns are there; one without any is the rows left out.
    rule = F.coalesce(*[F.when(F.col(ks[0]).isNotNull(), F.lit(r.name)) for r, ks in zip(rules, own)])
    key = F.coalesce(*[F.when(F.col(ks[0]).isNotNull(), _key(ks)) for ks in own])
    repeated = counted.where("_n > 1").select(rule.alias("rule"), key.alias("key"), F.concat(F.col("_n").cast("string"), F.lit(" rows")).alias("detail"))
    return repeated.where("rule IS NOT NULL")


def check_constraints(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of all rules: ``rule, key, detail``. The table is read once for the rules about
    rows, once for uniqueness and once for each foreign key. Repeated keys are counted before they
    are shuffled, so a value that fills a table costs no more than any other."""
    unique = [r for r in rules if isinstance(r, Unique)]
    foreign = [r for r in rules if isinstance(r, ForeignKey)]
    rows = [r for r in rules if not isinstance(r, Unique | ForeignKey)]
    found = [r.violations(df).select(F.lit(r.name).alias("rule"), "key", "detail") for r in foreign]
    found += [_repeated_keys(df, unique)] if unique else []
    found += [_broken_rows(df, rows)] if rows else []
    return reduce(DataFrame.unionByName, found)


def cascade_delete(children: DataFrame, deleted_keys: DataFrame, key: str = "exp_id") -> DataFrame:
    """The children that are left after their parents' deletion."""
    return children.join(deleted_keys.select(key), key, "left_anti")
