"""Verification compiled to few aggregations: rules of the schema, references, and rules over groups.

A check is a condition on rows, or on groups of rows with the same keys. All row checks of a table are sums of one scan;
group checks of a table with the same keys share one aggregation, and so do references of that column: its values are counted
before they meet their parents. Rows are compared by digests. So no whole row is moved, and the number of aggregations follows
the tables and key sets, not the checks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TABLES, is_number, key_of


@dataclass(frozen=True)
class RowCheck:
    """``holds`` must be true of every row of ``table``; null is false."""

    table: str
    name: str
    holds: Column


@dataclass(frozen=True)
class GroupCheck:
    """``holds``, a condition on aggregates such as ``count(distinct x) <= 1``, must be true of every group of ``keys``."""

    table: str
    name: str
    keys: tuple[str, ...]
    holds: Column


@dataclass(frozen=True)
class ReferenceCheck:
    """Every value of ``column`` must be a key of ``parent``."""

    table: str
    name: str
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class CopiesCheck:
    """No row of ``table`` occurs twice, by its schema's columns; rows that do are counted once each."""

    table: str
    name: str


Check = RowCheck | GroupCheck | ReferenceCheck | CopiesCheck


def schema_checks(tables: Iterable[str] = TABLES) -> list[Check]:
    """What the fields' metadata ask for: no blanks, known words, ranges, patterns, capitals, whole references, unique keys, no repeated rows."""
    out: list[Check] = []
    for table in tables:
        for f in TABLES[table]:
            c, rules, at = F.col(f.name), f.metadata, f"{table}.{f.name}"
            out.append(RowCheck(table, f"{at} filled", c.isNotNull() if is_number(f) else F.trim(F.coalesce(c, F.lit(""))) != ""))
            missing = c.isin(*rules["sentinels"]) if rules.get("sentinels") else F.lit(False)
            if "values" in rules:
                out.append(RowCheck(table, f"{at} known", c.isin(*rules["values"])))
            if "low" in rules:
                out.append(RowCheck(table, f"{at} in range", (c >= rules["low"]) & (c <= rules["high"]) if "high" in rules else c >= rules["low"]))
            if "pattern" in rules:
                out.append(RowCheck(table, f"{at} shaped", missing | c.rlike(rules["pattern"])))
            if rules.get("upper"):
                out.append(RowCheck(table, f"{at} in capitals", missing | (c == F.upper(c))))
            if "refers" in rules:
                out.append(ReferenceCheck(table, f"{at} refers", f.name, rules["refers"], key_of(rules["refers"])))
            if rules.get("key"):
                out.append(GroupCheck(table, f"{at} unique", (f.name,), F.count(F.lit(1)) <= 1))
        out.append(CopiesCheck(table, f"{table} without copies"))
    return out


def run(frames: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """check, passed, failing: rows, or groups, that break each check."""
    checks = list(checks)
    names = [c.name for c in checks]
    if not checks or len(set(names)) < len(names):
        raise ValueError("checks need names of their own")
    out = None
    for sums, own in _aggregations(frames, checks):
        one = sums.unpivot([], [F.col(f"`{n}`") for n in own], "check", "failing")
        out = one if out is None else out.unionByName(one)
    return out.select("check", (F.col("failing") == 0).alias("passed"), "failing")


def _failing(holds: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)), F.lit(0))


def _aggregations(frames: dict[str, DataFrame], checks: list[Check]) -> Iterable[tuple[DataFrame, list[str]]]:
    for table in dict.fromkeys(c.table for c in checks):
        df = frames[table]
        own = [c for c in checks if c.table == table]
        sums = {c.name: _failing(c.holds) for c in own if isinstance(c, RowCheck)}
        grouped, refers = [c for c in own if isinstance(c, GroupCheck)], [c for c in own if isinstance(c, ReferenceCheck)]
        keysets = dict.fromkeys(c.keys for c in grouped)
        rows = [(df.agg(*[s.alias(n) for n, s in sums.items()]), list(sums))] if sums else []
        for column in dict.fromkeys(c.column for c in refers if (c.column,) not in keysets):
            rows.append(_by_keys(frames, df, (column,), [], [c for c in refers if c.column == column]))
        if rows:
            whole = rows[0][0]
            for one, _ in rows[1:]:
                whole = whole.join(one)  # one row each
            yield whole, [n for _, names in rows for n in names]
        for keys in keysets:
            yield _by_keys(frames, df, keys, [c for c in grouped if c.keys == keys], [c for c in refers if (c.column,) == keys])
        for c in (c for c in own if isinstance(c, CopiesCheck)):
            held = df.groupBy(_digest(df, TABLES[table].fieldNames()).alias("_digest")).agg(F.count(F.lit(1)).alias("_rows"))
            yield held.agg(_failing(F.col("_rows") <= 1).alias(c.name)), [c.name]


def _by_keys(frames: dict[str, DataFrame], df: DataFrame, keys: tuple[str, ...], groups: list[GroupCheck], refers: list[ReferenceCheck]) -> tuple[DataFrame, list[str]]:
    """One row: what fails of the rules over groups of ``keys``, and of the references of that one column, whose rows are counted by value first."""
    held = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[c.holds.alias(f"_holds{k}") for k, c in enumerate(groups)])
    counts = {c.name: _failing(F.col(f"_holds{k}")) for k, c in enumerate(groups)}
    for k, c in enumerate(refers):
        parents = frames[c.parent].select(F.col(c.parent_key).alias(f"_parent{k}")).distinct()
        held = held.join(parents, F.col(c.column) == F.col(f"_parent{k}"), "left")
        counts[c.name] = F.coalesce(F.sum(F.when(F.col(f"_parent{k}").isNull(), F.col("_rows"))), F.lit(0))
    return held.agg(*[n.alias(name) for name, n in counts.items()]), list(counts)


def _digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row's columns, by name in JSON: a null has no entry there, and so differs from every text."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[df[c] for c in columns])), 256))
