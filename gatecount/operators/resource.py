"""Catalogued resources: checked filters, projection, order and page over a DataFrame.

A resource knows the filters it allows. Predicates and projections are plain columns, so
Catalyst pushes them through to the scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import csv_line, fold

#: Page limits.
DEFAULT_LIMIT, MOST_LIMIT = 100, 1000


@dataclass(frozen=True)
class Filter:
    column: str
    how: str = "eq"  # eq, ilike or gte

    def predicate(self, value: object) -> Column:
        c = F.col(self.column)
        if self.how == "ilike":
            return c.ilike(str(value).replace("*", "%"))
        return c >= F.lit(value) if self.how == "gte" else c == F.lit(value)


@dataclass(frozen=True)
class Resource:
    """One table of one platform. Queries never cross platforms."""

    platform: str
    name: str
    key: str
    filters: dict[str, Filter] = field(default_factory=dict)

    def where(self, df: DataFrame, **given: object) -> DataFrame:
        """All filters together; empty values are ignored, unknown filters refused."""
        for name, value in given.items():
            if name not in self.filters:
                raise ValueError(f"{self.platform}/{self.name} has no filter {name}")
            if value not in (None, ""):
                df = df.filter(self.filters[name].predicate(value))
        return df

    def select(self, df: DataFrame, columns: str | None) -> DataFrame:
        if not columns:
            return df
        if not re.fullmatch("[a-z_,]+", columns):
            raise ValueError("select takes lower-case names and commas")
        return df.select(*columns.split(","))

    def page(self, df: DataFrame, order: str | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
        """Ordered by ``column.asc`` or ``column.desc``, then by key; a limit of nought or none means the default."""
        by = [F.col(self.key).asc()]
        if order:
            m = re.fullmatch(r"([a-z_]+)\.(asc|desc)", order)
            if not m:
                raise ValueError("order is column.asc or column.desc")
            by.insert(0, F.col(m[1]).asc_nulls_last() if m[2] == "asc" else F.col(m[1]).desc_nulls_last())
        return df.orderBy(*by).offset(max(0, offset)).limit(min(MOST_LIMIT, max(1, limit or DEFAULT_LIMIT)))

    def query(self, df: DataFrame, *, columns: str | None = None, order: str | None = None, limit: int | None = None, offset: int = 0, **given: object) -> DataFrame:
        return self.select(self.page(self.where(df, **given), order, limit, offset), columns)

    def count(self, df: DataFrame, **given: object) -> DataFrame:
        return self.where(df, **given).agg(F.count(F.lit(1)).alias("total"))

    def csv(self, df: DataFrame) -> DataFrame:
        """One escaped line for each row, after the key."""
        return df.select(self.key, csv_line(*[F.col(c) for c in df.columns]).alias("line"))


def search(df: DataFrame, words: str, columns: list[str], **equal: object) -> DataFrame:
    """Rows whose columns together hold the words, whatever case and accents, and whose ``equal`` columns have just that value; empty values are ignored."""
    for column, value in equal.items():
        if value not in (None, ""):
            df = df.filter(F.col(column) == F.lit(value))
    return df.filter(fold(F.concat_ws(" ", *columns)).contains(fold(F.lit(words)))) if words else df


CATALOG = {
    ("members", "profile"): Resource("members", "profile", "member_id", {"city": Filter("city", "ilike"), "email": Filter("email", "ilike"), "name": Filter("full_name", "ilike"), "min_tickets": Filter("tickets_total", "gte"), "min_use_rate": Filter("use_rate", "gte"), "has_membership": Filter("has_membership")}),
    ("members", "tickets"): Resource("members", "tickets", "member_ticket_id", {"member_id": Filter("member_id"), "type": Filter("type"), "used": Filter("used")}),
    ("sales", "events"): Resource("sales", "events", "event_id", {"city": Filter("city", "ilike"), "venue": Filter("venue", "ilike"), "month": Filter("month"), "artist_id": Filter("artist_id")}),
    ("sales", "sales"): Resource("sales", "sales", "sale_id", {"event_id": Filter("event_id"), "channel": Filter("channel"), "email": Filter("buyer_email", "ilike")}),
    ("sales", "tickets"): Resource("sales", "tickets", "ticket_id", {"event_id": Filter("event_id"), "ticket_type": Filter("ticket_type"), "sale_id": Filter("sale_id")}),
    ("sales", "artists"): Resource("sales", "artists", "artist_id", {"name": Filter("name", "ilike"), "home_city": Filter("home_city", "ilike")}),
}


def resource(platform: str, name: str) -> Resource:
    if (platform, name) not in CATALOG:
        raise ValueError(f"{platform} has no resource {name}")
    return CATALOG[platform, name]
