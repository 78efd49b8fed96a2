"""Projections and predicates on log and change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import whole
from tillstream.schemas import PAYLOAD, STATUS_CANCELLED


# -- change events ---------------------------------------------------------

def route(df: DataFrame, table: str, *types: str, database: str | None = None) -> DataFrame:
    """Events of one table, optionally of some types and one database."""
    keep = F.col("table") == table
    if types:
        keep &= F.col("type").isin(*types)
    if database is not None:
        keep &= F.col("database") == database
    return df.filter(keep)


def payload(df: DataFrame, table: str, *extra: str | Column) -> DataFrame:
    """The payload keys of a table as columns, plus envelope columns named in `extra`."""
    return df.select(*[F.col("data")[k].alias(k) for k in PAYLOAD[table]], *extra)


def changed(key: str) -> Column:
    """The field had a value before this update."""
    return F.col("old")[key].isNotNull()


def in_old(key: str) -> Column:
    """The field was touched by this update, even if it was null before."""
    return F.col("old").isNotNull() & F.map_contains_key("old", key)


def moved(key: str, before: str, after: str) -> Column:
    return (F.col("old")[key] == before) & (F.col("data")[key] == after)


def grown(key: str) -> tuple[Column, Column]:
    """(keep, quantity): inserts with their quantity, updates that raise it with the rise."""
    new, old = whole(F.col("data")[key]), whole(F.col("old")[key])
    is_insert = F.col("type") == "insert"
    keep = is_insert | ((F.col("type") == "update") & F.col("old")[key].isNotNull() & (new > old))
    return keep, F.when(is_insert, new).otherwise(new - old)


LOADED = ("insert", "update", "bootstrap-insert")


def loaded(df: DataFrame) -> DataFrame:
    """Inserts, updates and bootstrap inserts; deletes are dropped."""
    return df.filter(F.col("type").isin(*LOADED))


def keep_columns(df: DataFrame, columns: str = "sink_columns") -> DataFrame:
    """Keep only the payload keys listed in a comma separated column."""
    wanted = F.split(F.col(columns), r"\s*,\s*")
    return df.withColumn("data", F.map_filter("data", lambda k, v: F.array_contains(wanted, k)))


# -- wide order fact -------------------------------------------------------

def placed(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("type") == "insert")


def cancelled(fact: DataFrame) -> DataFrame:
    """Orders whose status was changed to cancelled.

    A change is an update: an insert has no former status.
    """
    return fact.filter((F.col("type") == "update") & changed("order_status")
                       & (F.col("order_status") == STATUS_CANCELLED))


def not_tombstone(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(F.col(value) != "")


# -- page views ------------------------------------------------------------

def entry_pages(df: DataFrame) -> DataFrame:
    """Views that start a visit."""
    return df.filter(F.col("last_page_id").isNull())


def on_pages(df: DataFrame, *pages: str) -> DataFrame:
    return df.filter(F.col("page_id").isin(*pages))


def logged_in_entries(df: DataFrame) -> DataFrame:
    return df.filter(F.col("uid").isNotNull() & F.col("last_page_id").isNull())


def keyword_searches(df: DataFrame) -> DataFrame:
    return df.filter(F.col("item").isNotNull() & (F.col("last_page_id") == "search")
                     & (F.col("item_type") == "keyword"))


# -- log split -------------------------------------------------------------

def _items(events: DataFrame, name: str) -> DataFrame:
    return (events.filter(F.col("start").isNull())
            .select(F.explode(name).alias("item"), F.col("page.page_id").alias("page_id"),
                    "ts", F.to_json("common").alias("common")))


def split_events(events: DataFrame) -> dict[str, DataFrame]:
    """Log events to five outputs. An error event also goes to start or to page."""
    page = events.filter(F.col("start").isNull())
    return {
        "error": events.filter(F.col("err").isNotNull()),
        "start": events.filter(F.col("start").isNotNull()),
        "display": _items(events, "displays"),
        "action": _items(events, "actions"),
        "page": page.select("common", "page", "err", "ts"),
    }


def item_json(items: DataFrame) -> DataFrame:
    """A display or action row as one JSON text, its parent fields merged into the item."""
    parents = F.create_map(F.lit("page_id"), F.col("page_id"), F.lit("common"), F.col("common"))
    wanted = F.map_filter("item", lambda k, v: ~k.isin("page_id", "ts", "common"))
    # the item's own values are texts, ts stays a number
    body = F.to_json(F.map_concat(wanted, parents))
    return items.select(F.concat(body.substr(F.lit(1), F.length(body) - 1), F.lit(',"ts":'),
                                 F.col("ts").cast("string"), F.lit("}")).alias("value"))
