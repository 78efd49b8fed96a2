"""Fact joins and dimension lookups.

Fact and dimension joins carry no broadcast hint: Spark broadcasts a side only while its size is
under spark.sql.autoBroadcastJoinThreshold, and otherwise sort-merges with adaptive splitting of
skewed partitions. Code and control tables, whose few keys would gather the whole fact in a few
tasks and whose source often reports no size, are counted first and broadcast if small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def if_small(side: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """The side marked for broadcast if a count proves it small, else as it is."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def known_codes(dictionary: DataFrame, out: str, max_rows: int = 100_000) -> DataFrame | None:
    """The codes of a dictionary, each once, marked for broadcast; none if they are too many for it."""
    codes = dictionary.select(F.col("dic_code").alias(out)).distinct()
    return F.broadcast(codes) if codes.limit(max_rows + 1).count() <= max_rows else None


def enrich(df: DataFrame, dim: DataFrame, key: str, columns: dict[str, str],
           dim_key: str = "id", how: str = "left") -> DataFrame:
    """Add dimension columns by key. A missing dimension row gives nulls (`how="left"`).

    `columns` maps new column names to dimension column names.
    """
    side = dim.select(F.col(dim_key).alias("_key"),
                      *[F.col(source).alias(out) for out, source in columns.items()])
    return df.join(side, df[key] == side["_key"], how).drop("_key")


def decode(df: DataFrame, dictionary: DataFrame, names: dict[str, str],
           how: str = "left") -> DataFrame:
    """Add the names of codes, `names` mapping code columns to new name columns.

    With `how="inner"` a row with an unknown code is dropped.
    """
    side = if_small(dictionary.select("dic_code", "dic_name"))
    for code, name in names.items():
        df = enrich(df, side, code, {name: "dic_name"}, dim_key="dic_code", how=how)
    return df


# One hop of a chain: (dimension, key column of the row, {new column: dimension column}).
Hop = tuple[str, str, dict[str, str]]

# Fixed hops from a sku to its names.
SKU: Hop = ("sku_info", "sku_id", {"spu_id": "spu_id", "trademark_id": "tm_id",
                                   "category3_id": "category3_id"})
SPU: Hop = ("spu_info", "spu_id", {"spu_name": "spu_name"})
TRADEMARK: Hop = ("base_trademark", "trademark_id", {"trademark_name": "tm_name"})
CATEGORY3: Hop = ("base_category3", "category3_id", {"category3_name": "name",
                                                     "category2_id": "category2_id"})
CATEGORY2: Hop = ("base_category2", "category2_id", {"category2_name": "name",
                                                     "category1_id": "category1_id"})
CATEGORY1: Hop = ("base_category1", "category1_id", {"category1_name": "name"})
SIX_HOPS = (SKU, SPU, TRADEMARK, CATEGORY3, CATEGORY2, CATEGORY1)
FIVE_HOPS = (SKU, TRADEMARK, CATEGORY3, CATEGORY2, CATEGORY1)


def flat_sku(dims: dict[str, DataFrame], hops: tuple[Hop, ...] = SIX_HOPS) -> DataFrame:
    """The chain folded once into one row per sku, so facts need a single join."""
    table, _, columns = hops[0]
    flat = dims[table].select(F.col("id").alias("sku_id"),
                              *[F.col(s).alias(o) for o, s in columns.items()])
    for table, key, columns in hops[1:]:
        flat = enrich(flat, dims[table], key, columns)
    return flat


def enrich_sku(df: DataFrame, dims: dict[str, DataFrame],
               hops: tuple[Hop, ...] = SIX_HOPS) -> DataFrame:
    flat = flat_sku(dims, hops)
    if not hops_need_spu(hops):
        flat = flat.drop("spu_id")
    return enrich(df, flat, "sku_id", {c: c for c in flat.columns if c != "sku_id"},
                  dim_key="sku_id")


def sku_ids(dims: dict[str, DataFrame], hops: tuple[Hop, ...]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The chain in two parts: (the ids of each sku, the names of such ids, the columns of ids).

    The ids are those of the first hop that the others lead on from. The names have them with an
    underscore, and `_copies`, how often the dimensions give these names to these ids.
    """
    table, _, columns = hops[0]
    ids = {out: source for out, source in columns.items() if any(key == out for _, key, _ in hops[1:])}
    skus = dims[table].select(F.col("id").alias("sku_id"), *[F.col(s).alias(o) for o, s in ids.items()])
    names = dims[table].select(*[F.col(s).alias(f"_{o}") for o, s in ids.items()]).distinct()
    for table, key, columns in hops[1:]:
        names = enrich(names, dims[table], f"_{key}" if key in ids else key, columns)
    names = if_small(names.groupBy(*names.columns).agg(F.count("*").alias("_copies")))
    return skus, names, list(ids)


def hops_need_spu(hops: tuple[Hop, ...]) -> bool:
    return any(table == "spu_info" for table, _, _ in hops)


# Rows a control table may have: it is sent to every task.
MAX_ROUTES = 10_000


def route_history(config: DataFrame, version: str | None = None) -> DataFrame:
    """(source_table, routes): the routes of each source table, the newest first.

    Without a version column a table may have one route only, be it in several equal rows: which of
    different ones is the newer can't be told, so they end the query with an error.
    """
    columns = ["sink_table", "sink_columns", "sink_pk"]
    if version:
        route = F.struct(F.col(version).try_cast("long").alias("since"), *columns)
        return config.groupBy("source_table").agg(F.sort_array(F.collect_set(route), asc=False).alias("routes"))
    found = F.collect_set(F.struct(F.lit(None).cast("long").alias("since"), *columns))
    unclear = F.raise_error(F.concat(F.lit("several routes and no version of table "), F.col("source_table")))
    return (config.groupBy("source_table").agg(found.alias("routes"))
            .withColumn("routes", F.when(F.size("routes") > 1, unclear).otherwise(F.col("routes"))))


def route_rows(changes: DataFrame, config: DataFrame, version: str | None = None, time: str = "ts") -> DataFrame:
    """Give each change event its sink table; events of unlisted tables are dropped.

    With a version column, the time from which a route holds, an event takes the newest route that
    isn't later than its own `time`, and is dropped if there is none. The config, of at most
    MAX_ROUTES rows, goes to every task, and the names of its tables into a filter that reaches the
    events' source; the events stay where they are.
    """
    names = [r[0] for r in config.select("source_table").limit(MAX_ROUTES + 1).collect()]
    if len(names) > MAX_ROUTES:
        raise ValueError(f"a control table has at most {MAX_ROUTES} rows")
    side = F.broadcast(route_history(config, version))
    listed = changes.filter(F.col("table").isin(sorted({n for n in names if n is not None})))
    joined = listed.join(side, F.col("table") == F.col("source_table"))
    at = F.col(time).try_cast("long")
    held = F.filter("routes", lambda r: r["since"] <= at) if version else F.col("routes")
    return (joined.withColumn("_route", F.try_element_at(held, F.lit(1))).where("_route is not null")
            .select(*[F.col(f"`{c}`") for c in changes.columns],
                    *[F.col("_route")[c].alias(c) for c in ("sink_table", "sink_columns", "sink_pk")]))


# Heavy keys that are ever told apart, so the most rows that go to every task. A key behind them
# holds less than one part of this many of all rows.
MAX_HEAVY = 10_000
# Rows of a key that one task may get before the key is cut in parts.
PART_ROWS = 1_000_000


def heavy_keys(sizes: DataFrame, keys: list[str], rows: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(keys, _parts) of the keys with more than `part_rows` rows: how many parts each is cut in.

    `sizes` has the number of rows of each key. At most MAX_HEAVY come back, the largest ones.
    """
    return (sizes.filter(F.col(rows) > part_rows).orderBy(F.desc(rows), *keys).limit(MAX_HEAVY)
            .select(*keys, F.ceil(F.col(rows) / part_rows).cast("int").alias("_parts")))


def spread_join(left: DataFrame, right: DataFrame, on: str, how: str, spread_by: list[str], rows: str,
                part_rows: int = PART_ROWS) -> DataFrame:
    """Join a large left side, whose hottest key may hold a third of the rows, to one right row
    per key. `rows` is the right column with the number of left rows of the key.

    A heavy key's rows are dealt into as many parts as they need, and its right row is repeated for
    each part; any other key's rows and its one right row stay as they are.
    """
    heavy = F.broadcast(heavy_keys(right, [on], rows, part_rows).withColumnRenamed(on, "_heavy"))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int"), F.lit(0))
    salted = left.join(heavy, F.col(on) == F.col("_heavy"), "left").withColumn("_part", salt).drop("_heavy", "_parts")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = (right.drop(rows).join(heavy, F.col(on) == F.col("_heavy"), "left")
                .withColumn("_part", F.explode(parts)).drop("_heavy", "_parts").withColumnRenamed(on, "_on"))
    return (salted.join(repeated, (salted[on] == repeated["_on"])
                        & (salted["_part"] == repeated["_part"]), how)
            .drop(repeated["_part"]).drop("_on", "_part"))
