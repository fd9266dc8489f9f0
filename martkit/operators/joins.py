"""Join shapes the marts share (JN-1..JN-11, JN-16, JN-21)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.session import staged

#: Column that tells rows of orders apart.
ROW = "_row"


def left_keep(left: DataFrame, right: DataFrame, on, right_filter: Column | None = None) -> DataFrame:
    """All left rows; the right side is filtered before the join (JN-1, JN-2)."""
    return left.join(right if right_filter is None else right.filter(right_filter), on, "left")


def join_by_day(df: DataFrame, dim: DataFrame, ts: str, dim_day: str, extra_keys=(), how="inner") -> DataFrame:
    """Attributes valid on the calendar day of ``ts`` (JN-6, JN-7)."""
    right = dim.withColumnRenamed(dim_day, "_day")
    joined = df.withColumn("_day", F.to_date(ts)).join(right, ["_day", *extra_keys], how)
    return joined.withColumnRenamed("_day", dim_day)


def missing_from(new: DataFrame, existing: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows of ``new`` without a match, and rows of ``new`` with a null key.

    Written as an anti join: ``NOT IN`` would return nothing as soon as one
    existing key is null.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    missing = new.filter(~some_null).join(existing.select(*keys), keys, "left_anti")
    return missing, new.filter(some_null)


def outer_metrics(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of aggregates with one row per key, null keys included.

    One union and one aggregation instead of a chain of outer joins.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    metrics = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in metrics])


def resolve_items(orders: DataFrame, restaurants: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Orders with ``restaurant_name`` and with name and category of each line
    from the restaurant's menu (JN-21); with ``people`` (user_id, user_name) also
    the names of their users.

    Lines meet menu entries by restaurant and item, so a menu never travels with
    an order and a large restaurant is spread by its items; what is found is then
    gathered in the order of the lines. Of several entries of one item the first
    counts. ``unresolved`` is the number of lines not on the menu.

    Only row numbers and keys go to what they are looked up in, and only names
    come back: an order itself is shuffled once. For that its rows are written
    down with their numbers, unless they come with them (``numbered``) from a
    table that is.
    """
    if ROW not in orders.columns:
        orders = staged(numbered(orders), "orders")
    kept = [c for c in orders.columns if c not in (ROW, "order_items")]
    entries = (
        restaurants.select(F.col("id").alias("restaurant_id"), F.posexplode("menu").alias("_place", "_entry"))
        .groupBy("restaurant_id", F.col("_entry._id").alias("_id"))
        .agg(F.min_by(F.struct("_entry.name", "_entry.category"), "_place").alias("_shown"))
    )
    lines = orders.select(ROW, "restaurant_id", F.posexplode("order_items").alias("_at", "_line"))
    gathered = (
        lines.select(ROW, "restaurant_id", "_at", F.col("_line.id").alias("_id"))
        .join(entries, ["restaurant_id", "_id"], "left")
        .groupBy(ROW)
        .agg(
            F.sort_array(F.collect_list(F.struct("_at", "_shown.name", "_shown.category"))).alias("_lines"),
            F.count_if(F.col("_shown.name").isNull()).cast("int").alias("_lost"),
        )
    )
    names = restaurants.select(F.col("id").alias("restaurant_id"), F.col("name").alias("restaurant_name")).distinct()
    found = orders.select(ROW, "restaurant_id", *([] if people is None else ["user_id"])).join(names, "restaurant_id", "left")
    if people is not None:
        found = found.join(people.select("user_id", "user_name"), "user_id", "left")
    found = found.drop("restaurant_id", "user_id")
    item, shown = orders.schema["order_items"].dataType.elementType, entries.schema["_shown"].dataType
    fields = [*[item[c] for c in ("id", "price", "quantity")], *[shown[c] for c in ("name", "category")]]
    product = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    # Fields of all structs, not a lambda, which would be interpreted line by line.
    parts = [F.col("order_items")[c] for c in ("id", "price", "quantity")] + [F.col("_lines")[c] for c in ("name", "category")]
    products = F.when(F.size("order_items") == 0, F.array()).otherwise(F.arrays_zip(*parts)).cast(product)
    return (
        orders.join(gathered, ROW, "left")
        .join(found, ROW)
        .withColumn("products", F.when(F.col("order_items").isNotNull(), products))
        .withColumn("unresolved", F.coalesce("_lost", F.lit(0)))
        .select(*kept, *[c for c in found.columns if c != ROW], "products", "unresolved")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number each. It stays the same only once they are written."""
    return rows.withColumn(ROW, F.monotonically_increasing_id())
