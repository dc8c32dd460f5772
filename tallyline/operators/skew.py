"""Joins and numbering that survive a key holding a large share of all rows.

Hot keys are found with Spark's top-k sketch: one pass over the key column, one
bounded sketch per task, merged in two steps. The sketch only steers the
physical layout, so its error never touches a result. When no key is hot, the
plain Spark plan is used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds at least this share of the rows ...
HOT_SHARE = 1 / 128
# ... and more rows than any single task should mind ...
HOT_ROWS = 50_000
# ... or, in a table of any size, more rows than a task should take.
TASK_ROWS = 4_000_000
# Counts of the sketch are off by at most 1 / (0.75 * SKETCH_ITEMS) of the rows, so
# no more keys than this can be told from noise, which bounds every list below.
SKETCH_ITEMS = 4096
MAX_HOT_KEYS = 3072
# Tasks that merge the sketches of all others before one merges theirs.
MERGE_SLOTS = 256
MAX_SALTS = 65_536
# Ranges a key is cut into by `number_rows`, and rows sampled to find them.
MAX_RANGES, RANGE_SAMPLE = 512, 500_000


@dataclass(frozen=True)
class HotKeys:
    """Hot key values with the number of slices each is cut into."""

    slices: dict = field(default_factory=dict)
    null_is_hot: bool = False
    rows_each: float = 1.0  # rows of a slice, about

    @property
    def values(self) -> list:
        return list(self.slices)

    def joined_with(self, other: HotKeys) -> HotKeys:
        """Hot keys of a join of two sides on the key these were found for."""
        slices = dict(self.slices)
        for key, n in other.slices.items():
            slices[key] = min(MAX_SALTS, slices.get(key, 1) * n)
        return HotKeys(slices, self.null_is_hot, self.rows_each)


def _key_column(df: DataFrame, keys: list[str], exact: bool = False) -> Column:
    """One value per key. Several columns are hashed, or spelled out when `exact`."""
    if len(keys) == 1:
        return df[keys[0]]
    columns = [df[k] for k in keys]
    return F.to_json(F.struct(*columns)) if exact else F.xxhash64(*columns)


def hot_keys(
    df: DataFrame,
    keys: str | list[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    exact: bool = False,
) -> HotKeys:
    """Find the keys that hold at least `share` of the rows and `min_rows` rows.

    In large tables TASK_ROWS rows are enough, whatever their share.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    row = (
        df.select(
            _key_column(df, keys, exact).alias("k"),
            F.pmod(F.spark_partition_id(), F.lit(MERGE_SLOTS)).alias("slot"),
        )
        .groupBy("slot")
        .agg(
            F.count("*").alias("n"),
            F.expr(f"approx_top_k_accumulate(k, {SKETCH_ITEMS})").alias("sketch"),
        )
        .groupBy(F.lit("all"))
        .agg(
            F.sum("n").alias("n"),
            F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"),
        )
        .select("n", F.expr(f"approx_top_k_estimate(sketch, {MAX_HOT_KEYS})").alias("top"))
        .first()
    )
    if row is None:  # no rows, no sketch
        return HotKeys()
    floor = max(min(max(min_rows, share * row.n), TASK_ROWS), 2)
    slices, null_is_hot = {}, False
    for item, count in row.top:
        if count < floor:
            continue
        if item is None:
            null_is_hot = True
        else:
            slices[item] = min(MAX_SALTS, max(2, math.ceil(count / floor)))
    return HotKeys(slices, null_is_hot, floor)


def _slices_of(key: Column, hot: HotKeys) -> Column:
    """Number of slices of this row's key: 1 unless the key is hot."""
    if not hot.slices:
        return F.lit(1)
    by_count: dict[int, list] = {}
    for value, n in hot.slices.items():
        by_count.setdefault(n, []).append(value)
    tiers = iter(by_count.items())
    n, values = next(tiers)
    out = F.when(key.isin(values), F.lit(n))
    for n, values in tiers:
        out = out.when(key.isin(values), F.lit(n))
    return out.otherwise(F.lit(1))


def _sort_columns(df: DataFrame) -> list[Column]:
    """Columns that order whole rows; maps have no order, their JSON text has."""
    return [
        F.to_json(df[f.name]) if "map<" in f.dataType.simpleString() else df[f.name]
        for f in df.schema.fields
    ]


def _with_ordinal(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of each partition.

    Sorting by whole rows first makes the numbers the same when a lost task
    runs again, and gives equal copies of a row different numbers.
    """
    return df.sortWithinPartitions(*_sort_columns(df)).withColumn(
        name, F.monotonically_increasing_id()
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    unique_right: bool = False,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
) -> DataFrame:
    """Equi-join (inner or left) by column name, whatever the key distribution.

    Cold keys take the plain join. Hot keys of either side are cut into slices;
    the other side's rows of that key are copied once per slice. Null keys of a
    left join match nothing, so a large null group skips the shuffle.
    `unique_right` says the right side has one row per key, e.g. an aggregate.
    Hot keys already known can be handed in and are then not looked for.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = [on] if isinstance(on, str) else list(on)
    if not _sketchable(left, right, keys):
        return left.join(right, keys, how)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    # Below, an unmatched row is told apart by its key, which a hash cannot do.
    exact = how == "left"

    def key_of(df):
        return _key_column(df, keys, exact)

    if hot_left is None:
        hot_left = hot_keys(left, keys, share, min_rows, exact)
    if unique_right:
        hot_right = HotKeys()
    elif hot_right is None:
        hot_right = hot_keys(right.where(has_key), keys, share, min_rows, exact)

    parts = []
    if how == "left" and hot_left.null_is_hot:
        # Only single keys report a null; see _key_column.
        extra = [f for f in right.schema.fields if f.name not in keys]
        parts.append(
            left.where(~has_key).select(
                *[F.col(k) for k in keys],
                *[F.col(c) for c in left.columns if c not in keys],
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra],
            )
        )
        left = left.where(has_key)

    hot = list(dict.fromkeys(hot_left.values + hot_right.values))
    if not hot:
        parts.insert(0, left.join(right, keys, how))
        return reduce(DataFrame.unionByName, parts)

    def is_hot(df):
        return F.coalesce(key_of(df).isin(hot), F.lit(False))

    cold = left.where(~is_hot(left)).join(right.where(~is_hot(right)), keys, how)

    hot_l, hot_r = left.where(is_hot(left)), right.where(is_hot(right))
    hot_l = _with_ordinal(hot_l, "__row")
    hot_r = _with_ordinal(hot_r, "__row")
    # Each left row sits in one slice of its own key and in all slices the right
    # side has for that key, and the other way round: every pair meets once.
    n_l, m_l = (_slices_of(key_of(hot_l), h) for h in (hot_left, hot_right))
    n_r, m_r = (_slices_of(key_of(hot_r), h) for h in (hot_left, hot_right))
    hot_l = (
        hot_l.withColumn("__ls", F.pmod("__row", n_l).cast("int"))
        .withColumn("__copies", m_l)
        .withColumn("__rs", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
        .drop("__row")
    )
    hot_r = (
        hot_r.withColumn("__rs", F.pmod("__row", m_r).cast("int"))
        .withColumn("__ls", F.explode(F.sequence(F.lit(0), n_r - 1)))
        .withColumn("__present", F.lit(True))
        .drop("__row")
    )
    joined = hot_l.join(hot_r, keys + ["__ls", "__rs"], how)
    if how == "left":
        # A key that is hot on the right has a match somewhere, so a copy of a
        # left row that found an empty slice is not an unmatched row.
        joined = joined.where((F.col("__copies") == 1) | F.col("__present").isNotNull())
    joined = joined.drop("__ls", "__rs", "__copies", "__present")
    return reduce(DataFrame.unionByName, [cold, joined, *parts])


def _sketchable(left: DataFrame, right: DataFrame, keys: list[str]) -> bool:
    """Both sides spell a key alike, in a type the sketch takes.

    Otherwise a key could look hot on one side only, and its matches be lost:
    such joins are left to Spark whole.
    """
    kinds = [(left.schema[k].dataType.simpleString(), right.schema[k].dataType.simpleString()) for k in keys]
    odd = ("binary", "array", "map", "struct", "variant", "interval")
    return all(a == b and not a.startswith(odd) for a, b in kinds)


def _bytes_per_row(df: DataFrame) -> Column:
    size = F.lit(0)
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            width = F.octet_length(f.name)
        elif kind.startswith(("array", "map", "struct")):
            width = F.octet_length(F.to_json(f.name))
        else:
            width = F.lit(8)
        size = size + F.coalesce(width, F.lit(0)) + 8
    return size


def fits_broadcast(df: DataFrame, max_bytes: int = 64 << 20) -> bool:
    """Measure the table: true when its rows take at most `max_bytes`."""
    size = df.agg(F.sum(_bytes_per_row(df).cast("long"))).first()[0]
    return (size or 0) <= max_bytes


def attach(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    how: str = "left",
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """Join a dimension: broadcast when its measured size allows, else `skew_join`."""
    if fits_broadcast(dimension, max_bytes):
        return fact.join(F.broadcast(dimension), on, how)
    return skew_join(fact, dimension, on, how)


def number_rows(
    df: DataFrame,
    keys: str | list[str],
    order: list[str],
    name: str,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """`row_number()` over `keys` ordered by `order` (ascending, nulls first).

    Rows of hot keys are cut into ranges of `order`; each range is numbered on
    its own and moved up by the number of rows in the ranges before it. `order`
    should identify rows, as for any row_number().
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ordering = [F.col(c).asc_nulls_first() for c in order]
    plain = Window.partitionBy(*keys).orderBy(*ordering)
    if hot is None:
        hot = hot_keys(df, keys, share, min_rows)
    if hot.null_is_hot:
        # A null group is a group like any other here.
        hot = HotKeys({**hot.slices, None: MAX_RANGES // 8}, False, hot.rows_each)
    if not hot.slices:
        return df.withColumn(name, F.row_number().over(plain))

    key = _key_column(df, keys)
    named = [v for v in hot.values if v is not None]
    is_hot = F.coalesce(key.isin(named), F.lit(False))
    if None in hot.slices:
        is_hot = is_hot | key.isNull()

    cold = df.where(~is_hot).withColumn(name, F.row_number().over(plain))
    place = F.struct(*[F.col(c) for c in order])
    marks = _range_marks(df.where(is_hot), key, place, hot)
    ranged = (
        df.where(is_hot)
        .withColumn("__key", key)
        .join(F.broadcast(marks), F.col("__key").eqNullSafe(F.col("__of")), "left")
        .withColumn(
            "__range",
            F.coalesce(F.size(F.filter("__marks", lambda m: place >= m)), F.lit(0)),
        )
        .drop("__key", "__of", "__marks")
    )
    # At most one row per hot key and range: small enough to broadcast.
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*keys, "__range")
        .agg(F.count("*").alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    within = Window.partitionBy(*keys, "__range").orderBy(*ordering)
    right = offsets.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("__range").alias("__at"),
        "__offset",
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    hot_rows = (
        ranged.withColumn("__rn", F.row_number().over(within))
        .join(F.broadcast(right), reduce(lambda a, b: a & b, same, F.col("__range") == F.col("__at")))
        .withColumn(name, (F.col("__rn") + F.col("__offset")).cast("int"))
        .select(*df.columns, name)
    )
    return cold.unionByName(hot_rows)


def _range_marks(df: DataFrame, key: Column, place: Column, hot: HotKeys) -> DataFrame:
    """(__of, __marks): the cut points of each hot key, at most MAX_RANGES of them.

    Given as values, so every use of them agrees. They come from a sample of at
    most about RANGE_SAMPLE rows; an uneven sample makes uneven ranges, never a
    wrong number.
    """
    wanted = {k: min(MAX_RANGES, n) for k, n in hot.slices.items()}
    fraction = min(1.0, 64 / hot.rows_each, RANGE_SAMPLE / (hot.rows_each * sum(hot.slices.values())))
    sample = df.select(key.alias("__of"), place.alias("__place")).sample(fraction, seed=7)
    places: dict = {}
    for row in sample.orderBy("__place").collect():
        places.setdefault(row[0], []).append(row[1])
    marks = []
    for of, found in places.items():
        step = max(1, len(found) // wanted.get(of, 1))
        marks.append((of, list(dict.fromkeys(found[step::step]))))
    kinds = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    return df.sparkSession.createDataFrame(
        marks, f"__of {kinds['__of']}, __marks array<{kinds['__place']}>"
    )
