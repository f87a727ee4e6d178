"""Upserts, replaces, anti-joins and reconciliation as functions from DataFrames to DataFrames. None broadcasts by hint, and only numbered collects: the bounds of its ranges and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; the order should end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equal keys; nulls are equal to each other, so that a null key is not added again on each run."""
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def one_per_key(source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """What a conflict rule needs: one row a key, the first in the given order; without one the greatest of the other columns."""
    order = order or [F.desc(c) for c in source.columns if c not in keys]
    return latest_per_key(source, keys, order) if order else source.dropDuplicates(keys)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None, stamp: Column | None = None) -> DataFrame:
    """Source rows take the place of target rows of the same key; columns the target lacks are left out, those the source lacks stay.

    A key that the source repeats counts once (one_per_key). stamp: the value of updated_at in the rows that the source writes.
    """
    cols = [c for c in target.columns if c in source.columns]
    new = one_per_key(source.select(*cols), keys, order).select(F.struct(*cols).alias("__new"), *[F.col(k).alias(f"__{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    comes = F.col("__new").isNotNull()
    value = lambda c: F.when(comes, stamp).otherwise(F.col(c)) if stamp is not None and c == "updated_at" else F.when(comes, F.col("__new")[c]).otherwise(F.col(c)) if c in cols else F.col(c)
    return target.join(new, on, "full").select(*[value(c).alias(c) for c in target.columns])


def flatten_children(parents: DataFrame, children: str, keep: list[str]) -> DataFrame:
    """One row for each element of the array of structs, with the parent's attributes; parents without children have none."""
    return parents.select(*keep, F.inline(children))


def replace_children(target: DataFrame, parents: DataFrame, children: DataFrame, parent_key: str) -> DataFrame:
    """All children of the given parents go, the new ones come."""
    return target.join(parents.select(parent_key).distinct(), parent_key, "left_anti").select(*target.columns).unionByName(children.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Source rows whose key the target lacks come, one a key; nothing is overwritten, and a second run adds nothing. Null keys are keys."""
    new = one_per_key(source, keys, order)
    return target.unionByName(new.join(target.select(*keys), _same(new, target, keys), "left_anti").select(*target.columns))


def delete_orphans(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """The parents that some child refers to."""
    return parents.join(children.select(key), key, "left_semi")


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """Both tables' rows; columns of only one are added to the other as null text."""
    extra = [c for c in source.columns if c not in target.columns]
    wide = target.select("*", *[F.lit(None).cast("string").alias(c) for c in extra])
    src = source.select(*[F.col(c).cast("string").alias(c) if c in extra else F.col(c) for c in source.columns])
    return wide.unionByName(src, allowMissingColumns=True)


def reconcile(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of both with a status: added, stale or kept."""
    a = existing.select(*keys).distinct().withColumn("__old", F.lit(True))
    b = new.select(*keys).distinct().withColumn("__new", F.lit(True))
    status = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "stale").otherwise("kept")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def unchanged(source: DataFrame, state: DataFrame, key: str, digest: str) -> DataFrame:
    """Source rows that were not pushed with this digest yet."""
    return source.join(state.where("last_status = 'pushed'").select(key, digest), [key, digest], "left_anti").select(*source.columns)


def contained(words: DataFrame, regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Words whose centre lies in a region of their page, edges included. The join is on the page; the boxes filter its rows."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    boxes = regions.select(page, "region_id", *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    return words.join(boxes, page).where((x >= F.col("_x0")) & (x <= F.col("_x1")) & (y >= F.col("_y0")) & (y <= F.col("_y1"))).drop("_x0", "_y0", "_x1", "_y1")


def islands(df: DataFrame, keys: list[str], order: str, label: str, out: str = "segment") -> DataFrame:
    """A running number of each run of equal labels."""
    w = Window.partitionBy(*keys).orderBy(order)
    start = F.coalesce(~F.col(label).eqNullSafe(F.lag(label).over(w)), F.lit(True)) | (F.row_number().over(w) == 1)
    return df.withColumn("__start", start.cast("int")).withColumn(out, F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__start")


def gap_groups(df: DataFrame, keys: list[str], order: str, gap: float, out: str = "grp") -> DataFrame:
    """A new group where the distance to the element before is above the gap."""
    w = Window.partitionBy(*keys).orderBy(order)
    far = F.coalesce((F.col(order) - F.lag(order).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("__far", far).withColumn(out, F.sum("__far").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("__far")


def numbered(df: DataFrame, order: list[Column], out: str = "number") -> DataFrame:
    """Adds each row's place from 1 in ascending order, which should end in a unique column. Ranges of rows are sorted apart and shifted by the counts of those before; no task has all rows."""
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    some = keyed.select("__key").where(F.rand(1) < 100.0 * n / max(1, df.count())).orderBy("__key").collect()
    bounds = [r["__key"] for r in some[:: max(1, -(-len(some) // n))][1:]]
    types = keyed.schema["__key"].dataType.fields
    lits = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, types)]) for b in bounds]
    dealt = keyed.withColumn("__range", F.size(F.filter(F.array(*lits), lambda b: b <= F.col("__key"))) if lits else F.lit(0))
    counts = dict(dealt.groupBy("__range").count().collect())
    before = [sum(counts.get(j, 0) for j in range(i)) for i in range(len(bounds) + 1)]
    shift = F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), F.col("__range"))
    return dealt.withColumn(out, shift + F.row_number().over(Window.partitionBy("__range").orderBy("__key"))).drop("__key", "__range")


def merged_maps(old: Column, new: Column) -> Column:
    """The keys of both maps; the new one's values win."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)
