"""Merge partial rows into a table by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _merged(new: Column, old: Column, new_type: DataType, old_type: DataType) -> Column:
    """The new value where there is one, else the old; families are merged column by column."""
    if not (isinstance(new_type, StructType) and isinstance(old_type, StructType)):
        return F.coalesce(new, old)
    new_fields = {f.name: f.dataType for f in new_type.fields}
    fields = [
        (_merged(new[f.name], old[f.name], new_fields[f.name], f.dataType)
         if f.name in new_fields else old[f.name]).alias(f.name)
        for f in old_type.fields
    ]
    known = {f.name for f in old_type.fields}
    fields += [new[name].alias(name) for name in new_fields if name not in known]
    return F.when(new.isNotNull() | old.isNotNull(), F.struct(*fields))


def one_row_per_key(updates: DataFrame, key: str, order: str | None) -> DataFrame:
    """Keep one whole row per key: that of the greatest ``order``, among equals the greatest row.

    Grouping is on the join key, so it adds no shuffle to the merge after it.
    """
    row = F.struct(*[F.col(n) for n in updates.columns if n not in (key, order)])
    chosen = F.max(F.struct(F.col(order).alias("_order"), row.alias("_row")) if order else F.struct(row.alias("_row")))
    return updates.groupBy(key).agg(chosen.alias("_chosen")).select(key, "_chosen._row.*")


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Insert new keys and overwrite the given columns of known ones.

    A column that the update leaves null, or does not have, keeps its old value.
    An array is replaced whole. ``base`` has one row per key. Of updates that share a key
    one whole row counts, that of the greatest ``order``, a column that is not stored; without
    one the greatest row.
    """
    if set(updates.columns) <= {key, order}:
        folded = updates.select(key).distinct()
    else:
        folded = one_row_per_key(updates, key, order)
    updates = updates.drop(order) if order else updates
    old, new = base.alias("old"), folded.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    base_types = {f.name: f.dataType for f in base.schema.fields}
    new_types = {f.name: f.dataType for f in updates.schema.fields}
    columns = []
    for name in base.columns:
        was = F.col(f"old.{name}")
        if name in new_types:
            was = _merged(F.col(f"new.{name}"), was, new_types[name], base_types[name])
        columns.append(was.alias(name))
    columns += [F.col(f"new.{n}").alias(n) for n in updates.columns if n not in base_types]
    return joined.select(*columns)
