"""Write operators of the migration.

Spark has no ``MERGE`` on plain parquet tables, and a migration must not rewrite what it
does not change, so each statement becomes a DataFrame operator that returns both the new
table state and the rows it added:

* D1 insert-only merge -- ``WHEN NOT MATCHED THEN INSERT``: an anti join of the source
  against the (scoped) target keys, then ids, then a union.
* D2 append -- a plain ``INSERT ... SELECT``.
* D3 update-only merge -- ``WHEN MATCHED AND pred THEN UPDATE SET c = v``.
* D4 update from an aggregate -- ``UPDATE ... FROM (SELECT ... GROUP BY)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .keys import max_id_value, number_rows


@dataclass
class MergeResult:
    table: DataFrame      # target after the statement
    inserted: DataFrame   # rows the statement added (what an append-only publish writes)
    numbered: int | None = None  # rows that received new ids (None when no ids were assigned)


def _key_pairs(keys: Sequence[str], source_keys: Sequence[str] | None) -> list[tuple[str, str]]:
    source_keys = list(source_keys) if source_keys is not None else list(keys)
    if len(source_keys) != len(keys):
        raise ValueError("keys and source_keys differ in length")
    return list(zip(keys, source_keys))


def not_matched(source: DataFrame, target: DataFrame, keys: Sequence[str],
                source_keys: Sequence[str] | None = None, target_filter: Column | None = None,
                collation: str | None = None) -> DataFrame:
    """Source rows with no target row of equal key (the USING/ON half of D1).

    * duplicate source rows are all kept (each one is inserted, as in MERGE);
    * a NULL key never matches, so such source rows are kept, and target rows with a NULL
      key are filtered out *before* the shuffle -- for the lineage-keyed merges this prunes
      every row that predates the run (their lineage column is NULL), and parquet skips
      whole row groups on the null count;
    * ``collation`` compares string keys; keys of other types stay as they are;
    * ``target_filter`` carries the constant target predicates of the ON clause
      (``T.BoardID = @BoardID``); Catalyst pushes it to the target scan.
    """
    pairs = _key_pairs(keys, source_keys)
    tgt = target if target_filter is None else target.filter(target_filter)
    for t, _ in pairs:
        tgt = tgt.filter(F.col(t).isNotNull())
    tgt = tgt.select(*[F.col(t).alias(f"_fs_t{i}") for i, (t, _) in enumerate(pairs)])
    cond = None
    for i, (_, s) in enumerate(pairs):
        left, right = source[s], tgt[f"_fs_t{i}"]
        if collation and isinstance(source.schema[s].dataType, StringType):
            left, right = F.collate(left, collation), F.collate(right, collation)
        c = left == right
        cond = c if cond is None else cond & c
    # a broadcast by several keys or by text takes a whole memory page in the driver, however few its rows
    if len(pairs) > 1 or isinstance(source.schema[pairs[0][1]].dataType, StringType):
        tgt = tgt.hint("merge")
    return source.join(tgt, cond, "left_anti")


def insert_only_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                      source_keys: Sequence[str] | None = None, target_filter: Column | None = None,
                      id_col: str | None = None, id_order: Sequence[Column | str] | None = None,
                      id_partitions: int | None = None, collation: str | None = None,
                      stage=None, base_id: int | None = None,
                      attach: Callable[[DataFrame], DataFrame] | None = None) -> MergeResult:
    """D1.  ``source`` carries target column names (plus any extra match columns named in
    ``source_keys``); columns the target has but the source lacks become typed NULLs.
    ``stage`` materialises the key-assignment input (see ``keys.assign_ids``); ``attach`` adds
    payload columns to the numbered rows, so that they cross no numbering shuffle."""
    new_rows = not_matched(source, target, keys, source_keys, target_filter, collation)
    numbered = None
    if id_col is not None:
        base = base_id if base_id is not None else max_id_value(target, id_col)
        res = number_rows(new_rows, id_col, id_order or [c for c in source.columns if c != id_col],
                          base=base, num_partitions=id_partitions, stage=stage)
        new_rows, numbered = res.df, res.count
    if attach is not None:
        new_rows = attach(new_rows)
    inserted = _align(new_rows, target)
    return MergeResult(target.unionByName(inserted), inserted, numbered)


def append(target: DataFrame, source: DataFrame, *, id_col: str | None = None,
           id_order: Sequence[Column | str] | None = None, id_partitions: int | None = None,
           stage=None, base_id: int | None = None) -> MergeResult:
    """Plain INSERT ... SELECT, no key and no dedup."""
    rows, numbered = source, None
    if id_col is not None:
        base = base_id if base_id is not None else max_id_value(target, id_col)
        res = number_rows(rows, id_col, id_order or [c for c in source.columns if c != id_col],
                          base=base, num_partitions=id_partitions, stage=stage)
        rows, numbered = res.df, res.count
    inserted = _align(rows, target)
    return MergeResult(target.unionByName(inserted), inserted, numbered)


def update_only_merge(target: DataFrame, matched: DataFrame, keys: Sequence[str],
                      set_values: Mapping[str, Column], when: Column | None = None) -> DataFrame:
    """D3 ``MERGE ... WHEN MATCHED [AND when] THEN UPDATE SET``.

    ``matched`` has the keys, and may have columns that ``set_values`` and ``when`` use; such names
    must not be columns of the target.  A target row that meets source rows of different values
    is an error, as in the original: the one aggregation that makes the keys distinct also
    compares the values, and the update raises where it would use one of several.  Equal source
    rows update once.  The row count of ``target`` is preserved.
    """
    flag, keys = "_fs_matched", list(keys)
    values = [c for c in matched.columns if c not in keys]
    clash = sorted(set(values) & set(target.columns))
    if clash:
        raise ValueError(f"columns of both sides: {clash}")
    marks = matched.groupBy(*keys).agg(F.count(F.lit(1)).alias("_fs_n"), *[
        F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).alias(v) for v in values])
    several = F.lit(False)
    for v in values:
        held = F.col(v)
        several = several | (held["n"] > 0) & ((held["n"] < F.col("_fs_n")) | (held["lo"] != held["hi"]))
    marks = marks.select(*keys, several.alias("_fs_several"), *[F.col(v)["lo"].alias(v) for v in values], F.lit(True).alias(flag))
    joined = target.join(marks, keys, "left")
    cond = F.col(flag).isNotNull()
    if when is not None:
        cond = cond & F.coalesce(when, F.lit(False))
    cols = []
    for name in target.columns:
        if name in set_values:
            kind = target.schema[name].dataType
            text = F.concat_ws(", ", F.lit(f"{name}: several source rows of different values update the row with key"),
                               *[F.col(k).cast("string") for k in keys])
            wrong = F.when(F.col("_fs_several"), F.raise_error(text).cast(kind))
            new = wrong.otherwise(set_values[name].cast(kind)) if values else set_values[name]
            cols.append(F.when(cond, new).otherwise(F.col(name)).cast(kind).alias(name))
        else:
            cols.append(F.col(name))
    return joined.select(*cols)


def update_from_aggregate(target: DataFrame, aggregate: DataFrame, keys: Sequence[str],
                          set_values: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """D4 ``UPDATE T SET ... FROM T JOIN (aggregate) M ON keys WHERE where``.

    ``aggregate`` must be unique on ``keys`` (it is a GROUP BY on them), so the join never
    multiplies rows; ``set_values`` may reference aggregate columns.
    """
    flag = "_fs_hit"
    agg = aggregate.withColumn(flag, F.lit(True))
    joined = target.join(agg, list(keys), "left")
    cond = F.col(flag).isNotNull()
    if where is not None:
        cond = cond & F.coalesce(where, F.lit(False))
    cols = []
    for name in target.columns:
        if name in set_values:
            cols.append(F.when(cond, set_values[name]).otherwise(F.col(name)).cast(target.schema[name].dataType)
                        .alias(name))
        else:
            cols.append(F.col(name))
    return joined.select(*cols)


def _align(rows: DataFrame, target: DataFrame) -> DataFrame:
    present = set(rows.columns)
    return rows.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ])
