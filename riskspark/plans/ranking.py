"""Row positions and running totals over a whole table, with no single-task window on it.

The table is range-partitioned and sorted once and written to the shared folder. The row id given at that moment
holds (partition, position); a table of one row per partition then supplies the offsets. Equal keys stay in one
partition, so callers end the order with a unique column or aggregate by the order key first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.plans.scratch import persist_table

_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition in the upper bits, row in the lower 33


def ranged(df: DataFrame, order_by: list, tag: str, parts: int | None = None, totals: dict[str, Column] | None = None) -> DataFrame:
    """Globally sorted, stored copy with ``_part`` (rising with the order) and ``_seq`` (position in the part).

    ``parts`` is the number of ranges, that of a shuffle if not given. Each of ``totals`` adds ``_l_<name>``, its sum over the rows
    before this one in the part, counted while the sorted rows are written.
    """
    added = {f"_l_{n}": F.coalesce(c, F.lit(0)).cast("bigint") for n, c in (totals or {}).items()}
    placed = df.select("*", *[c.alias(n) for n, c in added.items()])
    placed = (placed.repartitionByRange(parts, *order_by) if parts else placed.repartitionByRange(*order_by)).sortWithinPartitions(*order_by)
    if added:
        names = list(added)

        def before(batches):
            carry = dict.fromkeys(names, 0)
            for b in batches:
                columns = dict(zip(b.schema.names, b.columns))
                for n in names:
                    run = carry[n] + np.cumsum(columns[n].to_numpy())
                    columns[n] = pa.array(run - columns[n].to_numpy())
                    carry[n] = int(run[-1]) if len(run) else carry[n]
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        placed = placed.mapInArrow(before, T.StructType([T.StructField(f.name, f.dataType) for f in placed.schema.fields]))
    stored = persist_table(placed.withColumn("_mid", F.monotonically_increasing_id()), tag)
    return stored.select(
        *df.columns,
        *added,
        F.shiftright("_mid", _POSITION_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_seq"),
    )


def _part_offsets(parts: DataFrame, names: list[str]) -> DataFrame:
    """Sum over all earlier parts; ``parts`` has one row per partition, so one task is enough."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names]
    )


def global_position(df: DataFrame, order_by: list, out: str = "pos", tag: str = "pos") -> DataFrame:
    """Add the 0-based position in the total order ``order_by`` (which must end in a unique column)."""
    rows = ranged(df, order_by, tag)
    offsets = _part_offsets(rows.groupBy("_part").agg(F.count("*").alias("_t_n")), ["n"])
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_o_n") + F.col("_seq")).alias(out)
    )


def running_totals(df: DataFrame, order_by: list, totals: dict[str, Column], tag: str = "run", parts: int | None = None) -> DataFrame:
    """Add, for each integer expression in ``totals``, its sum over all rows strictly before this one; ``parts`` as in :func:`ranged`."""
    rows = ranged(df, order_by, tag, parts, totals)
    names = list(totals)
    offsets = _part_offsets(
        rows.groupBy("_part").agg(*[F.sum(totals[n]).alias(f"_t_{n}") for n in names]), names
    )
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in names]
    )
