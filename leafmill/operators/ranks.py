"""Places and least rows without a window over everything or over a whole hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.sources.shared import stage

#: Parts into which a key is dealt before its least rows meet.
SALT = 32
_INSIDE = (1 << 33) - 1  # monotonically_increasing_id: the partition above, the row below


def with_place(rows: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``rows`` with their place (from 1) in ``order`` over the whole table; ties get places in no stated order.

    Rows are sorted over range partitions and numbered inside each; the partitions' counts, one row
    for each, give what has to be added.  The numbered rows are written once, since the offsets hold
    for one dealing only.
    """
    numbered = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", 33)
    before, offsets = 0, []
    for p, n in sorted(tuple(r) for r in numbered.groupBy(part.alias("p")).count().collect()):  # a row for each partition
        offsets.append((p, before))
        before += n
    added = rows.sparkSession.createDataFrame(offsets or [(0, 0)], "_part long, _before long")
    return numbered.withColumn("_part", part).join(F.broadcast(added), "_part").withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(_INSIDE) + 1).drop("_part", "_before", "_id")


def k_least(rows: DataFrame, keys: list[str], order: list[str], k: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their place.

    Mergeable: each task keeps k rows of a key before anything is shuffled, ``SALT`` parts of the
    key keep k of those, and only k * SALT rows of a key meet at last.
    """
    # the salt hangs on the order alone, which is enough: rows beyond k of one part are beyond k of all
    place = lambda *more: F.row_number().over(Window.partitionBy(*keys, *more).orderBy(*order))
    some = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALT))).withColumn(name, place("_salt")).where(F.col(name) <= k)
    return some.drop("_salt", name).withColumn(name, place()).where(F.col(name) <= k)
