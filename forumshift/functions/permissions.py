"""Permission strings (survey 2.12): ``0;13;|1134;||``.

Four parts divided by ``|`` -- role ids, user ids, ids of groups whose owners hold it, and one more --
each a list of ids that end in ``;`` or ``:``.  The original describes them and copies none.
``grants`` turns strings into one row per grant, ``joined`` turns grants back into strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The parts in their order, and the two characters that end an id.
PARTS = ("role", "user", "group_owner", "other")
ENDS = "[;:]"


def grants(df: DataFrame, permission_col: str, *keys: str) -> DataFrame:
    """(*keys, Part, Place, ID): a row per id, numbered within its part from 0.

    Empty lists give no rows, a NULL string none; an id that is not a number, or a string of more
    than four parts, fails the run."""
    c = F.col(permission_col)
    parts = F.split(c, "\\|")
    checked = F.when(F.size(parts) <= len(PARTS), parts).otherwise(
        F.raise_error(F.concat(F.lit("more than four parts: "), c)).cast("array<string>"))
    rows = df.filter(c.isNotNull()).select(*keys, F.posexplode(checked).alias("_part", "_ids"))
    named = F.element_at(F.array(*[F.lit(p) for p in PARTS]), F.col("_part") + 1)
    ids = F.filter(F.split(F.trim("_ids"), ENDS), lambda x: F.trim(x) != "")
    return rows.select(*keys, named.alias("Part"), F.posexplode(ids).alias("Place", "_id")).select(
        *keys, "Part", F.col("Place").cast("long").alias("Place"), F.trim("_id").cast("long").alias("ID"))


def joined(rows: DataFrame, *keys: str) -> DataFrame:
    """(*keys, Permissions): the grants of each key as a string, ids in the order of their places."""
    def ids(part: str) -> Column:
        own = F.collect_list(F.when(F.col("Part") == part, F.struct("Place", "ID")))
        return F.concat_ws("", F.transform(F.array_sort(own), lambda x: F.concat(x["ID"].cast("string"), F.lit(";"))))
    return rows.groupBy(*keys).agg(F.concat_ws("|", *[ids(p) for p in PARTS]).alias("Permissions"))
