"""String expressions: prefixes, lower case, GUIDs and name comparison under a collation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def left(col: Column | str, n: int) -> Column:
    """E4 ``Left(s, n)``; NULL stays NULL.  Counts UTF-16 units as T-SQL does, where a character beyond
    U+FFFF has two.  The half of such a character that a cut would leave is not a character and
    cannot be stored, so it goes: the prefix is then n - 1 units long.

    Plain ASCII, told by its length in bytes, takes the short way; nothing leaves the JVM."""
    c = F.col(col) if isinstance(col, str) else col
    units = F.encode(c, "UTF-16BE")
    cut = F.substring(units, 1, 2 * n)
    last = F.hex(F.substring(units, 2 * n - 1, 2))
    half = last.between("D800", "DBFF")
    return (F.when(F.octet_length(c) == F.length(c), F.substring(c, 1, n))
            .when(F.octet_length(units) <= 2 * n, c)
            .when(half, F.decode(F.substring(units, 1, 2 * n - 2), "UTF-16BE"))
            .otherwise(F.decode(cut, "UTF-16BE")))


def lowered(col: Column | str) -> Column:
    """E13 ``Lower(s)``."""
    return F.lower(F.col(col) if isinstance(col, str) else col)


def guid_from_hex(hex32: Column) -> Column:
    """Format 32 hex digits as a GUID ``8-4-4-4-12``."""
    return F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4), F.substring(hex32, 13, 4),
                       F.substring(hex32, 17, 4), F.substring(hex32, 21, 12))


def name_guid(*parts: Column) -> Column:
    """E12 in deterministic form: a GUID derived from md5 of the parts.

    Unlike ``NewID()`` it yields the same value when a task is retried or a plan is
    recomputed, so ids never change under executor loss.
    """
    return guid_from_hex(F.md5(F.concat_ws("\u0001", *parts)))


def random_guid() -> Column:
    """E12 literal ``NewID()``; the result must be materialised before it is read twice."""
    return F.expr("uuid()")


def name_key(col: Column | str, collation: str | None) -> Column:
    """Q10: the value used to compare names; with a collation such as ``UTF8_LCASE_RTRIM``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.collate(c, collation) if collation else c
