"""Time expressions.  Everything stays ``timestamp_ntz``: no session-zone dependence."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = _dt.datetime(1970, 1, 1)


def ts_literal(value: _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (E14 ``GetUTCDate()`` is captured once per run as this)."""
    return F.lit(value.replace(tzinfo=None)).cast("timestamp_ntz")


def shift_minutes(ts: Column | str, minutes: int, source_tz: str | None = None) -> Column:
    """E1 ``DateAdd(n, @TZOffsetMin, ts)``; with ``source_tz`` (Q11) a zone-aware conversion."""
    col = F.col(ts) if isinstance(ts, str) else ts
    if source_tz:
        return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), col).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", F.lit(int(minutes)), col)


def epoch_seconds_to_ts(seconds: Column | str) -> Column:
    """E2 ``DateAdd(ss, x, '01/01/1970')``: NULL in, NULL out."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_add("SECOND", col.cast("bigint"), ts_literal(EPOCH))
