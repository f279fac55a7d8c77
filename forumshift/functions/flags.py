"""Status strings and flag words of topics and messages.

A NULL operand never sets a bit (``CASE WHEN x = 1`` is false for NULL), so every bit is
``when(cond, bit).otherwise(0)`` and the word is their sum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit legends of the target schema and the status names of the source.
TOPIC_LOCKED = 1
TOPIC_DELETED = 8
TOPIC_PERSISTENT = 512
TOPIC_QUESTION = 1024
MSG_HTML = 1
MSG_BBCODE = 2
MSG_SMILIES = 4
MSG_DELETED = 8
MSG_APPROVED = 16
MSG_LOCKED = 32
MSG_PERSISTENT = 512
MSG_BASE = MSG_PERSISTENT + MSG_SMILIES + MSG_HTML          # 517 on every migrated message
LAST_MESSAGE_FLAGS = MSG_PERSISTENT + MSG_APPROVED + MSG_SMILIES + MSG_BBCODE  # 534 (Q16)
STATUS_NAMES = {0: "INFORMATIC", 1: "QUESTION", 3: "SOLVED"}  # anything else -> ''


def _is1(c: Column) -> Column:
    return c == F.lit(1)


def _bit(cond: Column, value: int) -> Column:
    return F.when(cond, F.lit(value)).otherwise(F.lit(0))


def _sum(*terms: Column) -> Column:
    return reduce(lambda a, b: a + b, terms)


def topic_status(status_id: Column) -> Column:
    """E5: simple CASE; 2, other values and NULL give ''."""
    expr = None
    for k, name in STATUS_NAMES.items():
        expr = (F.when(status_id == F.lit(k), F.lit(name)) if expr is None
                else expr.when(status_id == F.lit(k), F.lit(name)))
    return expr.otherwise(F.lit(""))


def topic_flags(topic_deleted: Column, content_deleted: Column, locked: Column, status_id: Column) -> Column:
    """8 if topic or content deleted, +1 locked, +1024 question."""
    return _sum(
        _bit(_is1(topic_deleted) | _is1(content_deleted), TOPIC_DELETED),
        _bit(_is1(locked), TOPIC_LOCKED),
        _bit(status_id == F.lit(1), TOPIC_QUESTION),
    ).cast("int")


def topic_priority(announce: Column, pinned: Column) -> Column:
    """Announce -> 2, else pinned -> 1, else 0 (first match wins)."""
    return F.when(_is1(announce), F.lit(2)).when(_is1(pinned), F.lit(1)).otherwise(F.lit(0)).cast("int")


def first_post_flags(topic_deleted: Column, content_deleted: Column, approved: Column, locked: Column) -> Column:
    """517, +8 topic or content deleted, +16 approved, +32 locked."""
    return _sum(
        F.lit(MSG_BASE),
        _bit(_is1(topic_deleted) | _is1(content_deleted), MSG_DELETED),
        _bit(_is1(approved), MSG_APPROVED),
        _bit(_is1(locked), MSG_LOCKED),
    ).cast("int")


def reply_flags(reply_deleted: Column, reply_approved: Column, topic_locked: Column) -> Column:
    """517, +8 reply deleted (content flag ignored), +16 reply approved, +32 topic locked."""
    return _sum(
        F.lit(MSG_BASE),
        _bit(_is1(reply_deleted), MSG_DELETED),
        _bit(_is1(reply_approved), MSG_APPROVED),
        _bit(_is1(topic_locked), MSG_LOCKED),
    ).cast("int")
