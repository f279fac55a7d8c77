"""Column expressions of the migration; all built-in, codegen-friendly."""

from .casts import to_date_strict, to_smallint  # noqa: F401
from .flags import (first_post_flags, reply_flags, topic_flags, topic_priority,  # noqa: F401
                    topic_status)
from .temporal import epoch_seconds_to_ts, shift_minutes, ts_literal  # noqa: F401
from .text import left, lowered, name_guid, name_key, random_guid  # noqa: F401
