"""Run parameters: the script's variables (``@oModuleID``, ``@tplBoardID`` ...) and the options
that choose between the literal text of the reference and its evident intent (Q-list)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


def server_tz_offset_minutes() -> int:
    """``- DATEPART(TZOFFSET, SYSDATETIMEOFFSET())`` -- minus the driver's current UTC offset."""
    offset = _dt.datetime.now().astimezone().utcoffset() or _dt.timedelta(0)
    return -int(offset.total_seconds() // 60)


@dataclass(frozen=True)
class RunParams:
    module_id: int = -1                 # @oModuleID; -1 means "not chosen" and fails fast (Q7)
    template_board_id: int = 1          # @tplBoardID
    tz_offset_min: int | None = None    # @TZOffsetMin; None -> server_tz_offset_minutes()
    run_ts: _dt.datetime | None = None  # GetUTCDate(), captured once per run (E14)
    # The application names the source portal registers itself under, and the
    # application name written into every migrated profile.
    app_names: tuple[str, ...] = ("DotNetNuke", "DNN")
    profile_application_name: str = "DotNetNuke"

    # literal vs intent (SURVEY Q-list); defaults follow the survey decisions
    exclude_portal_roles: bool = True           # Q2: literal NOT IN of the module portal's roles
    forum_full_depth: bool = False              # Q3/Q4: literal = one hop below the roots, by name;
                                                # True = every level, by lineage
    replies_to_first_post_only: bool = True     # Q5: intent, equal to literal on a first run
    require_posts: bool = False                 # Q6: literal (no NumPosts > 0 filter)
    fail_if_board_exists: bool = True           # Q7
    board_scoped_attachment_authors: bool = True  # Q8: intent
    name_collation: str | None = None           # Q10: e.g. "UTF8_LCASE_RTRIM"; None = binary
    source_tz: str | None = None                # Q11: convert with a zone instead of a constant
    tolerant_casts: bool = False                # Q22: try_cast instead of failing the run
    deterministic_role_ids: bool = True         # E12: name-derived GUIDs (recompute-safe)

    # physical knobs
    id_partitions: int | None = None            # partitions of the range shuffle in key assignment

    def resolved(self) -> "RunParams":
        tz = self.tz_offset_min if self.tz_offset_min is not None else server_tz_offset_minutes()
        ts = self.run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return replace(self, tz_offset_min=tz, run_ts=ts)
