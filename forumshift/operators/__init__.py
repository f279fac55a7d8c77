"""Reusable relational operators."""

from .eav import duplicate_properties, pivot_properties  # noqa: F401
from .joins import not_in, product_join  # noqa: F401
from .keys import assign_ids  # noqa: F401
from .lineage import add_lineage, drop_lineage  # noqa: F401
from .lookups import resolve  # noqa: F401
from .merge import (MergeResult, append, insert_only_merge, not_matched,  # noqa: F401
                    update_from_aggregate, update_only_merge)
