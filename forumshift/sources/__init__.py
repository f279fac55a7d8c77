"""Table sources: fixed-schema readers and the driver-table fixture."""

from .driver_fixture import fixture_params, fixture_sources, fixture_targets  # noqa: F401
from .tables import read_sources, read_tables, read_targets  # noqa: F401
