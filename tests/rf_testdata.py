"""Paths of the driver tables used by the tests (its own module: ``conftest`` is not a unique name)."""

SF_SMALL = "/root/testdata/sf0.001"
