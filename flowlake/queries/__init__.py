"""Registered queries over the driver's test tables, with DuckDB oracles.

Every query reads whole test tables through the role bindings of
``sources.testdata`` and runs a flowlake plan; ``ORACLES`` holds the same
computation as plain SQL over the test views. Doubles that come out of a sum
whose order is not fixed (several doubles added per group) are rounded to 6
decimals on both sides; sums of raw integer amounts are exact DECIMALs.
"""

from flowlake.queries.registry import ORACLES, QUERIES, register

# Section modules register their queries on import; order follows dependencies.
from flowlake.queries import (  # noqa: E402,F401
    transfers, flows, indices, valuation, materializations, data_tests, extras, mechanisms,
)

__all__ = ["ORACLES", "QUERIES", "register"]
