"""flowlake: token-flow time series on Spark DataFrames.

Raw event logs (transfers, mints, burns, deposits, index updates) become
normalised transfers, daily net issuance on a dense calendar, forward-filled
yield indices, running balances, USD valuations and weekly / monthly activity
statistics. Results are written as partitioned Parquet by full-rebuild,
delete+insert, merge and append-with-dedup writers; data-quality checks are
queries that return failing rows.
"""

from flowlake.context import RunContext
from flowlake.session import build_session, workspace_dir

__all__ = ["RunContext", "build_session", "workspace_dir"]
