"""wattgrid: hourly-panel analytics on Spark (DataFrame API, no UDFs).

The names below mirror the public functions a user of the original pipeline
calls, with Spark-first signatures (a session or DataFrame first, lazy
DataFrames out).
"""
from .operators.panel import build_main_panel  # noqa: F401
from .operators.quality import handle_dst_transitions  # noqa: F401
from .operators.timeaxis import add_time_features, normalize_to_utc  # noqa: F401
from .operators.timeaxis import hour_spine as create_hour_index  # noqa: F401
from .session import get_session  # noqa: F401
from .sources.catalog import create_tables as create_schema  # noqa: F401
from .sources.catalog import (describe_schema, execute_query, get_row_count,  # noqa: F401
                              get_table_info, table_exists)

__version__ = "0.1.0"
