"""parcelwise: incremental date-partition management for Spark tables.

Plan calendar ranges from a small spec, tag rows with their partition,
diff against what exists, write the missing partitions, pick a refresh set
and recompute only that set -- all as Spark DataFrame plans.
"""

from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .session import build_session, shared_dir  # noqa: F401
