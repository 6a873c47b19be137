"""Column-level helpers (scalar expressions S1-S24, filters P9-P13).

All of them build Catalyst expressions from ``pyspark.sql.functions``; none
is a Python UDF, so they stay inside whole-stage codegen.
"""

from tidemark.functions.scalars import *  # noqa: F401,F403
from tidemark.functions.predicates import *  # noqa: F401,F403
