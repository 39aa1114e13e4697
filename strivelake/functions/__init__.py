"""Column expressions (built-in Spark functions only, no Python UDF)."""
from strivelake.functions.expressions import *  # noqa: F401,F403
