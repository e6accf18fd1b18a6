"""Column -> Column scalar functions (JVM built-ins only, codegen friendly)."""
from portrait.functions.scalars import *  # noqa: F401,F403
