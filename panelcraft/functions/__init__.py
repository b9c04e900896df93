"""Column expressions (all JVM-side, no UDFs)."""

from panelcraft.functions.expressions import *  # noqa: F401,F403
