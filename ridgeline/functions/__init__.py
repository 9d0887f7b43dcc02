"""Column functions: every one builds a native Spark expression."""

from ridgeline.functions.levels import *  # noqa: F401,F403
from ridgeline.functions.localtime import *  # noqa: F401,F403
from ridgeline.functions.places import *  # noqa: F401,F403
from ridgeline.functions.units import *  # noqa: F401,F403
