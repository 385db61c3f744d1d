"""Column-level functions (no shuffles): dates, numbers, flags."""

from .flags import *  # noqa: F401,F403
from .numeric import *  # noqa: F401,F403
from .temporal import *  # noqa: F401,F403
