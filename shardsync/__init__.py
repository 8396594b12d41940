"""Move and query tables that live in many shards, with Spark."""

from shardsync.functions import *  # noqa: F403
from shardsync.functions import __all__ as _functions
from shardsync.operators import *  # noqa: F403
from shardsync.operators import __all__ as _operators
from shardsync.plans import *  # noqa: F403
from shardsync.plans import __all__ as _plans
from shardsync.sinks import *  # noqa: F403
from shardsync.sinks import __all__ as _sinks
from shardsync.sources import *  # noqa: F403
from shardsync.sources import __all__ as _sources
from shardsync.streaming import *  # noqa: F403
from shardsync.streaming import __all__ as _streaming

__all__ = [*_functions, *_operators, *_plans, *_sinks, *_sources, *_streaming]
