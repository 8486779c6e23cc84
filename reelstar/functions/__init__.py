from reelstar.functions.columns import *  # noqa: F401,F403
from reelstar.functions.columns import DEFAULT_CHANNEL_RULES, EVENT_PAGE_SIZE  # noqa: F401
