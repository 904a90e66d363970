from lakeshore.functions.scalar import *  # noqa: F401,F403
from lakeshore.functions.scalar import __all__  # noqa: F401
