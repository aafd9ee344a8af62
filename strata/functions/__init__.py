from strata.functions.exprs import *  # noqa: F401,F403
from strata.functions.exprs import __all__  # noqa: F401
