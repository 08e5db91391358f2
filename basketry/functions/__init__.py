from basketry.functions.exprs import *  # noqa: F401,F403
from basketry.functions import exprs  # noqa: F401
