"""Column functions: typing, masks, health score, interval predicates."""

from .expressions import *  # noqa: F401,F403
