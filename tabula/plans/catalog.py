"""Import every query module so that the registry is complete."""

from __future__ import annotations

from tabula.plans import (basics, charts, grouping, missing, relational,  # noqa: F401
                          formats, modelling, scalars, statistics, userfuncs)
from tabula.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)
