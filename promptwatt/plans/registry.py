"""Collects every registered query module into one registry."""

from __future__ import annotations

from . import catalog
from . import catalog_logs  # noqa: F401  (registers on import)
from . import catalog_rewrite  # noqa: F401
from . import catalog_ml  # noqa: F401
from . import catalog_more  # noqa: F401
from . import catalog_near  # noqa: F401
from . import catalog_models  # noqa: F401
from . import catalog_streams  # noqa: F401
from . import catalog_hooks  # noqa: F401

REGISTRY = catalog.REGISTRY
