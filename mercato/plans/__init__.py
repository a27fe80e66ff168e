from mercato.plans.registry import REGISTRY, Query, load_all, register  # noqa: F401
