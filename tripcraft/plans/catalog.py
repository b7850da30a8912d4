"""All registered queries and oracle twins (importing a module registers its queries)."""

from tripcraft.plans import q_explore, q_loadtest, q_ml, q_models, q_stream  # noqa: F401
from tripcraft.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
