"""Query plans over the test tables and join-planning helpers.

Importing the ``q_*`` modules registers their queries.
"""

from __future__ import annotations


def _load():
    from basalt.plans import q_cluster, q_graph, q_linear, q_profile, q_relational, q_sources, q_tree  # noqa: F401


def all_queries():
    _load()
    from basalt.plans.registry import QUERIES

    return QUERIES


def all_oracles():
    _load()
    from basalt.plans.registry import ORACLES

    return ORACLES
