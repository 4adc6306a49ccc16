"""All registered queries: name -> (spark callable, oracle SQL factory or None)."""

from __future__ import annotations

import importlib

_MODULES = [
    "decisionops.plans.policy_queries",
    "decisionops.plans.report_queries",
    "decisionops.plans.data_queries",
    "decisionops.plans.model_queries",
    "decisionops.plans.scorecard_queries",
    "decisionops.plans.ml_queries",
    "decisionops.plans.stream_queries",
    "decisionops.plans.report",
]


def registry() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(importlib.import_module(m).QUERIES)
    return out
