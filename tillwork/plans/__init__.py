"""Registered queries: Spark plan and equivalent SQL side by side."""

from __future__ import annotations

import importlib

AREAS = (
    "sources_q", "clean_q", "join_q", "reshape_q", "eda_q", "series_q",
    "split_q", "prep_q", "attribution_q", "model_q", "cluster_q", "reco_q", "stream_q",
)


def load_all() -> None:
    """Import every area once, which fills the registry."""
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")
