"""Registered queries: every operator run over the whole given tables, with SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from voxframe.catalog.base import REGISTRY

for _module in (
    "splitting",
    "reading",
    "writing",
    "projecting",
    "filtering",
    "joining",
    "aggregating",
    "sequencing",
    "ranking",
    "uniting",
    "wording",
    "listing",
    "measuring",
    "aligning",
    "streaming",
    "composing",
    "checking",
):
    import_module(f"voxframe.catalog.{_module}")

__all__ = ["REGISTRY"]
