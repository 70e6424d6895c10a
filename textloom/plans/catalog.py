"""Imports every plan module, which registers its queries."""

from __future__ import annotations

import importlib

from textloom.plans.registry import QUERIES, SQL

MODULES = ["cleaning", "text", "labels", "balance", "retrieval", "scoring", "chat"]

for _name in MODULES:
    importlib.import_module(f"textloom.plans.{_name}")

__all__ = ["QUERIES", "SQL"]
