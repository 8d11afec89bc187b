"""Importing this module registers every query."""

import importlib

for _module in ("grid", "scalars", "ranges", "structure", "filters", "rules", "pivot", "series", "reshape", "costs", "formulas", "workbooks", "declared", "sheets"):
    importlib.import_module(f"suite.{_module}")
