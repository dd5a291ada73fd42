"""All queries and checking SQL of the library."""

from __future__ import annotations

from . import backtest, company, features, files, labels, market, universe

MODULES = [features, labels, market, backtest, company, universe, files]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
