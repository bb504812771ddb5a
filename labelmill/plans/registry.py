"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from labelmill.plans import archives, audits, corpus, generation, signals, stages, texts

MODULES = [corpus, texts, audits, signals, generation, archives, stages]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
