"""The queries of this subpackage and their SQL, as ``__spark_entry__`` adds them."""

from __future__ import annotations

from rebuy.llm import queries01, queries02, queries03, queries04, queries05, queries06, queries07, queries08, queries09, queries10, queries11, queries12, queries13

_MODULES = [queries01, queries02, queries03, queries04, queries05, queries06, queries07, queries08, queries09, queries10, queries11, queries12, queries13]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
