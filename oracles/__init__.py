"""Expected answers: one DuckDB statement per registered query, over the sample tables.

Written as plain SQL over common table expressions that mirror the binding, independent of the
Spark operators (self joins and subqueries where the operators use windows or partial results).
Money leaves as DOUBLE, ratios rounded to six digits, days and stamps as text.
"""

from __future__ import annotations

from .base import statement
from .core import QUERIES as _core
from .features import QUERIES as _features
from .model import QUERIES as _model

QUERIES: dict[str, str] = {name: statement(sql) for name, sql in {**_core, **_model, **_features}.items()}
