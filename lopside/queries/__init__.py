"""Every operator as a runnable query, with SQL that gives the same answer."""

from lopside.queries import (  # noqa: F401  (imported to fill the registry)
    audits, evaluation, files, learners, profiling, scoring, texts, transactions)
from lopside.queries.registry import QUERIES, SQL  # noqa: F401
