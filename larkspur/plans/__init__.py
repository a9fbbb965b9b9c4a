"""Registered queries over the given tables, each with the SQL that checks it where SQL can."""

from larkspur.plans import (  # noqa: F401
    churn,
    evaluation,
    messages,
    modelling,
    oversampling,
    pages,
    retrieval,
    scoring,
)
from larkspur.plans.registry import ORACLES, QUERIES
from larkspur.session import ship_package


def _runnable(query):
    return lambda spark, folder: query(ship_package(spark), folder)


def all_queries():
    return {name: _runnable(query) for name, query in QUERIES.items()}


def all_oracles():
    return dict(ORACLES)
