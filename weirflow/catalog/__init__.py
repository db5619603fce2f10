"""Registered queries: a Spark callable each, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from weirflow.catalog import flows, increments, nesting, people, refined, reports, shared, sinks, texts, tree, versions

MODULES = (versions, people, increments, refined, nesting, reports, tree, shared, texts, flows, sinks)


def queries():
    return {name: entry[0] for module in MODULES for name, entry in module.QUERIES.items()}


def oracle_sql():
    return {
        name: entry[1] for module in MODULES for name, entry in module.QUERIES.items() if entry[1] is not None
    }
