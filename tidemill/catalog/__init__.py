"""Every operator as a query over the driver's tables, with the SQL that checks it."""

from tidemill.catalog import batch, factors, recommend, streams

MODULES = (batch, recommend, factors, streams)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
