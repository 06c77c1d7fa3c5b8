"""Registered queries over the test tables and the SQL they must agree with."""

from silverloom.workloads import answers, checks, files, mutation, silver

_MODULES = (answers, silver, mutation, checks, files)


def all_queries():
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def all_sql():
    return {name: text for m in _MODULES for name, text in m.SQL.items()}
