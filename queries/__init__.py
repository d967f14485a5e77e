"""Registered queries, one module per section of the operator inventory."""


def all_queries():
    from queries import (anomaly, cleaning, demand, grouping, modelling, quality, runs, scans, schemas, series,  # noqa
                         sinks, streams)
    from queries.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
