"""All registered queries."""

from shelfcast.catalog.base import Query


def all_queries() -> dict[str, Query]:
    from shelfcast.catalog import forecasts, groups, rows

    return {**rows.QUERIES, **groups.QUERIES, **forecasts.QUERIES}
