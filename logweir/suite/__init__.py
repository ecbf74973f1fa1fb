"""Every operator as a query over the given tables, with its SQL counterpart."""

from logweir.suite import catalogue, cleaning, countries, files, flagship, locations, web

_PARTS = (cleaning, locations, countries, catalogue, web, files, flagship)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: text for part in _PARTS for name, text in part.SQL.items()}
