from strata.sources import fixtures, pages, catalog  # noqa: F401
