from mercato.sources.tables import Tables, demand, tracking, SCHEMAS  # noqa: F401
