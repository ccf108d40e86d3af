"""The registry of queries and their SQL oracles."""

from wardgrid.queries import aggregates, artefacts, more, pipelines, problems, problems_sql, registry, scans, spikes_sql, timelines, units_sql  # noqa: F401

QUERIES = {**problems.QUERIES, **registry.QUERIES}
ORACLES: dict[str, str] = {**problems_sql.ORACLES, **units_sql.ORACLES, "p3_found": spikes_sql.P3_FOUND, **registry.ORACLES}
flagship = pipelines.grid_pipeline_hours
