"""panelspark.sources: scans/sinks (io) and the fixture panels derived from
the provided test tables (fixtures)."""
