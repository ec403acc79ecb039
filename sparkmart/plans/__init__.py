"""The retail warehouse: entities, star schema, measures, profiling and run ledger."""
