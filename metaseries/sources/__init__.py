"""Sources: record trees, schema files, dimension tables, adapters over plain tables."""
