"""Plans: model mappings, composite flows, incremental windows and the
driver-table query catalog."""
