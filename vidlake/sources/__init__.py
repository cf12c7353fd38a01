"""Sources and sinks: landed files, catalog tables, the test-table adapter."""
