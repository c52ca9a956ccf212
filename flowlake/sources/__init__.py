"""Reading inputs: source catalog, seeds, and the test-table role bindings."""
