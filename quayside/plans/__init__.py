"""Query plans: adapters from the test tables to fare-data shapes, and the query registry."""
