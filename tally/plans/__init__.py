"""Query plans: the model graph from raw tables to the reporting marts."""
