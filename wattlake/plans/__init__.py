"""Jobs composed of the operators: Silver loads, Gold builds and the whole run."""
