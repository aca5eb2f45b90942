"""Made-up transaction messages for tests, the benchmark and the registered queries."""
