"""Table builders, star model, marts, quality suites and the refresh job."""
