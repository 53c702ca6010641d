"""Sources: specs, loading, freshness, and the test-data adapter."""
