"""DataFrame -> DataFrame operators: staging, dedupe, marts, quality tests."""
