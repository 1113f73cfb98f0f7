"""Read API, presentation tables and batch jobs."""
