"""Sources and sinks: fixture adapters, CSV ingestion, snapshot tables."""
