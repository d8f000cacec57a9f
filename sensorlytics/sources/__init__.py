"""Sources: fixture derivations, text/JSON/CSV ingest with rejects, power-log files."""
