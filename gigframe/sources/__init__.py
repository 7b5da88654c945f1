"""Sources and sinks: schemas, CSV and JSON readers, landing, adapters."""
