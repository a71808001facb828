"""Sources (scans) and sinks."""
