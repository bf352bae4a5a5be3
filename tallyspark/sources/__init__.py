"""Table scans, derived bindings and file sources/sinks."""
