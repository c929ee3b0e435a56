"""Sources and sinks: test tables, bindings to raw payloads, landing files."""
