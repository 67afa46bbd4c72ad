"""Sources and sinks: raw envelopes, request manifests, JDBC, file tables."""
