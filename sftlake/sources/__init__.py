"""Sources and sinks with explicit schemas."""
