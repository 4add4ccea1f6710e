"""Event-time path: landing, hourly averages and daily modal condition on streams."""
