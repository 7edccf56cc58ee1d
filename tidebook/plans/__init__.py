"""Plan-level helpers: durable intermediates and range planning."""
