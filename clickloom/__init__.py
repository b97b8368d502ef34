"""Session and event analytics for online stores, as plain Spark plans."""
