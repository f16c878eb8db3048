"""Topic, change-log, configuration and lookup-table readers."""
