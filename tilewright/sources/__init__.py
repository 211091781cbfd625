"""Sources and sinks: folders, plain images, tables."""
