"""Raw text sources, layered tables and report sinks."""
