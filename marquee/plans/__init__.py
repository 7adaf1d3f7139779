"""Report plans (DataFrame -> DataFrame) and the registered query catalogue."""
