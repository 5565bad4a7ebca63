"""tidemart: layered city-data marts as plain Spark DataFrame code."""
