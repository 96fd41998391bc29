"""Device telemetry lake: Bronze, Silver and Gold as Spark DataFrame operators."""
