"""Refrigerated-freight telemetry analytics, written as Spark DataFrame operators."""
