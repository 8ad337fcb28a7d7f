"""Support-ticket analytics, text classification and retrieval as Spark DataFrame operators."""
