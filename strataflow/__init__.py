"""Spark-native medallion analytics: Bronze scans, Silver contracts, Gold star schema, ops and universes."""
