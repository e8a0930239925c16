"""Part of the classification-data engine."""
