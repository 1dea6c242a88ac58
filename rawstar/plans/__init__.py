"""The data products: Silver, inferred members, Gold, batch control, whole pipeline."""
