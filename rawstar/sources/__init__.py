"""Reading raw files with lineage and keeping the layered tables."""
