"""rawstar: dirty CSV / TXT / XML / JSON files to a clean star schema, on Spark."""

from rawstar.plans.pipeline import PipelineOptions, run_pipeline
from rawstar.sources.lake import Lake

__all__ = ["Lake", "PipelineOptions", "run_pipeline"]
