"""Trip analytics on Spark: typed ingestion, quality rules, deduplication and layered reports."""

from tripweave.config import PipelineConfig

__all__ = ["PipelineConfig"]
