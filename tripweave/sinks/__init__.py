"""Writers for datasets."""

from tripweave.sinks.tables import read_dataset, spread, write_dataset, write_partitions

__all__ = ["read_dataset", "spread", "write_dataset", "write_partitions"]
