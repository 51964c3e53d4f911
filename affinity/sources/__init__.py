"""Readers and writers: interaction / id-map scans (CSV and Parquet with an
explicit schema), fixture views over the driver tables, and sinks."""

from affinity.sources.tables import (
    INTERACTION_SCHEMA,
    ITEM_MAP_SCHEMA,
    read_interactions_csv,
    read_item_map_csv,
    read_parquet,
    read_table,
)
from affinity.sources.fixtures import fx_interactions, fx_item_map, fx_readers
from affinity.sources.sinks import materialize, write_parquet, write_small_csv, write_splits

__all__ = [
    "INTERACTION_SCHEMA", "ITEM_MAP_SCHEMA", "read_interactions_csv", "read_item_map_csv",
    "read_parquet", "read_table", "fx_interactions", "fx_item_map", "fx_readers",
    "materialize", "write_parquet", "write_small_csv", "write_splits",
]
