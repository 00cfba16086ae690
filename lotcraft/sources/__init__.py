from lotcraft.sources.readers import load_csv_dir, read_merged_parquet, read_pipe_csv
from lotcraft.sources.staging import cut_lineage, shared_folder
from lotcraft.sources.writers import export_csv_chunks, publish, replace_partitions, write_payload, write_snapshot

__all__ = [
    "cut_lineage",
    "export_csv_chunks",
    "load_csv_dir",
    "publish",
    "read_merged_parquet",
    "read_pipe_csv",
    "replace_partitions",
    "shared_folder",
    "write_payload",
    "write_snapshot",
]
