from .fingerprint import checksum, fingerprint_columns, md5_word, row_hash, row_md5, wrapping_sum
from .names import (
    base_name,
    batch_id,
    dataset_name,
    file_type,
    metadata_path,
    relative_path,
)
from .values import blank, local_time, loose_bool, loose_int, reader_options

__all__ = [
    "base_name",
    "batch_id",
    "blank",
    "checksum",
    "dataset_name",
    "file_type",
    "fingerprint_columns",
    "local_time",
    "loose_bool",
    "loose_int",
    "md5_word",
    "metadata_path",
    "reader_options",
    "relative_path",
    "row_hash",
    "row_md5",
    "wrapping_sum",
]
