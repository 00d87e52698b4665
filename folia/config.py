"""Settings shared by all jobs."""

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    # The defaults are part of the results.
    input_bucket: str = "corporate-raw-docs"
    output_bucket: str = "corporate-processed-docs"
    chunk_size: int = 1024
    chunk_overlap: int = 200
    embedding_dimensions: int = 768
    vector_table: str = "document_chunks"
    # ``None``: all pending files.
    max_files_per_run: int | None = 50
    top_k: int = 10
    # The folder of an index that stored vectors are added to; empty: none.
    vector_index: str = ""
    # The folder of a log of vectors that takes the table's place; empty: none.
    vector_log: str = ""

    def __post_init__(self):
        if self.chunk_overlap > self.chunk_size:
            raise ValueError("chunk_overlap is larger than chunk_size")

    @classmethod
    def from_env(cls) -> "Settings":
        """Defaults, overridden by environment variables named like the fields in capitals."""
        given = {}
        for field in fields(cls):
            value = os.environ.get(field.name.upper())
            if value is not None:
                if field.name == "max_files_per_run":
                    given[field.name] = int(value) if value else None
                else:
                    given[field.name] = field.type(value)
        return cls(**given)
