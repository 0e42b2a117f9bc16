from rollbook.sinks.writers import write_parquet, write_text

__all__ = ["write_parquet", "write_text"]
