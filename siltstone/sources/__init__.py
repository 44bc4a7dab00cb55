from siltstone.sources.remote import align_columns, jdbc_source, parquet_source
from siltstone.sources.retail import RetailSource

__all__ = ["RetailSource", "align_columns", "jdbc_source", "parquet_source"]
