from subpulse.sources.readers import SourceRegistry, read_csv, read_parquet
from subpulse.sources.tables import Tables, from_driver_tables, from_registry

__all__ = ["SourceRegistry", "Tables", "from_driver_tables", "from_registry", "read_csv", "read_parquet"]
