from tessera.sources.tables import TABLES, load, table_path

__all__ = ["TABLES", "load", "table_path"]
