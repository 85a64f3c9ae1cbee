from corvid.sources.tables import load_table, TABLE_NAMES

__all__ = ["load_table", "TABLE_NAMES"]
