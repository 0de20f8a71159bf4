from tideline.sources.raw_csv import read_raw_csv
from tideline.sources.tables import read_bronze, read_bronze_range, read_gold, read_silver

__all__ = ["read_bronze", "read_bronze_range", "read_gold", "read_raw_csv", "read_silver"]
