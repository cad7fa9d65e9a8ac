from tierlake.sources.csv import discover_years, read_year_csv
from tierlake.sources.layers import layer_years, leaf_path, leaf_years, read_layer
from tierlake.sources.zipcsv import ZipCsvDataSource, register as register_zipcsv

__all__ = [
    "ZipCsvDataSource",
    "discover_years",
    "layer_years",
    "leaf_path",
    "leaf_years",
    "read_layer",
    "read_year_csv",
    "register_zipcsv",
]
