"""dictspark: Spark DataFrames over dictionary-typed enterprise tables."""

from .sources.catalog import Catalog, attach
from .sources.extract import decode_extract, encode_extract
from .sources.reader import read_table

__all__ = ["Catalog", "attach", "decode_extract", "encode_extract", "read_table"]
