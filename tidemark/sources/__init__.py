from tidemark.sources.csv_folder import load_csv_folder, table_name
from tidemark.sources.documents import read_document
from tidemark.sources.shop import ShopTables
from tidemark.sources.star import star_tables

__all__ = ["ShopTables", "load_csv_folder", "read_document", "star_tables", "table_name"]
