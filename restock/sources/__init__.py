from restock.sources.adapters import DriverTables  # noqa: F401
from restock.sources.csv import read_new_items, read_recommendations, read_history, split_rejects  # noqa: F401
from restock.sources.region_map import region_map  # noqa: F401
from restock.sources.warehouse import WarehouseTables  # noqa: F401
