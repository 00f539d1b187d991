"""Sources: raw parquet tables and the store-shaped adapter views over them."""

from storelens.sources.tables import Tables
from storelens.sources import commerce, rental

__all__ = ["Tables", "commerce", "rental"]
