from .tables import read_table  # noqa: F401
from .listing import listing, listing_sql  # noqa: F401
