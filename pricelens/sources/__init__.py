from pricelens.sources.tables import listings, dirty_listings, read_table  # noqa: F401
from pricelens.sources.files import (  # noqa: F401
    read_listings_csv, write_lines, write_table, write_encoding_map, read_encoding_map,
)
