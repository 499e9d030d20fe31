from strata.sources.dirty import dirty_orders, dirty_orders_sql  # noqa: F401
from strata.sources.landing import (  # noqa: F401
    as_text, land_text, publish_view, read_layer, sample, stamp, stamp_bronze,
    stamp_layer, text_schema, write_layer,
)
from strata.sources.tables import DRIVER_TABLES, read_table, table_path  # noqa: F401
