from strata.sources.tables import Catalog, read_table, SCHEMAS
from strata.sources.standins import fx_rates, partsupp, lineitem_with_dates, capacity_seed, override_seed

__all__ = ["Catalog", "read_table", "SCHEMAS", "fx_rates", "partsupp",
           "lineitem_with_dates", "capacity_seed", "override_seed"]
