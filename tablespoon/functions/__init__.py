"""Column functions: each takes and returns a Column and stays inside codegen."""

from tablespoon.functions.casts import to_float, to_int, to_local_ts, to_string, utc_ts
from tablespoon.functions.dates import business_date, hour_bucket
from tablespoon.functions.pii import hash_pii, mask_pii, register_hash_pii
from tablespoon.functions.revenue import net_revenue, revenue_inclusive

__all__ = [
    "business_date",
    "hash_pii",
    "hour_bucket",
    "mask_pii",
    "net_revenue",
    "register_hash_pii",
    "revenue_inclusive",
    "to_float",
    "to_int",
    "to_local_ts",
    "to_string",
    "utc_ts",
]
