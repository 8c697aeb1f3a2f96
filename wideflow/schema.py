"""Column lists, families and the cell-table schema.

Fixed values: these names, their order and the family names must equal the
source system's for stored cells to line up.
"""

from pyspark.sql import types as T

# Invoice header columns, in source order (21).
HEADER_COLS = [
    "xfmc", "xfsbh", "xfdzdh", "xfyhzh", "gfmc", "gfsbh", "gfdzdh", "gfyhzh",
    "fpdm", "fphm", "fp_lb", "je", "se", "jshj", "kpr", "kprq", "kpyf", "kpjh",
    "qdbz", "zfbz", "zfsj",
]
# Columns added by enrichment, in stored order.
ENRICH_COLS = ["source", "gfqybm", "xfqybm"]
HEADER_STORED_COLS = HEADER_COLS + ENRICH_COLS

# Invoice line columns, in source order (16).
DETAIL_COLS = [
    "xf_nsrsbh", "gf_nsrsbh", "fpdm", "fphm", "fpmxxh", "flbm", "kprq", "kpyf",
    "spmc", "jldw", "je", "se", "slv", "zfbz", "sjly", "ext",
]

# Column families and the lookup cell name.
HEADER_FAMILY = "fpxx"
DETAIL_FAMILY = "fpmx"
LOOKUP_FAMILY = "qyxx"
LOOKUP_QUALIFIER = "qybm"
SOURCE_TAG = "hive"

CELL_SCHEMA = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.StringType()),
])
CELL_COLS = [f.name for f in CELL_SCHEMA.fields]
CELL_ID = ["row_key", "family", "qualifier"]

LOOKUP_COLS = ["row_key", "qybm"]
