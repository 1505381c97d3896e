"""The staging (connection record) schema: 49 positional fields, all nullable.

Names are lower case; types follow the decisions in SURVEY 1.2 (bytes and TCP sequence
numbers as bigint, 0/1 flags as int).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 49 staging fields in file order with their Spark types.
STAGING_FIELDS: list[tuple[str, T.DataType]] = [
    ("srcip", T.StringType()),
    ("sport", T.IntegerType()),
    ("dstip", T.StringType()),
    ("dsport", T.IntegerType()),
    ("proto", T.StringType()),
    ("state", T.StringType()),
    ("dur", T.DoubleType()),
    ("sbytes", T.LongType()),
    ("dbytes", T.LongType()),
    ("sttl", T.IntegerType()),
    ("dttl", T.IntegerType()),
    ("sloss", T.IntegerType()),
    ("dloss", T.IntegerType()),
    ("service", T.StringType()),
    ("sload", T.DoubleType()),
    ("dload", T.DoubleType()),
    ("spkts", T.IntegerType()),
    ("dpkts", T.IntegerType()),
    ("swin", T.IntegerType()),
    ("dwin", T.IntegerType()),
    ("stcpb", T.LongType()),
    ("dtcpb", T.LongType()),
    ("smeansz", T.IntegerType()),
    ("dmeansz", T.IntegerType()),
    ("trans_depth", T.IntegerType()),
    ("res_bdy_len", T.IntegerType()),
    ("sjit", T.DoubleType()),
    ("djit", T.DoubleType()),
    ("stime", T.LongType()),
    ("ltime", T.LongType()),
    ("sintpkt", T.DoubleType()),
    ("dintpkt", T.DoubleType()),
    ("tcprtt", T.DoubleType()),
    ("synack", T.DoubleType()),
    ("ackdat", T.DoubleType()),
    ("is_sm_ips_ports", T.IntegerType()),
    ("ct_state_ttl", T.IntegerType()),
    ("ct_flw_http_mthd", T.IntegerType()),
    ("is_ftp_login", T.IntegerType()),
    ("ct_ftp_cmd", T.IntegerType()),
    ("ct_srv_src", T.IntegerType()),
    ("ct_srv_dst", T.IntegerType()),
    ("ct_dst_ltm", T.IntegerType()),
    ("ct_src_ltm", T.IntegerType()),
    ("ct_src_dport_ltm", T.IntegerType()),
    ("ct_dst_sport_ltm", T.IntegerType()),
    ("ct_dst_src_ltm", T.IntegerType()),
    ("attack_cat", T.StringType()),
    ("label", T.IntegerType()),
]

STAGING_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in STAGING_FIELDS])
STAGING_COLUMNS = [n for n, _ in STAGING_FIELDS]

# The feature dictionary layout and the names the load requires.
FEATURES_SCHEMA = T.StructType(
    [
        T.StructField("feature_id", T.IntegerType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("data_type", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)
REQUIRED_FEATURES = ["srcip", "sport", "dstip", "dsport", "proto", "state", "service", "attack_cat", "label"]


def conform(df: DataFrame) -> DataFrame:
    """Project ``df`` onto the full staging schema (missing fields become typed NULLs)."""
    present = set(df.columns)
    cols: list[Column] = []
    for name, dtype in STAGING_FIELDS:
        if name in present:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)
