"""Record layouts: connection records (KDD and NSL layouts), scored rows, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The KDD connection-record column names, in file order.
KDD_COLUMNS = [
    ("duration", T.DoubleType()),
    ("protocol_type", T.StringType()),
    ("service", T.StringType()),
    ("flag", T.StringType()),
    ("src_bytes", T.LongType()),
    ("dst_bytes", T.LongType()),
    ("land", T.IntegerType()),
    ("wrong_fragment", T.IntegerType()),
    ("urgent", T.IntegerType()),
    ("hot", T.IntegerType()),
    ("num_failed_logins", T.IntegerType()),
    ("logged_in", T.IntegerType()),
    ("num_compromised", T.IntegerType()),
    ("root_shell", T.IntegerType()),
    ("su_attempted", T.IntegerType()),
    ("num_root", T.IntegerType()),
    ("num_file_creations", T.IntegerType()),
    ("num_shells", T.IntegerType()),
    ("num_access_files", T.IntegerType()),
    ("num_outbound_cmds", T.IntegerType()),
    ("is_host_login", T.IntegerType()),
    ("is_guest_login", T.IntegerType()),
    ("count", T.IntegerType()),
    ("srv_count", T.IntegerType()),
    ("serror_rate", T.DoubleType()),
    ("srv_serror_rate", T.DoubleType()),
    ("rerror_rate", T.DoubleType()),
    ("srv_rerror_rate", T.DoubleType()),
    ("same_srv_rate", T.DoubleType()),
    ("diff_srv_rate", T.DoubleType()),
    ("srv_diff_host_rate", T.DoubleType()),
    ("dst_host_count", T.IntegerType()),
    ("dst_host_srv_count", T.IntegerType()),
    ("dst_host_same_srv_rate", T.DoubleType()),
    ("dst_host_diff_srv_rate", T.DoubleType()),
    ("dst_host_same_src_port_rate", T.DoubleType()),
    ("dst_host_srv_diff_host_rate", T.DoubleType()),
    ("dst_host_serror_rate", T.DoubleType()),
    ("dst_host_srv_serror_rate", T.DoubleType()),
    ("dst_host_rerror_rate", T.DoubleType()),
    ("dst_host_srv_rerror_rate", T.DoubleType()),
    ("attack_type", T.StringType()),
]

KDD_NAMES = [n for n, _ in KDD_COLUMNS]
TARGET = "is_attack"
ATTACK_TYPE = "attack_type"
TARGETS = (TARGET, ATTACK_TYPE)
CORRUPT = "_corrupt_record"


def kdd_schema(with_corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in KDD_COLUMNS]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def nsl_schema(with_corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in KDD_COLUMNS]
    fields.append(T.StructField("difficulty_level", T.IntegerType(), True))
    if with_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


EXPLANATION_TYPE = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("importance", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
]))

ALERT_COLUMNS = ["alert_id", "severity", "probability", "confidence", "timestamp",
                 "description", "recommended_action", "model_version"]

CHECK_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas has one missing marker; make NaN a NULL in every float column.
    Infinities are kept so that checks can find them."""
    fl = [f.name for f in df.schema.fields
          if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not fl:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(
        df.schema[c].dataType)) for c in fl})
