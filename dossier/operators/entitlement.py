"""Entitlements: user-to-client map, row filters, column masks, secure views (E-01..E-04, N-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = "****-**-**"


def entitlement_map(user_attrs: DataFrame, client_attrs: DataFrame, user: str = "upn",
                    client: str = "client_id", value: str = "attribute_value") -> DataFrame:
    """E-01: (user, client) pairs where a user attribute value equals a client attribute value."""
    u = user_attrs.select(F.col(user).alias("upn"), F.col(value).alias("__v"))
    c = client_attrs.select(F.col(client).alias("client_id"), F.col(value).alias("__v"))
    return u.join(c, "__v").select("upn", "client_id").distinct()


def row_filter(df: DataFrame, key: str, ent_map: DataFrame, user: str) -> DataFrame:
    """E-02: rows of ``df`` the given user may see (semi join on the user's client ids);
    frames without the key column are returned unchanged."""
    if key not in df.columns:
        return df
    mine = ent_map.where(F.col("upn") == F.lit(user)).select(F.col("client_id").alias("__cid"))
    return df.join(mine, F.col(key) == F.col("__cid"), "left_semi")


def entitlement_bitmaps(user_attrs: DataFrame, client_attrs: DataFrame, user: str = "upn",
                        client: str = "client_id", value: str = "attribute_value") -> DataFrame:
    """E-01 without pairs: (upn, bucket, clients), a user's clients as bitmaps of 32,768 ids each.

    Clients become bitmaps per attribute value first (a partial aggregate, so a value may hold any
    share of them); users are joined to bitmaps and theirs are merged.  Ids are integers; a null id
    or value gives no entitlement; repeated rows change nothing.
    """
    c = client_attrs.select(F.col(client).cast("bigint").alias("__id"), F.col(value).alias("__v")).where("__id IS NOT NULL")
    sets = (c.groupBy("__v", F.bitmap_bucket_number("__id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("clients")))
    u = user_attrs.select(F.col(user).alias("upn"), F.col(value).alias("__v")).distinct()
    return u.join(sets, "__v").groupBy("upn", "bucket").agg(F.bitmap_or_agg("clients").alias("clients"))


def entitled_counts(bitmaps: DataFrame) -> DataFrame:
    """Number of clients per user, from ``entitlement_bitmaps``."""
    return bitmaps.groupBy("upn").agg(F.sum(F.bitmap_count("clients")).alias("n_clients"))


def _has_bit(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1


def bitmap_row_filter(df: DataFrame, key: str, bitmaps: DataFrame, user: str) -> DataFrame:
    """E-02 by bitmaps: rows of ``df`` the given user may see; a null key is never seen."""
    mine = bitmaps.where(F.col("upn") == user).select(F.col("bucket").alias("__bucket"), F.col("clients").alias("__clients"))
    k = F.col(key).cast("bigint")
    return (df.join(mine, F.bitmap_bucket_number(k) == F.col("__bucket"))
            .where(_has_bit(F.col("__clients"), F.bitmap_bit_position(k))).select(*[df[c] for c in df.columns]))


def apply_column_mask(df: DataFrame, col: str, region_col: str, user_attrs: DataFrame, user: str,
                      global_attr: str = "Global", out: str | None = None) -> DataFrame:
    """E-03: mask ``col`` unless the user holds the row's region or the global attribute."""
    ua = user_attrs.where(F.col("upn") == F.lit(user))
    has_global = ua.where(F.col("attribute_type") == global_attr).agg(F.count(F.lit(1)) > 0).scalar()
    regions = ua.where(F.col("attribute_type") == "Region").select(
        F.col("attribute_value").alias("__r")).distinct().withColumn("__ok", F.lit(True))
    j = df.join(regions, F.col(region_col) == F.col("__r"), "left")
    shown = has_global | F.coalesce(F.col("__ok"), F.lit(False))
    masked = F.when(shown, F.col(col).cast("string")).otherwise(F.lit(MASK))
    return j.withColumn(out or col, masked).drop("__r", "__ok")


def secure_view(spark: SparkSession, df: DataFrame, name: str, col: str, region_col: str,
                user_attrs: DataFrame, user: str, keep: list[str]) -> DataFrame:
    """E-04: a view exposing only the masked column (plus ``keep``), registered as a temp view."""
    v = apply_column_mask(df, col, region_col, user_attrs, user).select(*keep, col)
    v.createOrReplaceTempView(name)
    return spark.table(name)


def register_can_view(spark: SparkSession, ent_view: str, fn: str = "can_view") -> str:
    """N-02: SQL scalar function with an EXISTS subquery over the entitlement view;
    the user is a parameter, never ``current_user()``."""
    # parameter names must not shadow built-ins such as ``user``
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {fn}(p_client BIGINT, p_upn STRING)
                  RETURNS BOOLEAN
                  RETURN EXISTS (SELECT 1 FROM {ent_view} e WHERE e.client_id = p_client AND e.upn = p_upn)""")
    return fn
