"""Matching the training sheet to users by leader code and phone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import clean_phone, full_name
from rapport.operators import split_join

# The first reason that applies is reported.
BAD_PHONE = "Invalid phone number."
BAD_CODE = "Can't find given RMM Reach Code in RMM Reach Code Sheet."
NO_USER = "Phone number does not match any Reach users."
SHARED_PHONE = "More than one onboarded CM has this phone number."


def _trained(sheet: DataFrame, *extra: str | Column) -> DataFrame:
    return sheet.where("invite_code IS NOT NULL").select(
        F.trim("invite_code").alias("invite_code"),
        clean_phone(F.col("phone_number")).alias("phone_number"),
        *extra,
    )


def match_members(sheet: DataFrame, leaders: DataFrame, users: DataFrame) -> DataFrame:
    """Users whose phone and leader code occur in the training sheet.

    Both sides are distinct before they meet, so their join is.
    """
    trained = _trained(sheet).where("phone_number IS NOT NULL").distinct()
    led = split_join(trained, leaders, "invite_code").select("phone_number", "rmm", "pod", "rmm_email")
    known = users.select(
        "user_id",
        "first_name",
        "last_name",
        full_name(F.col("first_name"), F.col("last_name")).alias("user_name"),
        "email_address",
        "phone_number",
        "date_joined",
    )
    return split_join(known.distinct(), led.distinct(), "phone_number")


def match_errors(sheet: DataFrame, leaders: DataFrame, users: DataFrame, order_col: str) -> DataFrame:
    """Training rows that cannot be matched, with the first reason that applies.

    A phone held by several users gives one row per user. ``order_col`` is the
    sheet's own row order, by which the report is written in reverse.
    """
    trained = _trained(
        sheet, "cm_name", "email_address", F.col("phone_number").alias("phone_original"), order_col
    )
    codes = leaders.select("invite_code", F.lit(True).alias("has_code"))
    known = users.select("phone_number", F.lit(True).alias("has_user"))
    shared = (
        trained.groupBy("phone_number").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .select("phone_number", F.lit(True).alias("shared"))
    )
    phones = known.join(shared, "phone_number", "full")
    reason = (
        F.when(F.col("phone_number").isNull(), BAD_PHONE)
        .when(F.col("has_code").isNull(), BAD_CODE)
        .when(F.col("has_user").isNull(), NO_USER)
        .when(F.col("shared").isNotNull(), SHARED_PHONE)
    )
    return (
        split_join(split_join(trained, codes, "invite_code", "left"), phones, "phone_number", "left")
        .where("has_code IS NULL OR has_user IS NULL OR shared IS NOT NULL")
        .select(
            order_col,
            "invite_code",
            "cm_name",
            "email_address",
            "phone_original",
            F.col("phone_number").alias("phone_clean"),
            reason.alias("matching_error"),
        )
    )
