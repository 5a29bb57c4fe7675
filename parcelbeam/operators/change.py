"""Value-change check for a requested parcel list (job 1: P1, P2, P4, P7,
P12, P14, P16, F15, F17, J1)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelbeam.functions.keys import clean_pin
from parcelbeam.functions.names import dedupe_headers, dots_to_blanks
from parcelbeam.operators.bitmap_filter import keep_possibly_wanted

# The request sheet's key column and the large-change factor.
REQUEST_KEY = "Permanent Index Number"
DEFAULT_FACTOR = Decimal("1.2")


def change_columns(history: DataFrame, mail_year: int, factor: Decimal = DEFAULT_FACTOR) -> DataFrame:
    """History rows of ``mail_year`` with the prior values, the relative change
    and the strict large-increase flag.  Output names carry the years."""
    oneyr = F.col("oneyr_pri_certified_tot")
    mailed = F.col("mailed_tot")
    factor_lit = F.lit(Decimal(factor))  # exact decimal: +20 % exactly is not "large"
    names = {
        "class": "Class",
        "twoyr": f"{mail_year - 2}.BoR.Certified.AV",
        "oneyr": f"{mail_year - 1}.BoR.Certified.AV",
        "mailed": f"{mail_year}.Mailed.AV",
        "change": "Percent.Change",
        "flag": "Large.Increase",
    }
    return (history
            .filter(F.col("year") == F.lit(str(mail_year)))
            .select(
                "pin",
                F.col("class").alias(names["class"]),
                F.col("twoyr_pri_certified_tot").alias(names["twoyr"]),
                oneyr.alias(names["oneyr"]),
                mailed.alias(names["mailed"]),
                F.try_divide((mailed - oneyr).cast("double"), oneyr.cast("double")).alias(names["change"]),
                (mailed > oneyr * factor_lit).alias(names["flag"])))


def value_change(requests: DataFrame, history: DataFrame, mail_year: int,
                 factor: Decimal = DEFAULT_FACTOR, key_col: str = REQUEST_KEY) -> DataFrame:
    """Every request row (all of its columns) with the values attached; requests
    without a history row keep NULLs.  Dots in output names become blanks.

    The history is first cut to the requested parcels: by a broadcast of a short
    request list, else by a bitmap of its keys where history rows are read, so
    few others reach the shuffle of the main left join (``keep_possibly_wanted``).
    """
    req = requests.withColumn("_request_pin", clean_pin(F.col(f"`{key_col}`")))
    wanted = req.select(F.col("_request_pin").alias("pin"))
    vals = change_columns(keep_possibly_wanted(history, wanted, "pin"), mail_year, factor)
    vals = vals.withColumnRenamed("pin", "_request_pin")
    # a name on both sides, in any case, gets a suffix on each, as in a joined data frame
    clash = {c.lower() for c in requests.columns} & {c.lower() for c in vals.columns}
    req = req.withColumnsRenamed({c: f"{c}.x" for c in req.columns if c.lower() in clash})
    vals = vals.withColumnsRenamed({c: f"{c}.y" for c in vals.columns if c.lower() in clash})
    out = req.join(vals, on="_request_pin", how="left").drop("_request_pin")
    # blanks for dots may make two names one: the later one is numbered
    names = dedupe_headers([dots_to_blanks(c) for c in out.columns])
    return out.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(out.columns, names)])
