"""Published yearly reference tables and their CSV form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: NHG cost limit in EUR per year of origination -------------
NHG_CAPS: dict[int, float] = {
    2010: 265000.0, 2011: 350000.0, 2012: 320000.0, 2013: 290000.0,
    2014: 265000.0, 2015: 245000.0, 2016: 231132.0, 2017: 247450.0,
    2018: 265000.0, 2019: 290000.0, 2020: 310000.0, 2021: 325000.0,
    2022: 355000.0, 2023: 405000.0, 2024: 435000.0, 2025: 450000.0,
}
# ---- fixed values: the same limit for energy-neutral homes, where it differs --
NHG_CAPS_ENERGY_NEUTRAL: dict[int, float] = {
    2018: 280900.0, 2019: 307400.0, 2020: 328600.0, 2021: 344500.0,
    2022: 376300.0, 2023: 429300.0, 2024: 461100.0, 2025: 477000.0,
}
# ---- fixed values: NHG premium as a share of the loan -------------------------
NHG_PREMIUMS: dict[int, float] = {
    2010: 0.0055, 2011: 0.0055, 2012: 0.0070, 2013: 0.0085,
    2014: 0.0100, 2015: 0.0100, 2016: 0.0100, 2017: 0.0100,
    2018: 0.0100, 2019: 0.0090, 2020: 0.0070, 2021: 0.0070,
    2022: 0.0060, 2023: 0.0060, 2024: 0.0060, 2025: 0.0040,
}
# ---- fixed values: maximum mortgage-interest deduction in percent per tax year
HRA_RATES_PCT: dict[int, float] = {
    2013: 52.0, 2014: 51.5, 2015: 51.0, 2016: 50.5, 2017: 50.0, 2018: 49.5, 2019: 49.0,
    2020: 46.0, 2021: 43.0, 2022: 40.0, 2023: 36.93, 2024: 36.97, 2025: 36.97, 2026: 37.48,
}
# ---- fixed values: Nibud loan-to-income factor in percent by income band ------
NIBUD_LTI_PCT: dict[int, dict[float, float]] = {
    2024: {30000.0: 400.0, 40000.0: 425.0, 60000.0: 500.0, 80000.0: 500.0, 100000.0: 475.0,
           150000.0: 450.0},
    2025: {30000.0: 400.0, 40000.0: 425.0, 60000.0: 500.0, 80000.0: 525.0, 100000.0: 500.0,
           150000.0: 475.0},
}
# ---- fixed values: interest rate assumed by the Nibud table, in percent -------
NIBUD_RATE_PCT: dict[int, float] = {2024: 4.0, 2025: 3.5}

HRA_RATES: dict[int, float] = {year: pct / 100.0 for year, pct in HRA_RATES_PCT.items()}

_NOTES = T.StructField("notes", T.StringType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields] + [_NOTES])


_INT, _DOUBLE = T.IntegerType(), T.DoubleType()
SCHEMAS: dict[str, T.StructType] = {
    "nhg_caps": _schema(
        ("year", _INT), ("nhg_cap_eur", _DOUBLE), ("nhg_cap_energy_neutral_eur", _DOUBLE),
        ("nhg_premium_pct", _DOUBLE),
    ),
    "hra_rates": _schema(("year", _INT), ("max_hra_rate_pct", _DOUBLE)),
    "nibud_lti": _schema(
        ("year", _INT), ("income_eur", _DOUBLE), ("lti_factor_pct", _DOUBLE),
        ("interest_rate_assumed_pct", _DOUBLE),
    ),
}


def read_reference_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A reference table in its published CSV form."""
    return spark.read.schema(SCHEMAS[table]).option("header", True).csv(path)


def reference_table(spark: SparkSession, table: str) -> DataFrame:
    """A built-in reference table as a small DataFrame."""
    if table == "nhg_caps":
        rows = [
            (year, cap, NHG_CAPS_ENERGY_NEUTRAL.get(year, cap), NHG_PREMIUMS[year], None)
            for year, cap in NHG_CAPS.items()
        ]
    elif table == "hra_rates":
        rows = [(year, pct, None) for year, pct in HRA_RATES_PCT.items()]
    elif table == "nibud_lti":
        rows = [
            (year, income, factor, NIBUD_RATE_PCT[year], None)
            for year, bands in NIBUD_LTI_PCT.items()
            for income, factor in bands.items()
        ]
    else:
        raise KeyError(f"unknown reference table {table!r}")
    return spark.createDataFrame(rows, SCHEMAS[table])


def with_year_value(frame: DataFrame, year: Column, table: DataFrame, value: str, name: str, scale: float = 1.0) -> DataFrame:
    """``frame`` with the ``value`` that ``table`` holds for its ``year``, null where it holds none.

    Of several rows of a year the largest value counts. Spark chooses the join by the table's size.
    """
    values = table.where(F.col("year").isNotNull()).groupBy(F.col("year").alias("__year")).agg((F.max(value) * scale).alias(name))
    return frame.withColumn("__of", year).join(values, F.col("__of") == F.col("__year"), "left").drop("__of", "__year")
