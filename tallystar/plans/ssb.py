"""The thirteen Star-Schema Benchmark queries with their constants as parameters.

``star`` maps the five table names to DataFrames. Dimensions are filtered first and joined
in the order of their selectivity; the fact table is the probe side of every join and is
never shuffled for a dimension that is small by its files. Totals are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.money import exact_sum
from tallystar.plans.star import MONTH, StarViews

Star = Mapping[str, DataFrame]

# Fact column and dimension key of each join, most selective dimension first.
JOINS = {"supplier": ("lo_suppkey", "s_suppkey"), "part": ("lo_partkey", "p_partkey"),
         "customer": ("lo_custkey", "c_custkey"), "date": ("lo_orderdate", "d_datekey")}


def _joined(star: Star, dimensions: Mapping[str, Column | None], group: Sequence[str],
            where: Column | None = None) -> DataFrame:
    """The fact rows that match every dimension, with the columns of ``group``.

    Where the fact table is a view, its two sides are cut by their own dimensions before they
    meet. Spark broadcasts a dimension by its size and shuffles one that is too large.
    """
    def cut(fact: DataFrame, names: Sequence[str]) -> DataFrame:
        for name in names:
            if name in dimensions:
                foreign, key = JOINS[name]
                condition = dimensions[name]
                side = star[name] if condition is None else star[name].where(condition)
                match, keys = F.col(foreign) == F.col(key), [key]
                if name == "date" and MONTH in fact.columns:   # prunes the months of a stored fact
                    match, keys = match & (F.col(MONTH) == F.col("_month")), [
                        key, F.col("d_yearmonthnum").alias("_month")]
                side = side.select(*keys, *(c for c in group if c in side.columns))
                fact = fact.join(side, match)
        return fact

    def chosen(fact: DataFrame) -> DataFrame:
        return fact if where is None else fact.where(where)

    if isinstance(star, StarViews):
        return cut(chosen(star.sides["lines"]), ("supplier", "part")).join(
            cut(star.sides["orders"], ("date", "customer")), "lo_orderkey")
    return cut(chosen(star["lineorder"]), tuple(JOINS))


def _years(first: int, last: int) -> Column:
    return F.col("d_year").between(first, last)


# --- flight 1: one dimension, no groups ------------------------------------------------

def _flight1(star: Star, dates: Column, discount: tuple[int, int], quantity: Column) -> DataFrame:
    lines = _joined(star, {"date": dates}, [], F.col("lo_discount").between(*discount) & quantity)
    return (lines.withColumn("gain", F.col("lo_extendedprice") * F.col("lo_discount"))
                 .agg(exact_sum("gain", 0).alias("revenue")))


def q1_1(star: Star, year: int = 1994, discount: tuple[int, int] = (1, 3),
         below_quantity: int = 25) -> DataFrame:
    return _flight1(star, F.col("d_year") == year, discount,
                    F.col("lo_quantity") < below_quantity)


def q1_2(star: Star, yearmonthnum: int = 199401, discount: tuple[int, int] = (4, 6),
         quantity: tuple[int, int] = (26, 35)) -> DataFrame:
    return _flight1(star, F.col("d_yearmonthnum") == yearmonthnum, discount,
                    F.col("lo_quantity").between(*quantity))


def q1_3(star: Star, week: int = 6, year: int = 1994, discount: tuple[int, int] = (5, 7),
         quantity: tuple[int, int] = (26, 35)) -> DataFrame:
    return _flight1(star, (F.col("d_weeknuminyear") == week) & (F.col("d_year") == year),
                    discount, F.col("lo_quantity").between(*quantity))


# --- flight 2: revenue by year and brand -----------------------------------------------

def _flight2(star: Star, parts: Column, region: str) -> DataFrame:
    group = ["d_year", "p_brand1"]
    lines = _joined(star, {"supplier": F.col("s_region") == region, "part": parts, "date": None}, group)
    return (lines.groupBy(*group).agg(exact_sum("lo_revenue", 0).alias("revenue"))
                 .orderBy(*group))


def q2_1(star: Star, category: str = "MFGR#12", region: str = "AMERICA") -> DataFrame:
    return _flight2(star, F.col("p_category") == category, region)


def q2_2(star: Star, brands: tuple[str, str] = ("MFGR#2221", "MFGR#2228"),
         region: str = "ASIA") -> DataFrame:
    return _flight2(star, F.col("p_brand1").between(*brands), region)


def q2_3(star: Star, brand: str = "MFGR#2239", region: str = "EUROPE") -> DataFrame:
    return _flight2(star, F.col("p_brand1") == brand, region)


# --- flight 3: revenue by customer place, supplier place and year ----------------------

def _flight3(star: Star, place: str, suppliers: Column, customers: Column,
             dates: Column) -> DataFrame:
    group = [f"c_{place}", f"s_{place}", "d_year"]
    lines = _joined(star, {"supplier": suppliers, "customer": customers, "date": dates}, group)
    return (lines.groupBy(*group).agg(exact_sum("lo_revenue", 0).alias("revenue"))
                 .orderBy("d_year", F.desc("revenue")))


def q3_1(star: Star, region: str = "ASIA", first: int = 1992, last: int = 1997) -> DataFrame:
    return _flight3(star, "nation", F.col("s_region") == region, F.col("c_region") == region,
                    _years(first, last))


def q3_2(star: Star, nation: str = "UNITED STATES", first: int = 1992,
         last: int = 1997) -> DataFrame:
    return _flight3(star, "city", F.col("s_nation") == nation, F.col("c_nation") == nation,
                    _years(first, last))


def q3_3(star: Star, cities: Sequence[str] = ("UNITED KI1", "UNITED KI5"), first: int = 1992,
         last: int = 1997) -> DataFrame:
    return _flight3(star, "city", F.col("s_city").isin(*cities), F.col("c_city").isin(*cities),
                    _years(first, last))


def q3_4(star: Star, cities: Sequence[str] = ("UNITED KI1", "UNITED KI5"),
         yearmonth: str = "Dec1997") -> DataFrame:
    return _flight3(star, "city", F.col("s_city").isin(*cities), F.col("c_city").isin(*cities),
                    F.col("d_yearmonth") == yearmonth)


# --- flight 4: profit ------------------------------------------------------------------

def _flight4(star: Star, group: list[str], suppliers: Column, customers: Column,
             parts: Column, dates: Column | None) -> DataFrame:
    lines = _joined(star, {"supplier": suppliers, "part": parts, "customer": customers, "date": dates},
                    group)
    return (lines.withColumn("gain", F.col("lo_revenue") - F.col("lo_supplycost"))
                 .groupBy(*group).agg(exact_sum("gain", 0).alias("profit"))
                 .orderBy(*group))


def q4_1(star: Star, region: str = "AMERICA",
         mfgrs: Sequence[str] = ("MFGR#1", "MFGR#2")) -> DataFrame:
    return _flight4(star, ["d_year", "c_nation"], F.col("s_region") == region,
                    F.col("c_region") == region, F.col("p_mfgr").isin(*mfgrs), None)


def q4_2(star: Star, region: str = "AMERICA", mfgrs: Sequence[str] = ("MFGR#1", "MFGR#2"),
         years: Sequence[int] = (1997, 1998)) -> DataFrame:
    return _flight4(star, ["d_year", "s_nation", "p_category"], F.col("s_region") == region,
                    F.col("c_region") == region, F.col("p_mfgr").isin(*mfgrs),
                    F.col("d_year").isin(*years))


def q4_3(star: Star, region: str = "AMERICA", nation: str = "UNITED STATES",
         category: str = "MFGR#14", years: Sequence[int] = (1997, 1998)) -> DataFrame:
    return _flight4(star, ["d_year", "s_city", "p_brand1"], F.col("s_nation") == nation,
                    F.col("c_region") == region, F.col("p_category") == category,
                    F.col("d_year").isin(*years))
