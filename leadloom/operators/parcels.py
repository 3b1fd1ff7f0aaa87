"""Typed sections of parcel pages: a table of fields (section, label, kind, column) compiled to one struct of columns.

The page reader gives each section's labelled values as a map of text; typing them is plain column work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.binding import filled, once
from leadloom.operators.html import parcel_pages

# The labels of each section, the kind of their value and the column that it becomes.
SECTIONS: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "county": ("county_information", [("County Number", "number", "county_number"), ("Reappraisal Year", "number", "reappraisal_year")]),
    "values": (
        "value_information",
        [
            ("Land Market Value", "number", "land_market_value"), ("Improvement Value", "number", "improvement_value"), ("Total Market Appraisal", "number", "total_market_appraisal"),
            ("Assessment Percentage", "number", "assessment_percentage"), ("Assessment", "number", "assessment"),
        ],
    ),
    "plat": ("subdivision_data", [("Plat Book", "text", "plat_book"), ("Plat Page", "text", "plat_page"), ("Block", "text", "block"), ("Lot", "text", "lot"), ("Subdivision", "text", "subdivision")]),
    "general": ("general_information", [("District", "text", "district"), ("Neighborhood", "text", "neighborhood"), ("Number of buildings", "number", "number_of_buildings"), ("Zoning", "text", "zoning")]),
    "utilities": (
        "general_information",
        [("Utilities - Water/Sewer", "coded", "water_sewer"), ("Utilities - Gas/Gas Type", "coded", "gas"), ("Utilities - Electricity", "coded", "electricity")],
    ),
    "land": ("land_summary", [("Deed Acres", "number", "deed_acres"), ("Calculated Acres", "number", "calculated_acres"), ("Total Land Units", "number", "total_land_units")]),
}


def number(text: Column) -> Column:
    """The first whole number in a text, thousands parted by commas or not; null without one."""
    return F.replace(filled(F.regexp_extract(text, r"([0-9]+(?:,[0-9]{3})*)", 1)), F.lit(","), F.lit("")).try_cast("bigint")


def coded(text: Column) -> Column:
    """Struct of raw, code and desc: "01 - PUBLIC / PUBLIC" parts at the first dash, other text is all description, blank is nothing."""
    parts = lambda raw, at: F.struct(
        raw.alias("raw"), F.when(at > 0, F.trim(F.substring(raw, F.lit(1), at - 1))).alias("code"), F.when(at > 0, F.trim(F.substring(raw, at + 3, F.length(raw)))).otherwise(raw).alias("desc")
    )
    nothing = F.struct(*[F.lit(None).cast("string").alias(c) for c in ("raw", "code", "desc")])
    return once(filled(F.trim(text)), lambda raw: F.when(raw.isNotNull(), once(F.instr(raw, " - "), lambda at: parts(raw, at))).otherwise(nothing))


KINDS = {"number": number, "text": lambda c: c, "coded": coded}


def sections(details: Column) -> Column:
    """Struct of the sections' structs."""
    typed = lambda source, fields: F.struct(*[KINDS[kind](F.try_element_at(details[source], F.lit(label))).alias(name) for label, kind, name in fields])
    return F.struct(*[typed(*s).alias(name) for name, s in SECTIONS.items()])


def outbuildings(rows: Column) -> Column:
    """Outbuildings as structs: units as a number, or as the text where that has none (or only a zero)."""
    return F.transform(rows, lambda r: F.struct(r[0].alias("building_card"), r[1].alias("type"), r[2].alias("description"), F.nullif(number(r[3]), F.lit(0).cast("bigint")).alias("units"), r[3].alias("units_text")))


def parcel_sections(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without their text, with title, county_tax_year and tax_year, a struct for each of SECTIONS, and outbuildings."""
    read = parcel_pages(pages, html)
    year = F.regexp_extract(F.col("_parcel.page.county_tax_year"), r"Tax Year\s+(\d{4})", 1)
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    page = [F.col("_parcel.page.title").alias("title"), F.col("_parcel.page.county_tax_year").alias("county_tax_year"), filled(year).cast("int").alias("tax_year")]
    out = read.select(*kept, *page, sections(F.col("_parcel.details")).alias("_sections"), outbuildings(F.col("_parcel.details.outbuildings")).alias("outbuildings"))
    return out.select("*", "_sections.*").drop("_sections")
