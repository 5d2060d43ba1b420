"""Readers with fixed schemas, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOC = "formula string, name string, page_number int"
CANDIDATES = "reduced_formula string, material_id string, spacegroup string, energy double, is_stable boolean, nsites int, theoretical boolean, composition map<string,double>, icsd_n int"
MATERIAL = "formula string, name string, page_number int, phases map<string,struct<t:array<double>,cp:array<double>,s:array<double>,gef:array<double>,h:array<double>,h_h298:array<double>,g:array<double>,dhf:array<double>,dgf:array<double>,logkf:array<double>>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headed CSV table with quoted commas and a fixed schema."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", True).csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One text file per page to (page_no, line_no, text); what follows the last newline of a file is left out."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value"))
    page = F.regexp_extract("file", r"(\d+)\D*$", 1).try_cast("int")
    lines = F.slice(F.split("value", "\n", -1), F.lit(1), F.size(F.split("value", "\n", -1)) - 1)
    return files.select(page.alias("page_no"), F.posexplode(lines).alias("line_no", "text"))


def read_images(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """Page images as (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def read_materials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MATERIAL).option("multiLine", True).json(path)


def write_materials(df: DataFrame, path: str) -> None:
    """JSON documents, many to a file: a file per formula doesn't scale."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def cif_text(source: Column, body: Column) -> Column:
    """A structure file's text under its provenance line."""
    return F.concat(F.lit("# Source: "), source, F.lit("\n"), body)


def read_cifs(spark: SparkSession, path: str) -> DataFrame:
    """Structure files to (file, source, spacegroup, formula, body)."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    field = lambda name: F.nullif(F.trim(F.regexp_extract("body", rf"(?m)^{name}\s+'?([^'\n]*)'?\s*$", 1)), F.lit(""))
    source = F.nullif(F.regexp_extract("body", r"(?m)^# Source:\s*(.*)$", 1), F.lit(""))
    return files.select("file", source.alias("source"), field("_symmetry_space_group_name_H-M").alias("spacegroup"), field("_chemical_formula_structural").alias("formula"), "body")
