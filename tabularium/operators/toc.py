"""Tables of contents: entries normalised to formulas, labelled by what becomes of them, and matched a second time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import chem
from tabularium.functions import text as X
from tabularium.operators import match
from tabularium.operators.outcomes import reindex
from tabularium.sources import io
from tabularium.sources.store import per_value, stored

# Tags of phases without a crystal structure, the gas tag, and its word in names.
AMORPHOUS, GAS, GAS_NAME = ("GL",), "g", "(GAS)"
COLUMNS = "row_id long, formula string, name string, page long"
HINTS = "formula string, tag string, spacegroup string"
# Space groups of polymorphs that a formula's tag names.
TAG_HINTS = {
    ("Al2O3", "C"): "Fd-3m", ("As2O3", "A"): "Fd-3m", ("C", "D"): "Fd-3m", ("CaCO3", "A"): "Pnma", ("SiO2", "CR"): "P4_12_12", ("TiO2", "A"): "I4_1/amd", ("ZnS", "S"): "F-43m", ("PbO", "R"): "P4/nmm",
    ("Al2SiO5", "A"): "Pnnm", ("Al2SiO5", "S"): "Pnma", ("Ca2SiO4", "B"): "P2_1/c", ("Sb2O3", "O"): "Pccn", ("Eu2O3", "M"): "C2/m", ("Gd2O3", "M"): "C2/m", ("Sm2O3", "M"): "C2/m", ("Al2O3*H2O", "B"): "Pmn2_1",
}
# Space groups of polymorphs that only an untagged formula's name tells.
NAME_HINTS = {"Sn": "I4_1/amd", "Si3N4": "P31c", "Sb2O3": "Fd-3m", "Pu2O3": "P-3m1", "SiC": "F-43m", "TiO2": "P4_2/mnm", "PbO": "Pbcm", "LiAlSi2O6": "C2/c", "Fe0.778S": "C2/c"}
# The columns of a run's tables.
MATCHED = {
    "Formula": "string", "Name": "string", "Page number": "long", "bare_formula": "string", "phase_tag": "string", "reduced_formula": "string", "material_id": "string", "match_method": "string",
    "phase_name_verified": "boolean", "spacegroup": "string", "cif_file": "string",
}
UNMATCHED = {c: t for c, t in MATCHED.items() if c != "cif_file"}
SECOND = UNMATCHED | {"cod_id": "string", "cod_sg": "string", "cif_file": "string"}


def hints(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(formula, tag, spacegroup): of a headed CSV file, where an empty tag is none, or the fixed ones."""
    if path:
        return io.read_csv(spark, path, HINTS).withColumn("tag", F.nullif("tag", F.lit("")))
    fixed = [(f, t, g) for (f, t), g in TAG_HINTS.items()] + [(f, None, g) for f, g in NAME_HINTS.items()]
    return spark.createDataFrame(fixed, HINTS)


def normalise(toc: DataFrame) -> DataFrame:
    """Entries (row_id, formula, name, page) with bare_formula, phase_tag, comp, reduced_formula, parse_ok,
    suspected_ocr_corruption, is_gas and is_nonstoichiometric.

    Gases stay only if they are organic, with their formula bare of all tags. Null formulas and names are empty. Each
    distinct (formula, name) is repaired and parsed once.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    rows = toc.select("row_id", text("formula").alias("formula"), text("name").alias("name"), "page")
    return per_value(rows, ["formula", "name"], _read)


def _read(each: DataFrame) -> DataFrame:
    gas = F.coalesce(X.strip_tag(F.col("formula"))[1] == GAS, F.lit(False)) | F.upper("name").contains(GAS_NAME)
    bare, tag = X.strip_tag(X.fix_water(X.fix_letters(F.col("formula"))))
    each = each.select("formula", "name", gas.alias("is_gas"), F.when(gas, X.strip_tag(F.col("formula"))[1]).otherwise(tag).alias("phase_tag"), bare.alias("_bare"), X.strip_all_tags(X.fix_letters(F.col("formula"))).alias("_untagged"))
    each = each.withColumn("bare_formula", F.when(F.col("is_gas"), F.col("_untagged")).otherwise(chem.repair_column(F.col("_bare"), F.col("name"))))
    each = each.withColumn("comp", chem.parse_column(F.col("bare_formula")))
    organic = F.coalesce(chem.is_organic(F.col("comp")), F.lit(False))
    each = each.where(~F.col("is_gas") | organic)
    read, solid = F.col("comp").isNotNull(), ~F.col("is_gas")
    strange = solid & read & (F.size(F.map_keys("comp")) <= 1) & (F.length("bare_formula") > 4)
    each = each.withColumns({
        "organic": organic, "suspected_ocr_corruption": F.coalesce(strange, F.lit(False)), "reduced_formula": F.when(solid, chem.reduced_column(F.col("bare_formula"))),
        "parse_ok": solid & read & ~F.coalesce(strange, F.lit(False)), "is_nonstoichiometric": F.coalesce(solid & chem.is_nonstoichiometric(F.col("comp")), F.lit(False)),
    })
    return each.drop("_bare", "_untagged")


def outcomes(rows: DataFrame, candidates: DataFrame, hints: DataFrame, remarks: DataFrame) -> DataFrame:
    """Normalised entries with material_id, spacegroup, match_method and phase_name_verified.

    Entries that can be read, but for amorphous ones, which have no outcome, are matched; the others are labelled
    suspected_ocr_corruption, unparseable_formula or gas_phase_organic.
    """
    glass = F.coalesce(F.col("phase_tag").isin(*AMORPHOUS), F.lit(False))
    wanted = rows.where(F.col("parse_ok") & ~glass)
    asked = wanted.select("row_id", "reduced_formula", F.col("bare_formula").alias("formula"), "name", F.col("phase_tag").alias("tag"), "comp", "organic", F.col("is_nonstoichiometric").alias("nonstoichiometric"))
    found = wanted.join(match.select_candidates(asked, candidates, hints, remarks), "row_id", "left")
    why = F.when(F.col("is_gas"), "gas_phase_organic").when(F.col("suspected_ocr_corruption"), "suspected_ocr_corruption").otherwise("unparseable_formula")
    return found.unionByName(rows.where(~F.col("parse_ok")).withColumn("match_method", why), allowMissingColumns=True)


def second_pass(left: DataFrame, catalogue: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Unmatched entries (row_id, reduced_formula, organic and more) with outcome, cod_id, cod_sg and phase_name_verified.

    Organic substances expect no structure; those with a reduced formula are matched to the catalogue (file, formula, sg) by
    that formula's elements and ratio, each formula once, never verified by name; the rest, and what finds nothing, is still_unmatched.
    """
    left = stored(left, "unmatched")  # read twice
    asked = left.where(~F.col("organic") & F.col("reduced_formula").isNotNull()).select(F.col("reduced_formula").alias("id")).distinct()
    targets = stored(asked, "formulas").select("id", chem.parse_column(F.col("id")).alias("comp"))
    found = match.secondary_candidates(stored(targets, "targets"), catalogue, tolerance)
    found = found.select(F.lit(False).alias("organic"), F.col("id").alias("reduced_formula"), F.col("file").alias("cod_id"), F.col("sg").alias("cod_sg"))
    outcome = F.when(F.col("organic"), "no_structure_expected").when(F.col("cod_id").isNotNull(), "matched").otherwise("still_unmatched")
    verified = F.when(F.col("cod_id").isNotNull(), False)
    return left.drop("phase_name_verified").join(found, ["organic", "reduced_formula"], "left").withColumns({"outcome": outcome, "phase_name_verified": verified})


def tables(found: DataFrame, structures: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) of ``outcomes``, with the columns of a run's tables. A matched row's cif_file is the name under
    which its structure is kept; null if ``structures`` (material_id) is given and has none."""
    rows = found.withColumnsRenamed({"formula": "Formula", "name": "Name", "page": "Page number"})
    kept = F.concat(X.file_stem(F.col("Formula")), F.lit(".cif"))
    matched = rows.where(F.col("material_id").isNotNull())
    if structures is not None:
        held = structures.select("material_id").distinct().withColumn("_held", F.lit(True))
        matched, kept = matched.join(held, "material_id", "left"), F.when(F.col("_held"), kept)
    return reindex(matched.withColumn("cif_file", kept), MATCHED), reindex(rows.where(F.col("material_id").isNull()), UNMATCHED)


def second_tables(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(searched, without structure, still unmatched) of ``second_pass``."""
    kept = F.when(F.col("cod_id").isNotNull(), F.concat(X.file_stem(F.col("formula")), F.lit(".cif")))
    rows = found.withColumn("cif_file", kept).withColumnsRenamed({"formula": "Formula", "name": "Name", "page": "Page number"})
    searched = rows.where(~F.col("organic") & F.col("reduced_formula").isNotNull())
    return reindex(searched, SECOND), reindex(rows.where("outcome = 'no_structure_expected'"), UNMATCHED), reindex(rows.where("outcome = 'still_unmatched'"), SECOND)
