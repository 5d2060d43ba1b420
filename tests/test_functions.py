"""Text and composition functions on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from tabularium.functions import chem
from tabularium.functions import text as X


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"] if values else spark.range(1).select(column.alias("x")).first()["x"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_find(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("ab", k=rng.randint(0, 4))), "".join(rng.choices("ab", k=rng.randint(0, 8)))) for _ in range(200)]
    for most in (0, 1):
        got = [r["x"] for r in spark.createDataFrame(rows, "n string, h string").select(X.fuzzy_find(F.col("n"), F.col("h"), most).alias("x")).collect()]
        for (n, h), x in zip(rows, got, strict=True):
            want = next((s for size in range(max(len(n) - most, 1), len(n) + most + 1) for s in range(len(h) - size + 1) if distance(h[s : s + size], n) <= most), -1) if n else -1
            assert x == want, (n, h, most)


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (X.zero_to_letter, "Be2Si04", "Be2SiO4"), (X.zero_to_letter, "Fe0.947O", "Fe0.947O"), (X.fix_letters, "All3", "AlI3"), (X.fix_letters, "Gal3", "GaI3"), (X.fix_letters, "CIO2", "ClO2"),
        (X.fix_water, "CaSO4*2H20", "CaSO4*2H2O"), (X.strip_all_tags, "Al2O3[C][b]", "Al2O3"), (X.match_key, "{Al2 o3}[l]", "[A1203][I]".replace("1", "I")), (X.file_stem, "a b/c(1).cif", "a_b_c(1).cif"),
        (X.phase_token, "§OL-A1l", "SOL-A11"), (X.page_repair, "1. 5 - 3 4-2", "1.5 -3 4 -2"), (X.row_repair, "29815 §5,229 1-2.5", "298.15 55.229 1 -2.5"),
    ],
)
def test_repairs(spark, f, text, want):
    assert one(spark, f(F.col("t")), t=text) == want


def test_digits(spark):
    assert one(spark, X.snap_digit(F.col("a"), F.col("b")), a=87.226, b=37.2) == 37.226
    assert one(spark, X.snap_digit(F.col("a"), F.col("b"), fallback=False), a=87.226, b=55.0) is None
    assert one(spark, X.snap_digit(F.col("a"), F.col("b")), a=87.226, b=55.0) == 55.0
    assert one(spark, X.digit_run_positions(F.col("t")), t="Al4B209Si12") == [5, 9]
    assert one(spark, X.closest_match(F.col("t"), F.array(F.lit("abc"), F.lit("abd"))), t="abe") == "abc"
    bare, tag = X.strip_tag(F.col("t"))
    assert one(spark, bare, t="C[D]") == "C" and one(spark, tag, t="C[]") == "" and one(spark, tag, t="C") is None


@pytest.mark.parametrize(
    ("formula", "want"),
    [("Ca2Si3O8*2.5H2O", "Ca4Si6H10O21"), ("Al2(SO4)3", "Al2(SO4)3"), ("O", "O2"), ("NaO", "Na2O2"), ("Ca5Si6O17*10.5w", None), ("1/2Al2O3", "Al2O3"), ("", None), ("(Fe", None), ("Xx2", None)],
)
def test_reduced(formula, want):
    assert chem.reduced_formula(chem.parse(formula)) == want


@pytest.mark.parametrize(
    ("formula", "name", "want"),
    [
        ("Al4B209", "ALUMINIUM BORATE", "Al4B2O9"), ("2rCl2", "ZIRCONIUM CHLORIDE", "ZrCl2"), ("PrS", "PLATINUM SULFIDE", "PtS"), ("SCl3", "SCANDIUM CHLORIDE", "ScCl3"), ("PIS", "PLATINUM SULFIDE", "PtS"),
        ("Fe0.9470", "IRON OXIDE", "Fe0.947O"), ("MgO", "MAGNESIUM OXIDE", "MgO"), ("MgO", None, "MgO"),
    ],
)
def test_repair(formula, name, want):
    assert chem.repair(formula, name) == want


def test_implied():
    assert chem.implied("TRILITHIUM HEXAFLUOROALUMINATE") == {"Al"}
    assert chem.implied("SODIUM HYDROXIDE") == {"Na", "O"}


def test_maps(spark):
    df = spark.createDataFrame([("C2H6O", "- C4 H12 O2 -"), ("Fe0.9O", "- Fe O -"), (None, None)], "f string, s string")
    df = df.select(chem.parse_column(F.col("f")).alias("c"), chem.parse_spaced(F.col("s")).alias("o"))
    rows = df.select(chem.is_organic(F.col("c")).alias("org"), chem.is_nonstoichiometric(F.col("c")).alias("non"), chem.ratio_error(F.col("c"), F.col("o")).alias("err"), chem.whole_multiple(F.col("c"), F.col("o")).alias("k"), chem.ratio_close(F.col("c"), F.col("o")).alias("close")).collect()
    assert tuple(rows[0])[:2] == (True, False) and rows[0]["err"] < 1e-9 and rows[0]["k"]
    assert tuple(rows[1])[:2] == (False, True) and abs(rows[1]["err"] - (0.5 - 0.9 / 1.9)) < 1e-9 and not rows[1]["close"]
    assert rows[2]["k"] and rows[2]["close"] and rows[2]["err"] is None


def test_names_of_rare_elements():
    for name, elements in (("RADIUM CHLORIDE", {"Ra", "Cl"}), ("XENON FLUORIDE", {"Xe", "F"}), ("TECHNETIUM OXIDE", {"Tc", "O"}), ("CALCIUM HYDROXIDE", {"Ca", "O"}), ("SODIUM PERCHLORATE", {"Na", "Cl", "O"})):
        assert chem.implied(name) == elements
    assert chem.repair("PaCl2", "RADIUM CHLORIDE") == "RaCl2"
