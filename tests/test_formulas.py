"""Formulas as columns against the same rules in plain Python."""

import csv
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabularium.functions import chem

PLAIN = """H2O Al2(SO4)3 CaSO4*2H2O CaSO4*0.5H2O CaSO4*1/2H2O 2(CaO) Fe0.877S Fe.5O K3(Fe(CN)6)2 ((H)) () (H Xx2 H) H2O) Na2O2 NaO LiO HO O N2 Cl U3O8 H1.2.3 H1. *H2O H2O* 0H2O 1/0H2O 2 1/2 CO Co cO Mg3Si2O5(OH)4
NaAlSi2O6 Ca5Si6O17*5.5H2O Ca2Si3O8*2.5H2O (NH4)2SO4 Hg2(NO3)2 C6H12O6 CH4N2O As2O3*P2O5 WO2.96 Pr7O12 (Al(OH)3)2*3(H2O)0.5 Fe0.01O NO2 N2O4 AlCl3*6H2O Kr2 Am Cm Rf h2o 3H2 10.5NaCl K2S2O8 CaC2O4 Na2B4O7*10H2O""".split()


def cases():
    rng = random.Random(7)
    made = list(PLAIN)
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 2)):
            body = "".join(rng.choice(["Al", "O", "H", "C", "Fe", "(OH)", "(SO4)2", "Si", "N", "(C(NH2)2)", "B"]) + rng.choice(["", "2", "3", "10", "0.5", "1.333", ".25", "0.9", "7.01"]) for _ in range(rng.randint(1, 4)))
            parts.append(rng.choice(["", "", "2", "1/3", "0.5"]) + body)
        made.append("*".join(parts))
    return made


def test_parse_and_reduce_as_columns(spark):
    given = [(i, f) for i, f in enumerate([*cases(), "", None])]
    df = spark.createDataFrame(given, "i int, f string").repartition(4)
    got = {r["i"]: r for r in df.select("i", F.map_keys(chem.parse_column(F.col("f"))).alias("k"), chem.parse_column(F.col("f")).alias("c"), chem.reduced_column(F.col("f")).alias("r")).collect()}
    for i, f in given:
        want = chem.parse(f)
        have = got[i]["c"]
        assert (have is None) == (want is None), (f, have, want)
        if want is not None:
            assert got[i]["k"] == list(want) and all(abs(have[k] - v) < 1e-9 * max(1, v) for k, v in want.items()), (f, have, want)
            assert got[i]["r"] == chem.reduced_formula(want), (f, got[i]["r"], chem.reduced_formula(want))
    plan = df.select(chem.reduced_column(F.col("f")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


GOLDEN = os.environ.get("TABULARIUM_GOLDEN")  # a folder with tables of results and a folder of structure files, if there is one to compare with


@pytest.mark.skipif(not GOLDEN, reason="no tables are given")
def test_reduced_formulas_of_a_printed_table(spark):
    """All formulas of the tables of results reduce to what those say, and the one that can't be read to null."""
    each = [r for p in Path(GOLDEN).glob("*.csv") for r in csv.DictReader(p.open()) if "bare_formula" in r]
    rows = [*{(r["bare_formula"], r["reduced_formula"] or None) for r in each if r["match_method"] != "gas_phase_organic"}]
    got = spark.createDataFrame(rows, "f string, want string").withColumn("r", chem.reduced_column(F.col("f")))
    assert [tuple(r) for r in got.where("not (r <=> want)").select("f", "want", "r").collect()] == [] and len(rows) > 100


@pytest.mark.skipif(not GOLDEN, reason="no structure files are given")
def test_reduced_formulas_of_structure_files(spark):
    """File names, without tags, against the formula inside: all but misread names, deuterium, and texts of the files' authors."""
    from tabularium.functions import text as X
    from tabularium.sources import cif, io

    files = cif.read_items(io.read_cifs(spark, f"{GOLDEN}/*/*.cif")).where("loop is null")
    rows = files.select(X.strip_all_tags(F.regexp_replace(F.url_decode("file"), r"\.cif$", "")).alias("f"), F.col("values._chemical_formula_structural").alias("want")).where("want is not null")
    wrong = rows.where(~chem.reduced_column(F.col("f")).eqNullSafe(F.col("want")))
    assert rows.count() == 1362 and wrong.count() <= 13, wrong.collect()
