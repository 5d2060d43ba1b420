"""Sinks of named files, landed look-ups, structure files by their grammar, batches and the run's report."""

import json
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabularium.operators import outcomes
from tabularium.sources import cif, io, landed, named

GOLDEN = os.environ.get("TABULARIUM_GOLDEN")  # a folder with a folder of structure files, if there is one to compare with


def save(df, path, **more):
    named.save(df, F.col("k"), F.col("v"), F.col("o"), str(path), ".json", **more)


def test_named_files_replace_resume_and_abort(spark, tmp_path):
    kinds = "k string, v string, o int"
    save(spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", None, 1), (None, "x", 1), ("[é]*", "y", 1)], kinds).repartition(3), tmp_path / "out")
    there = lambda: {p.name: p.read_text() for p in (tmp_path / "out").iterdir() if p.is_file()}
    assert there() == {"a.json": "new", "b.json": "", "[é]*.json": "y"}
    save(spark.createDataFrame([("a", "third", 1), ("c", "z", 1)], kinds), tmp_path / "out", resume=True)
    assert there() == {"a.json": "new", "b.json": "", "[é]*.json": "y", "c.json": "z"}
    save(spark.createDataFrame([("a", "third", 1)], kinds), tmp_path / "out")
    assert there()["a.json"] == "third"
    assert sorted(r["stem"] for r in named.finished(spark, str(tmp_path / "out")).collect()) == ["[é]*", "a", "b", "c"]
    with pytest.raises(Exception, match="stop"):  # a task that fails leaves no file of any task
        save(spark.createDataFrame([(f"n{i}", "x", i) for i in range(20)], kinds).withColumn("v", F.when(F.col("o") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("v"))), tmp_path / "out")
    assert len(there()) == 4 and not list((tmp_path / "out" / "_staging").iterdir())
    save(spark.createDataFrame([], kinds), tmp_path / "out")
    assert len(there()) == 4 and named.finished(spark, str(tmp_path / "none")).count() == 0


def test_attempts_leave_one_copy(tmp_path):
    """What two attempts of a task wrote: the commit names one of them."""
    writer = named.NamedFilesWriter(str(tmp_path), ".txt")
    for attempt in ("0-1", "0-2"):
        folder = tmp_path / "_staging" / writer.run / attempt
        folder.mkdir(parents=True)
        (folder / "k.txt").write_text(attempt)
    writer.commit([named.Written(f"{tmp_path}/_staging/{writer.run}/0-2"), None])
    assert (tmp_path / "k.txt").read_text() == "0-2" and not list((tmp_path / "_staging").iterdir())


def test_landed_batches(spark, tmp_path):
    class Flaky(landed.LandedBatches):
        """Batch 1 comes at the third try, batch 2 never."""

        @classmethod
        def name(cls):
            return "flaky_batches"

        def reader(self, schema):
            found = super().reader(schema)
            tries = Counter()
            fetch = found.fetch

            def sometimes(batch):
                tries[batch] += 1
                if batch == 2 or batch == 1 and tries[batch] < 3:
                    raise OSError("busy")
                return fetch(batch)

            found.fetch = sometimes
            return found

    keys = spark.createDataFrame([(f"F{i:03d}",) for i in range(450)] + [(None,), ("F001",)], "f string")
    asked = landed.requests(keys, "f")
    assert Counter(r["batch"] for r in asked.collect()) == {0: 100, 1: 100, 2: 100, 3: 100, 4: 50}
    for b in range(4):
        (tmp_path / f"batch-{b:06d}.json").write_text("\n".join(json.dumps({"f": f"F{i:03d}", "n": i}) for i in range(100 * b, 100 * b + 99)))
    rows, failures = landed.read_landed(spark, str(tmp_path), asked, "f string, n int", source=Flaky, wait=0.0)
    assert Counter(r["_batch"] for r in rows.collect()) == {0: 99, 1: 99, 3: 99}
    assert {r["_batch"]: r["_error"].split(":")[0] for r in failures.collect()} == {2: "OSError", 4: "FileNotFoundError"}
    rows, failures = landed.read_landed(spark, str(tmp_path), asked.where("false"), "f string, n int", wait=0.0)
    assert rows.count() == failures.count() == 0


def test_landed_batches_share_tasks(spark, tmp_path):
    """Tasks don't grow with the batches; each batch is looked up once, though rows and failures are both read."""
    class Counting(landed.LandedBatches):
        @classmethod
        def name(cls):
            return "counting_batches"

        def reader(self, schema):
            found = super().reader(schema)
            fetch = found.fetch

            def counted(batch):
                (tmp_path / f"asked-{batch}-{uuid.uuid4().hex}").touch()
                return fetch(batch)

            found.fetch = counted
            assert len(found.partitions()) <= found.parts < 400
            return found

    asked = spark.range(40_000).select(F.col("id").alias("k"), F.floor(F.col("id") / 100).alias("batch"))
    for b in range(0, 400, 2):
        (tmp_path / f"batch-{b:06d}.json").write_text("\n".join(json.dumps({"k": i}) for i in range(100 * b, 100 * b + 100)))
    rows, failures = landed.read_landed(spark, str(tmp_path), asked, "k long", source=Counting, wait=0.0)
    assert sorted(r["k"] for r in rows.collect()) == [i for i in range(40_000) if i // 100 % 2 == 0]
    assert sorted(r["_batch"] for r in failures.collect()) == list(range(1, 400, 2))
    assert len(list(tmp_path.glob("asked-*"))) == 200 + 3 * 200


def test_structure_grammar():
    text = "#c\ndata_A\n_x 'it''s o'clock' # c\n_y \"a 'b'\"\n_z\n;line one\nloop_\n;\n_u ?\nloop_\n_p\n_q\n1 .\n'?' 2\n3\nloop_ _r 'a'\ndata_B\n_x 1.5(2)\n_lost\n"
    got = list(cif.items(text))
    assert got == [
        ("A", 0, 0, {"_p": "1", "_q": None}), ("A", 0, 1, {"_p": "?", "_q": "2"}), ("A", 0, 2, {"_p": "3"}), ("A", 1, 0, {"_r": "a"}),
        ("A", None, 0, {"_x": "it''s o'clock", "_y": "a 'b'", "_z": "line one\nloop_", "_u": None}), ("B", None, 0, {"_x": "1.5(2)"}),
    ]
    assert list(cif.items("")) == [] and list(cif.items("loop_\n_a\n")) == []
    many = "data_m\n" + "".join(f"loop_\n_a{i}\n{i}\n" for i in range(1500))
    assert [loop for _, loop, _, _ in cif.items(many)] == list(range(1500))


@pytest.mark.skipif(not GOLDEN, reason="no structure files are given")
def test_all_structure_files(spark):
    """Counts of the structure files that were measured for the survey."""
    files = io.read_cifs(spark, f"{GOLDEN}/*/*.cif").cache()
    assert files.count() == 1391 and files.select("source").distinct().count() == 1371
    items = cif.typed(cif.read_items(files)).cache()
    primary = files.where("source like 'Materials Project%'").select("file")
    loops = items.where("loop is not null").join(primary, "file")
    assert primary.count() == 1357 and loops.select("file", "loop").distinct().count() == 2 * 1357
    sites = loops.where("map_contains_key(values, '_atom_site_occupancy')")
    assert sites.count() == 6759 and sites.where("numbers._atom_site_occupancy = 1.0").count() == 6759
    assert loops.where("map_contains_key(values, '_symmetry_equiv_pos_as_xyz')").count() == 55044
    groups = items.where("loop is null").join(primary, "file").where("values['_symmetry_space_group_name_H-M'] = 'P 1' or values['_symmetry_space_group_name_H-M'] = 'P1'")
    assert groups.count() == 3


def test_ranges_follow_the_count(spark):
    keys = spark.range(20_000).select((F.col("id") * 7 % 20_011).cast("string").alias("k"))
    bounds = outcomes.key_ranges(keys, "k", 20_000, rows=500)
    sizes = [r["count"] for r in keys.groupBy(outcomes.range_of(F.col("k"), bounds)).count().collect()]
    assert len(sizes) == 40 and sum(sizes) == 20_000 and max(sizes) <= 1000
    ordered = sorted(r["k"] for r in keys.collect())
    got = {r["k"]: r["batch"] for r in outcomes.batch_ids(keys.union(keys), "k", 100, rows=500).collect()}
    assert got == {k: i // 100 for i, k in enumerate(ordered)}
    assert outcomes.batch_ids(keys.where("false"), "k", 100).count() == 0


def test_report_is_taken_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(x,) for x in ["a", "a", "b", None, "z"]], "v string")
    rows, seen = outcomes.observed(df, "v", ["a", "b", "c"])
    rows.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"_rows": 5, "_null": 1, "_other": 1, "a": 2, "b": 1, "c": 0}
    assert {r["v"]: r["n"] for r in outcomes.value_counts(spark.read.parquet(str(tmp_path / "t")), "v").collect()} == {"a": 2, "b": 1, "z": 1}
