"""From ordered text lines to phase tables: header cut, segmentation, row repair, column recovery and gating."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.functions import text as X

from .series import consistency_flags, corrections, monotone_gate

COLUMNS = ("t", "cp", "s", "gef", "h", "h_h298", "g", "dhf", "dgf", "logkf")
# Right edges of a page's ten columns, as shares of its width.
EDGES = (0.08, 0.17, 0.27, 0.38, 0.48, 0.58, 0.69, 0.80, 0.90)
# A table's header line, with the first letter after its first word; and the heading that ends a table.
HEADER = r"(?i)^[^A-Za-z]{0,3}Phase\b[^A-Za-z]{0,10}([A-Za-z])"
ENDING = "REFERENCES"


def bin_words(words: DataFrame) -> DataFrame:
    """(page, block, par, line, word_idx, text, left, width, page_width) to (page, block, par, line, text): under five
    words are joined as they are; others go to ten columns by their centre, each column's words without a space."""
    centre = (F.col("left") + F.col("width") / 2) / F.col("page_width")
    bin_ = sum((F.when(centre >= e, 1).otherwise(0) for e in EDGES), F.lit(0))
    cells = F.array_sort(F.collect_list(F.struct("word_idx", bin_.alias("bin"), "text")))
    lines = words.groupBy("page", "block", "par", "line").agg(cells.alias("w"))
    parted = F.transform(F.sequence(F.lit(0), F.lit(len(EDGES))), lambda b: F.array_join(F.transform(F.filter("w", lambda x: x["bin"] == b), lambda x: x["text"]), ""))
    joined = F.array_join(F.transform("w", lambda x: x["text"]), " ")
    return lines.select("page", "block", "par", "line", F.when(F.size("w") < 5, joined).otherwise(F.array_join(F.filter(parted, lambda x: x != ""), " ")).alias("text"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Without blank lines and lines that are one decimal number."""
    return lines.where((F.trim("text") != "") & ~F.col("text").rlike(rf"^\s*{X.NUMBER}\s*$"))


def is_header(text: Column) -> Column:
    """Does a line head a table of data? The one of the references has an H there."""
    return ~F.regexp_extract(text, HEADER, 1).isin("", "H", "h")


def _ends(text: Column, most: int = 2) -> Column:
    """Is the heading that ends a table in a line, but for two edits? Near texts show a third of it whole, whatever
    marks stand between its letters: only such lines are searched."""
    cuts = [len(ENDING) * i // (most + 1) for i in range(most + 2)]
    pieces = (r"[^A-Za-z0-9\[\]]*".join(ENDING[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    key = X.match_key(text)
    found = key.contains(ENDING) | (X.fuzzy_find(F.lit(ENDING), key, most) != -1)
    return F.when(text.rlike(f"(?i){'|'.join(pieces)}"), found).otherwise(F.lit(False))


def segment(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Lines (entry_id, line_no, text) of entries (entry_id, formula, name) to (entry_id, line_no, phase_seq, phase,
    last_phase, opens, rest), in closed form and without the unfinished last phase.

    Lines count from the first header that names the entry: a name in the three lines before a header is tried first, then a
    formula; nothing found cuts nothing. A line opens a phase if its first token has a letter, is no unit label and no
    references heading, and a header is near or a phase is open; the first references heading that opens none ends the
    table. ``last_phase``: is it the last of an entry's phases that ended?

    What a line says is worked out first, with a running count of the lines that could open a phase. Where an entry starts,
    opens and ends are least lines, and phases are differences of counts: three passes over one order.
    """
    order, whole = W.partitionBy("entry_id").orderBy("line_no"), W.partitionBy("entry_id")
    running, col = order.rowsBetween(W.unboundedPreceding, 0), F.col
    rows = clean_lines(lines).select("entry_id", "line_no", "text", F.regexp_extract("text", r"(\S+)", 1).alias("_raw")).withColumn("_token", X.phase_token(col("_raw")))
    rows = rows.withColumn("_ref", F.coalesce(_ends(col("_token")), F.lit(False))).withColumns({"_says": ~col("_ref") & _ends(col("text"))})
    base = col("_token").rlike(r"(?U)\p{L}") & ~col("_token").rlike(X.TEMP_LABEL) & ~col("_ref")
    rows = rows.withColumns({"_base": F.coalesce(base, F.lit(False)), "_at": F.when(col("text").contains("Phase"), F.coalesce(col("line_no").cast("long"), F.lit(-(2**63))))})
    back = lambda c: [F.lag(c, k).over(order) for k in (3, 2, 1)]
    rows = rows.withColumns({
        "_near": F.greatest(*back("_at")), "_run": F.sum(col("_base").cast("int")).over(running), "_before": F.concat_ws(" ", *back("text")),
        "phase": F.last(F.when(col("_base"), col("_token")), ignorenulls=True).over(running),
    })
    # Keys are made once an entry, and of lines for headers only.
    rows = rows.select("entry_id", "line_no", "text", "_raw", "_ref", "_says", "_base", "_near", "_run", "phase", F.when(is_header(col("text")), X.match_key(col("_before"))).alias("_hay"))
    rows = rows.join(entries.select("entry_id", X.match_key(col("name")).alias("_name"), X.match_key(col("formula")).alias("_formula")), "entry_id", "left")
    has = lambda c: (F.length(c) > 0) & col("_hay").contains(col(c))
    tier = F.when(has("_name"), 1).when(has("_formula"), 2)
    rows = rows.withColumn("_tier", F.when(tier.isNotNull(), F.struct(tier.alias("tier"), "line_no"))).drop("_hay", "_name", "_formula")
    rows = rows.withColumn("_start", F.min("_tier").over(whole)["line_no"]).drop("_tier").where(col("_start").isNull() | (col("line_no") >= col("_start")))

    least = lambda test, n: F.min(F.when(test & col("line_no").isNotNull(), F.struct("line_no", n.alias("n")))).over(whole)
    near = col("_near").isNotNull() & (col("_start").isNull() | (col("_near") >= col("_start")))
    done = col("_run") - col("_base").cast("int")
    # A heading on a line that could open a phase ends the table only before the first that does.
    rows = rows.withColumns({
        "_open": least(col("_base") & near, col("_run")), "_end": least(col("_ref") | (~col("_base") & col("_says")), done),
        "_early": least(col("_base") & col("_says"), done), "_top": F.max("_run").over(whole),
    })
    rows = rows.where(col("_open").isNotNull() & (col("_run") >= col("_open.n")) & (col("_end").isNull() | (col("line_no") < col("_end.line_no"))) & ~F.coalesce(col("_early.line_no") < col("_open.line_no"), F.lit(False)))
    last = F.coalesce(col("_end.n"), col("_top") - 1)
    rest = F.when(col("_base"), X.strip_first(col("text"), col("_raw"))).otherwise(col("text"))
    return rows.where(col("_run") <= last).select("entry_id", "line_no", (col("_run") - col("_open.n") + 1).alias("phase_seq"), "phase", (col("_run") == last).alias("last_phase"), col("_base").alias("opens"), rest.alias("rest"))


def combination_table(spark: SparkSession, least: int = 9, most: int = 15) -> DataFrame:
    """(n, tests, picks): for n numbers, the distinct test positions with their first rank, and all picks by rank."""
    rows = []
    for n in range(least, most + 1):
        picks = [c for size in ((10, 9) if n >= 10 else (9,)) for c in combinations(range(n), size)]
        tests: dict[tuple, int] = {}
        for rank, c in enumerate(picks):
            tests.setdefault((c[0], c[2], c[4], c[6]), rank)
        rows.append((n, [(*k, v) for k, v in tests.items()], [list(c) for c in picks]))
    return spark.createDataFrame(rows, "n int, tests array<struct<a:int,b:int,c:int,d:int,rank:int>>, picks array<array<int>>")


def recover_columns(df: DataFrame, found: str = "numbers", strict: float = 2.0, loose: float = 50.0) -> DataFrame:
    """``df`` with ``fit`` (ten numbers or null) and used_fallback: the first choice of ten, then nine, of up to 15
    numbers that satisfies G = H - T * S / 1000; else the first ten, or nine and 0, if nearly so."""
    least, most = 9, 15
    table = combination_table(df.sparkSession, least, most).withColumnRenamed("n", "_n")
    x = lambda i: F.get(F.col(found), i)
    off = lambda t, s, h, g: F.abs(h - F.abs(t) * s / 1000.0 - g)
    apart = off(x(F.lit(0)), x(F.lit(2)), x(F.lit(4)), x(F.lit(6)))
    # The first of all choices are the first numbers as they stand: rows that they satisfy don't meet the table.
    rows = df.withColumn("_size", F.size(found))
    rows = rows.withColumn("_plain", F.coalesce(F.col("_size").between(least, most) & (apart <= strict), F.lit(False)))
    rows = rows.join(F.broadcast(table), F.when(~F.col("_plain"), F.col("_size")) == F.col("_n"), "left")
    good = F.filter("tests", lambda c: off(x(c["a"]), x(c["b"]), x(c["c"]), x(c["d"])) <= strict)
    rank = F.array_min(F.transform(good, lambda c: c["rank"]))
    pad = lambda a: F.when(F.size(a) == 9, F.concat(a, F.array(F.lit(0.0)))).otherwise(a)
    picked = lambda r: F.when(r.isNotNull(), _once(F.transform(F.get("picks", r), lambda i: x(i)), pad))
    front = F.when((F.col("_size") >= least) & (apart <= loose), pad(F.slice(found, 1, 10)))
    fit = F.when(F.col("_plain"), pad(F.slice(found, 1, 10))).otherwise(_once(rank, picked))
    both = lambda b: F.struct(F.coalesce(b["fit"], b["front"]).alias("fit"), (b["fit"].isNull() & b["front"].isNotNull()).alias("used_fallback"))
    # Out of a generator, so that what is asked of ``fit`` later doesn't work the search out again.
    made = F.transform(F.array(F.struct(fit.alias("fit"), front.alias("front"))), both)
    return rows.select("*", F.inline(made)).drop("_n", "_size", "_plain", "tests", "picks")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def table_lines(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Page lines of entries to the table rows that they may be: entry_id, phase_seq, phase, last_phase, row_idx,
    used_fallback, ten numbers and accepted.

    A phase that ended stays though none of its lines be a row: the line that opened it is kept, with null numbers and not
    accepted. ``last_phase`` is true in the last phase of an entry that ended, whether it has rows or not.
    """
    rows = segment(lines, entries).withColumn("_word", F.regexp_extract("rest", r"(\S+)", 1))
    word, wide = F.col("_word"), F.col("rest").rlike(r"\S\s++\S++\s++\S++\s++\S")
    shout = word.rlike(r"\p{Lu}") & (F.upper(word) == word) & ~word.rlike(X.TEMP_LABEL)
    rest = F.when(wide, F.when(shout, X.strip_first(F.col("rest"), word)).otherwise(F.col("rest")))
    rows = recover_columns(rows.withColumn("numbers", X.numbers(X.row_repair(rest)))).where("fit is not null or opens")
    named = [(F.abs(F.get("fit", F.lit(i))) if i == 0 else F.get("fit", F.lit(i))).alias(c) for i, c in enumerate(COLUMNS)]
    rows = rows.select("entry_id", "phase_seq", "phase", "last_phase", F.col("line_no").alias("row_idx"), "used_fallback", *named)
    return monotone_gate(rows, "entry_id", "row_idx", "t", "s", "g")


def phase_rows(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Page lines of entries to accepted table rows: entry_id, phase_seq, phase, row_idx and ten numbers."""
    return table_lines(lines, entries).where("accepted").drop("accepted", "last_phase")


def checked_rows(rows: DataFrame) -> DataFrame:
    """``table_lines`` with cp and s as corrected (cp_read and s_read as they were), reasons of the corrections, and
    cp_wrong and s_sign_wrong: what still doesn't agree. Only the last phase that ended has its last row tested."""
    keys = ["entry_id", "phase_seq", "accepted"]
    rows = corrections(rows, keys, "row_idx", F.col("last_phase")).withColumnsRenamed({"cp": "cp_read", "s": "s_read"})
    return consistency_flags(rows.withColumnsRenamed({"cp_fixed": "cp", "s_fixed": "s"}), keys, "row_idx", F.col("last_phase"))


def material_documents(rows: DataFrame) -> DataFrame:
    """(entry_id, phases): a map from phase to its columns; of repeated phase names the last block stays. Rows that are
    not ``accepted``, if there is such a column, only tell that their phase is there."""
    kept = F.col("accepted") if "accepted" in rows.columns else F.lit(True)
    each = rows.groupBy("entry_id", "phase_seq", "phase").agg(F.array_sort(F.collect_list(F.when(kept, F.struct("row_idx", *COLUMNS)))).alias("r"))
    column = lambda c: F.transform("r", lambda x: x[c]).alias(c)
    block = F.struct(*map(column, COLUMNS))
    last = each.groupBy("entry_id", "phase").agg(F.max_by(block, "phase_seq").alias("block"))
    return last.groupBy("entry_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("phase").alias("key"), F.col("block").alias("value")))).alias("phases"))


def page_offset(page: Column) -> Column:
    """Printed page to scanned page: fixed values, by stretch."""
    return page + F.when(page <= 924, 114).when(page <= 1200, 115).otherwise(116)
