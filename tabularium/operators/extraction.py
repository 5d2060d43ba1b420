"""The run from page lines and a table of contents to documents and audits.

``extracted`` makes one table, a row per table row (and one per phase or entry without any); ``documents``,
``unverified_pages`` and ``inconsistencies`` are read off it. Write it once (``sources.store.stored``) where more than
one of them is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.functions import text as X
from tabularium.operators import match, pages
from tabularium.sources.store import stored


def contents(toc: DataFrame) -> DataFrame:
    """One entry per formula of a table of contents (row_id, formula, name, page): the first row's name and page.

    entry_id, formula (zeros before digits read as O), name, guess (the scanned page). Null formulas are no
    entries, null names are empty.
    """
    first = match.first_per_key(toc.where(F.col("formula").isNotNull()).select("formula", "row_id", "name", "page"), "formula", "row_id")
    return first.select(F.col("row_id").alias("entry_id"), X.zero_to_letter(F.col("formula")).alias("formula"), F.coalesce("name", F.lit("")).alias("name"), pages.page_offset(F.col("page")).alias("guess"))


def page_headers(lines: DataFrame, back: int = 3) -> DataFrame:
    """(page, headers): for each page of (page, line_no, text), what stands in the ``back`` lines before its headers."""
    w = W.partitionBy("page").orderBy("line_no")
    before = F.concat_ws(" ", *[F.lag("text", k).over(w) for k in range(back, 0, -1)])
    found = lines.withColumn("_before", before).where(pages.is_header(F.col("text")))
    listed = F.array_sort(F.collect_list(F.struct("line_no", "_before")))
    return found.groupBy("page").agg(F.array_join(F.transform(listed, lambda x: x["_before"]), " ").alias("headers"))


def with_pages(entries: DataFrame, lines: DataFrame, radius: int = 3) -> DataFrame:
    """``entries`` with page and verified: the nearest page whose headers name the entry, else the guess."""
    asked = entries.select("entry_id", "formula", "name", "guess")
    good = X.page_contains(F.col("headers"), F.col("formula"), F.col("name"))
    found = match.band_search(asked, "guess", page_headers(lines), "page", good, radius)
    return found.select("entry_id", "formula", "name", "guess", F.col("page_used").alias("page"), "verified")


def extracted(lines: DataFrame, toc: DataFrame, radius: int = 3) -> DataFrame:
    """Entries with their page, and the rows of their phases as ``pages.checked_rows`` gives them; an entry whose page
    has no phase has one row of nulls. ``lines`` are read twice: write them first if they take work. Entries with their
    pages are written once."""
    entries = stored(with_pages(contents(toc), lines, radius), "entries")
    own = entries.select("entry_id", "page").join(lines, "page").select("entry_id", "line_no", "text")
    # Dealt by entry once, for all that follows: series are parts of entries.
    rows = pages.checked_rows(pages.table_lines(own, entries.select("entry_id", "formula", "name")).repartition("entry_id"))
    return entries.join(rows, "entry_id", "left")


def documents(run: DataFrame) -> DataFrame:
    """(formula, name, page_number, phases): a document per entry; no phases give an empty map."""
    each = run.select("entry_id", "formula", "name", F.col("page").alias("page_number")).distinct()
    made = pages.material_documents(run.where("phase is not null"))
    none = F.map_from_arrays(F.array(), F.array()).cast(made.schema["phases"].dataType)
    return each.join(made, "entry_id", "left").select("formula", "name", "page_number", F.coalesce("phases", none).alias("phases"))


def unverified_pages(run: DataFrame) -> DataFrame:
    """(formula, name, page_num_used) of the entries that no page's headers name."""
    return run.where(~F.col("verified")).select("formula", "name", F.col("page").alias("page_num_used")).distinct()


def inconsistencies(run: DataFrame) -> DataFrame:
    """(formula, name, phase, T, Cp, S, reasons): rows that contradict their neighbours after all corrections."""
    reasons = F.concat_ws(",", F.when(F.col("cp_wrong"), F.lit("Cp")), F.when(F.col("s_sign_wrong"), F.lit("S_sign")))
    return run.where("accepted and (cp_wrong or s_sign_wrong)").select("formula", "name", "phase", F.col("t").alias("T"), F.col("cp").alias("Cp"), F.col("s").alias("S"), reasons.alias("reasons"))
