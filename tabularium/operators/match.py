"""Lookups and candidate matching: first match, nearest string, set keys, tolerances, bands and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.functions import chem
from tabularium.sources.store import stored

LEVELS = 13  # how often cells of shares are halved: the smallest are a 4,096th of the tolerance


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key: an aggregation, so partial results are combined before the shuffle."""
    rest = [c for c in df.columns if c not in (key, order)]
    first = F.min(F.struct(order, *rest)).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{c}").alias(c) for c in (order, *rest)])


def _grams(text: Column, size: int | Column) -> Column:
    """The distinct parts of this length."""
    last = F.length(text) - size
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.substr(text, i + 1, F.lit(size)))))


def _index(names: DataFrame, name: str, size: int) -> DataFrame:
    """(name, _rank, _gram, _often): the names of each gram, and how many they are."""
    each = names.select(name, "_rank", F.explode(_grams(F.col(name), size)).alias("_gram"))
    return each.join(each.groupBy("_gram").agg(F.count("*").alias("_often")), "_gram")


def _spread(often: Column) -> Column:
    """To how many tasks a gram's texts are dealt, each of which gets its names: few copies of names even for common grams."""
    return (1 + F.floor(F.sqrt(often) / 8)).cast("int")


def _profiles(texts: DataFrame, text: str, index: DataFrame, size: int) -> DataFrame:
    """``texts`` with the grams that some name has, rarest first (_often, _gram), and how many of the text's grams no name has."""
    often = index.select("_gram", "_often").distinct()
    each = texts.withColumn("_gram", F.explode_outer(_grams(F.col(text), size))).join(often, "_gram", "left")
    known = F.array_sort(F.collect_list(F.when(F.col("_often").isNotNull(), F.struct("_often", "_gram"))))
    return each.groupBy(*texts.columns).agg(known.alias("_known"), F.count_if(F.col("_gram").isNotNull() & F.col("_often").isNull()).alias("_lost"))


def _near(probes: DataFrame, text: str, index: DataFrame, name: str) -> DataFrame:
    """(text, name, _rank, _d) for the names that share one of ``_probes`` and are at most ``_most`` edits away (null: any).

    A pair is only taken at the first probe that the name has, so no pair is measured twice and none need be sorted out.
    """
    salt = F.pmod(F.xxhash64(text), _spread(F.col("_p._often"))).cast("int")
    each = probes.select(text, "_most", "_probes", F.posexplode("_probes").alias("_at", "_p")).select("*", F.col("_p._gram").alias("_gram"), salt.alias("_salt"))
    held = index.select(name, "_rank", "_gram", F.explode(F.sequence(F.lit(0), _spread(F.col("_often")) - 1)).alias("_salt"))
    bound = F.coalesce("_most", F.greatest(F.length(text), F.length(name)))
    earlier = F.exists(F.slice("_probes", F.lit(1), F.col("_at")), lambda p: F.col(name).contains(p["_gram"]))
    pairs = each.join(held, ["_gram", "_salt"]).where((F.abs(F.length(text) - F.length(name)) <= bound) & ~earlier)
    # Beyond its third argument the distance is not worked out: it is -1.
    return pairs.select(text, name, "_rank", F.call_function("levenshtein", text, name, bound).alias("_d")).where("_d >= 0")


def nearest_string(df: DataFrame, column: str, names: DataFrame, name: str, order: str | None = None) -> DataFrame:
    """``df`` with its text's nearest name and their distance: least edits, then first by ``order`` (else by name).

    Rows with a null text, and all rows where there are no names, get nulls. Distinct texts meet distinct names by an
    index from pairs of letters to names. The names that have a text's rarest pair give a bound: the nearest is no
    farther. An edit takes at most two of a text's pairs away, so a name within d edits has one of any 2 d + 1 of them,
    those that no name has included: the rarest of them are probed, and what comes back is measured. A text with too
    few pairs for its bound, one that shares less than half with any name, is probed by single letters in the same way, and
    also meets the first name of each length up to its bound, the best of those that share no letter with it.
    """
    rank = F.min(F.col(order or name)).alias("_rank")
    known = names.where(F.col(name).isNotNull()).groupBy(name).agg(rank)
    texts = df.select(column).where(F.col(column).isNotNull()).distinct()
    held = {n: _index(known, name, n) for n in (1, 2)}
    # One row: the first name of each length. There are as many as names have lengths.
    by_length = known.groupBy(F.length(name).alias("n")).agg(F.min(F.struct("_rank", F.col(name).alias("name"))).alias("first"))
    lengths = F.broadcast(by_length.agg(F.array_sort(F.collect_list(F.struct("n", "first"))).alias("_lengths")))

    pairs = _profiles(texts, column, held[2], 2)
    begun = _near(pairs.select(column, F.lit(None).cast("int").alias("_most"), F.slice("_known", 1, 1).alias("_probes")), column, held[2], name)
    bounds = begun.groupBy(column).agg(F.min("_d").alias("_most"))
    farthest = F.greatest(F.length(column), F.get("_lengths", F.lit(0))["n"])
    pairs = pairs.join(bounds, column, "left").join(lengths).withColumn("_most", F.coalesce("_most", farthest))
    needed = 2 * F.col("_most") + 1 - F.col("_lost")
    sure = F.size("_known") >= needed
    probes = pairs.where(sure).select(column, "_most", F.slice("_known", F.lit(1), F.greatest(needed, F.lit(0)).cast("int")).alias("_probes"))

    rest = _profiles(pairs.where(~sure).select(column, "_most"), column, held[1], 1)
    needed = F.greatest(F.col("_most") + 1 - F.col("_lost"), F.lit(0)).cast("int")
    letters = rest.select(column, "_most", F.slice("_known", F.lit(1), needed).alias("_probes"))
    strange = pairs.where(~sure).select(column, "_most", F.explode(F.filter("_lengths", lambda x: x["n"] <= F.col("_most"))).alias("_x"))
    strange = strange.select(column, F.col("_x.first.name").alias(name), F.col("_x.first._rank").alias("_rank")).withColumn("_d", F.levenshtein(column, name))

    found = _near(probes, column, held[2], name).unionByName(_near(letters, column, held[1], name)).unionByName(strange)
    best = found.groupBy(column).agg(F.min(F.struct("_d", "_rank", F.col(name).alias("n"))).alias("_b"))
    return df.join(best.select(column, F.col("_b.n").alias("nearest"), F.col("_b._d").alias("distance")), column, "left")


def substring_pairs(needles: DataFrame, item: str, needle: str, docs: DataFrame, doc: str, body: str, size: int = 4) -> DataFrame:
    """(doc, item) for each row of ``docs`` whose body contains a needle; empty and null needles are in nothing.

    An inverted index of grams: a needle's words are cut into grams of ``size`` letters (all of a shorter word), and the one
    whose words stand in the fewest documents is its anchor. A document's word fits if it could be the anchor's word: one that
    ends with a needle's first word, starts with its last, is one between, or holds a needle of one word, which is then found.
    Only words that fit are looked up in the table of (doc, word), which is written once, and only what is left of needles of
    several words meets its bodies again. A needle with a gram that no word has costs nothing further.
    """
    parts = F.split(needle, "[ \n]")
    asked = needles.where(F.length(needle) > 0).select(item, needle)
    long = F.least(F.array_max(F.transform(parts, F.length)), F.lit(size))
    cut = asked.select(item, long.alias("_n"), F.size(parts).alias("_k"), F.posexplode(parts).alias("_at", "_part"))
    cut = cut.select("*", F.explode(_grams(F.col("_part"), F.col("_n"))).alias("_gram"))
    sizes = F.broadcast(cut.agg(F.collect_set("_n").alias("_sizes")))  # one row of at most ``size`` + 1 numbers
    # Rows may share an id: each is told by a number of its own, which is written with it.
    each = stored(docs.select(doc, F.monotonically_increasing_id().alias("_row"), body).select(doc, "_row", F.explode(F.array_distinct(F.split(body, "[ \n]"))).alias("_word")), "words")
    words = each.groupBy("_word").agg(F.count("*").alias("_docs")).join(sizes)
    shown = words.select("_word", "_docs", F.explode(F.flatten(F.transform("_sizes", lambda n: _grams(F.col("_word"), n)))).alias("_gram"))
    shown = stored(shown.join(cut.select("_gram").distinct(), "_gram"), "grams")
    weights = shown.groupBy("_gram").agg(F.sum("_docs").alias("_docs"))
    anchor = F.min(F.struct(F.coalesce("_docs", F.lit(0)).alias("docs"), "_gram", "_part", "_at", "_k")).alias("_a")
    anchors = cut.join(weights, "_gram", "left").groupBy(item).agg(anchor).select(item, "_a.*")
    word, part, alone = F.col("_word"), F.col("_part"), F.col("_k") == 1
    fits = F.when(alone, word.contains(part)).when(F.col("_at") == 0, word.endswith(part)).when(F.col("_at") == F.col("_k") - 1, word.startswith(part)).otherwise(word == part)
    # Written, so that Spark knows how few they are before it moves the table of words.
    hits = stored(shown.join(anchors, "_gram").where(fits).select("_word", item, alone.alias("_alone")), "hits")
    near = stored(each.join(hits, "_word").select(doc, "_row", item, "_alone").distinct(), "near")
    rest = near.where("not _alone").select(F.col(doc).alias("_doc"), item).distinct().join(asked, item)
    met = rest.join(docs.select(doc, body), F.col("_doc").eqNullSafe(F.col(doc))).where(F.col(body).contains(F.col(needle)))
    return near.where("_alone").select(doc, item).unionByName(met.select(doc, item))


def tolerance_match(left: DataFrame, right: DataFrame, keys: list[str], comp: str, other: str, tolerance: float, order: list[Column], keep: list[str], digits: int | None = None, but: tuple[str, str] | None = None) -> DataFrame:
    """``left`` with err and ``keep`` of its best right row of the same keys and elements within a tolerance, or nulls.

    The error is the largest difference of shares (``chem.ratio_error``), as ``nearest_shares`` takes it.
    """
    rows = left.withColumns({"_el": chem.element_key(F.col(comp)), "_at": chem.shares(F.col(comp))})
    held = right.withColumns({"_el": chem.element_key(F.col(other)), "_to": chem.shares(F.col(other))})
    return nearest_shares(rows, held, [*keys, "_el"], "_at", "_to", tolerance, order, keep, digits, but).select(*left.columns, "err", *keep)


def nearest_shares(left: DataFrame, right: DataFrame, on: list[str], at: str, to: str, tolerance: float, order: list[Column], keep: list[str], digits: int | None = None, but: tuple[str, str] | None = None) -> DataFrame:
    """``left`` with err and ``keep`` of its best right row of the same ``on`` within a tolerance, or nulls.

    The error is the largest difference between the arrays ``at`` and ``to``, which have one length for one ``on``, to ``digits``;
    equal errors go by ``order``, then ``keep``. Null arrays match nothing.
    ``but``: a left column and a kept one that must differ. Equal shares are compared once. Shares are put into cells
    of the tolerance's width and of its halves, quarters and so on: a row that has another in its own cell finds its best no
    farther than that cell's width, so it only meets the cells beside the smallest such one, however many lie within the tolerance.
    """
    some, slack = 2 if but else 1, 10.0**-digits if digits else 0.0
    width = F.lit(tolerance) / F.pow(F.lit(2.0), F.col("_level"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("_level")
    own = lambda at: F.transform(at, lambda x: F.floor(x / width))
    # The last share mostly follows from the others, and three tell enough apart; these cells leave room for rounding.
    beside = lambda at: F.transform(F.slice(at, F.lit(1), F.least(F.greatest(F.size(at) - 1, F.lit(1)), F.lit(3))), lambda x: F.floor(x / (width * 1.01 + 2 * slack)))
    step = lambda cells, c: F.flatten(F.transform(cells, lambda x: F.transform(F.array(c - 1, c, c + 1), lambda y: F.concat(x, F.array(y)))))
    around = lambda at: F.aggregate(beside(at), F.array(F.array().cast("array<bigint>")), step)

    rows = left.withColumn("_at", F.col(at))
    held = right.select(*on, F.col(to).alias("_to"), F.struct(*order, *keep).alias("_r")).where("_to is not null")
    first = W.partitionBy(*on, "_to").orderBy("_r")
    held = stored(held.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= some).drop("_n"), "shares")
    shared = held.select(*on, "_to", levels).groupBy(*on, "_level", own(F.col("_to")).alias("_cell")).agg(F.count("*").alias("_n")).where(F.col("_n") >= some).drop("_n")
    asked = rows.select(*on, "_at").where("_at is not null").distinct()
    finest = asked.select("*", levels).withColumn("_cell", own(F.col("_at"))).join(shared, [*on, "_level", "_cell"]).groupBy(*on, "_at").agg(F.max("_level").alias("_level"))
    asked = asked.join(finest, [*on, "_at"], "left").withColumn("_level", F.coalesce("_level", F.lit(0)))
    met = asked.withColumn("_cell", F.explode(around(F.col("_at")))).join(held.select("*", levels).withColumn("_cell", beside(F.col("_to"))), [*on, "_level", "_cell"])
    err = F.array_max(F.zip_with("_at", "_to", lambda x, y: F.abs(x - y)))
    pairs = met.select(*on, "_at", F.struct((F.round(err, digits) if digits else err).alias("err"), "_r").alias("_b")).where(F.col("_b.err") <= tolerance)
    ranked = pairs.withColumn("_n", F.row_number().over(W.partitionBy(*on, "_at").orderBy("_b"))).where(F.col("_n") <= some)
    best = ranked.groupBy(*on, "_at").agg(F.array_sort(F.collect_list("_b")).alias("_best"))
    mine = F.filter("_best", lambda b: b["_r"][but[1]] != F.col(but[0])) if but else F.col("_best")
    found = rows.join(best, [*on, "_at"], "left").withColumn("_b", F.get(mine, F.lit(0)))
    return found.select(*left.columns, F.col("_b.err").alias("err"), *[F.col(f"_b._r.{k}").alias(k) for k in keep])


def band_search(df: DataFrame, at: str, pages: DataFrame, page: str, good: Column, radius: int = 3) -> DataFrame:
    """The nearest page around a guess that passes: offsets 0, -1, +1, ...; else the guess, unverified."""
    offsets = [0, *[s * r for r in range(1, radius + 1) for s in (-1, 1)]]
    tried = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(o).alias("offset")) for i, o in enumerate(offsets)]))
    tries = df.withColumn("_try", tried).withColumn("_page", F.col(at) + F.col("_try.offset")).where("_page >= 1")
    hits = tries.join(pages, tries["_page"] == pages[page]).where(good)
    found = hits.groupBy(*df.columns).agg(F.min_by("_page", "_try.rank").alias("found"))
    return df.join(found, df.columns, "left").select(*df.columns, F.coalesce("found", F.col(at)).alias("page_used"), F.col("found").isNotNull().alias("verified"))


def secondary_candidates(targets: DataFrame, candidates: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Match leftovers (id, comp) to candidates (file, formula, sg) by element set and ratio; best by error, then
    a known space group, then file number."""
    held = candidates.withColumn("other", chem.parse_spaced(F.col("formula")))
    order = [F.when(F.col("sg").isNull() | (F.col("sg") == ""), 1).otherwise(0).alias("_no_sg"), F.col("file").cast("int").alias("_file")]
    return tolerance_match(targets, held, [], "comp", "other", tolerance, order, ["file", "sg"])


def select_candidates(rows: DataFrame, candidates: DataFrame, hints: DataFrame, remarks: DataFrame) -> DataFrame:
    """One pick per row (row_id, reduced_formula, formula, name, tag, comp, organic, nonstoichiometric) by tiers.

    candidates: reduced_formula, material_id, spacegroup, energy, theoretical, composition (map), icsd_n;
    hints: formula, tag (null for untagged), spacegroup; remarks: material_id, remarks. An empty name token or remark
    matches nothing. A tier depends on few properties: rows and candidates that agree in them are one kind, each kind of
    candidates holds its best, and kinds of rows meet kinds of candidates. Name tokens meet remarks apart from the rest.
    """
    hint = hints.select(F.col("formula").alias("_f"), F.col("tag").alias("_t"), F.col("spacegroup").alias("hinted"))
    left = rows.join(hint, (F.col("formula") == F.col("_f")) & F.col("tag").eqNullSafe(F.col("_t")), "left")
    token = F.lower(F.get(F.split(F.col("name"), r"[\s(),]"), F.lit(0)))
    kind = F.struct("reduced_formula", F.map_entries("comp").alias("comp"), "organic", "nonstoichiometric")
    left = left.select("row_id", F.col("tag").isNotNull().alias("_tagged"), F.struct(kind.alias("of"), "hinted").alias("_plain"), F.when(F.col("nonstoichiometric") & (F.length(token) > 0), F.struct(kind.alias("of"), token.alias("token"))).alias("_named"))
    energy, real = F.coalesce("energy", F.lit(float("inf"))).alias("energy"), F.coalesce(~F.col("theoretical"), F.lit(False)).alias("real")
    noted = candidates.where(F.col("material_id").isNotNull()).join(remarks.select("material_id", "remarks"), "material_id", "left")
    noted = noted.withColumns({"composition": F.map_entries("composition"), "energy": energy, "real": real, "id": F.col("material_id")})

    def met(rows: str, held: DataFrame) -> DataFrame:
        """The distinct values of a column of ``left`` with the candidates that they may take."""
        each = left.select(rows).where(F.col(rows).isNotNull()).distinct().withColumn("reduced_formula", F.col(f"{rows}.of.reduced_formula"))
        of, comp, composition = F.col(f"{rows}.of"), F.map_from_entries(F.col(f"{rows}.of.comp")), F.map_from_entries("composition")
        kept = (~of["organic"] | chem.whole_multiple(comp, composition)) & (~of["nonstoichiometric"] | chem.ratio_close(comp, composition))
        return each.join(held, "reduced_formula").where(kept)

    plain = noted.groupBy("reduced_formula", "composition", "spacegroup", "real").agg(F.count("*").alias("n"), F.min(F.struct("energy", "id")).alias("best"))
    matched = F.coalesce(F.col("spacegroup") == F.col("_plain.hinted"), F.lit(False))
    tier = F.when(matched, F.when(F.col("real"), 40).otherwise(41)).when(F.col("_plain.of.organic"), 50).when(F.col("real"), 60).otherwise(70)
    plain = met("_plain", plain).groupBy("_plain").agg(F.sum("n").alias("n"), F.min(F.struct(tier.alias("tier"), "best", "spacegroup")).alias("p"))
    says = (F.length("remark") > 0) & (F.col("remark").contains(F.col("_named.token")) | F.col("_named.token").contains(F.col("remark")))
    remarked = noted.withColumn("remark", F.explode("remarks")).withColumn("remark", F.lower("remark")).groupBy("reduced_formula", "composition", "real", "remark")
    remarked = remarked.agg(F.min(F.struct((-F.coalesce("icsd_n", F.lit(-1))).alias("first"), "energy", "id", "spacegroup")).alias("best"))
    noticed = met("_named", remarked).where(says).groupBy("_named").agg(F.min(F.struct(F.when(F.col("real"), 20).otherwise(21).alias("tier"), "best")).alias("q"))

    both = left.join(plain, "_plain", "left").join(noticed, "_named", "left")
    picked = both.groupBy("row_id").agg(F.sum("n").alias("_n"), F.min("p").alias("p"), F.min("q").alias("q"), F.first("_tagged").alias("_tagged"))
    by_name = lambda x, y: F.when(F.col("q").isNotNull(), F.col(f"q.{x}")).otherwise(y)
    best = F.struct(by_name("tier", F.when(F.col("_n") == 1, 30).otherwise(F.col("p.tier"))).alias("_tier"), by_name("best.id", F.col("p.best.id")).alias("material_id"), by_name("best.spacegroup", F.col("p.spacegroup")).alias("spacegroup"))
    picked = picked.select("row_id", "_tagged", best.alias("_b"))
    suffix = F.when(F.col("_tagged"), "_polymorph_unresolved").otherwise("")
    tier = F.col("_b._tier")
    method = (
        F.when(tier.isNull(), "no_mp_match")
        .when(tier < 30, "nonstoichiometric_remarks_match")
        .when(tier == 30, "single_candidate")
        .when(tier < 50, F.when(F.col("_tagged"), "spacegroup_hint").otherwise("name_spacegroup_hint"))
        .when(tier == 50, "organic_ambiguous_isomers")
        .when(tier == 60, F.concat(F.lit("most_stable_experimental"), suffix))
        .otherwise(F.concat(F.lit("most_stable_guess"), suffix))
    )
    sure = method.isin("nonstoichiometric_remarks_match", "spacegroup_hint", "name_spacegroup_hint")
    chosen = tier.isNotNull() & (tier != 50)
    return picked.select(
        "row_id", F.when(chosen, F.col("_b.material_id")).alias("material_id"), F.when(chosen, F.col("_b.spacegroup")).alias("spacegroup"), method.alias("match_method"), F.when(chosen, sure).alias("phase_name_verified")
    )
