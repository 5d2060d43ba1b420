"""Named queries over the standard tables, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.functions import chem
from tabularium.functions import text as X
from tabularium.operators import extraction, match, outcomes, pages, series, toc
from tabularium.sources import cif, io, landed, named, store
from tabularium.sources.io import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT p_partkey, upper(trim(p_name)) AS name, p_brand AS brand, CAST(NULL AS VARCHAR) AS note FROM part")
def scan_project_trim(spark, d):
    df = outcomes.trim_header(table(spark, d, "part").withColumnsRenamed({"p_brand": " brand ", "p_name": "name "}))
    return outcomes.reindex(df.withColumn("name", F.upper(F.trim("name"))), {"p_partkey": "long", "name": "string", "brand": "string", "note": "string"})


@query("SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO' OR contains(upper(p_name), 'GEAR')")
def filter_gas_like(spark, d):
    return table(spark, d, "part").where((F.col("p_type") == "PROMO") | F.upper("p_name").contains("GEAR")).select("p_partkey", "p_name", "p_type")


@query("""SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND NOT coalesce(nullif(o_orderpriority, '5-LOW') = '1-URGENT', false)""")
def filter_in_and_nulls(spark, d):
    df = table(spark, d, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return df.where(F.col("o_orderstatus").isin("F", "P") & ~F.coalesce(F.col("priority") == "1-URGENT", F.lit(False))).select("o_orderkey", "o_orderstatus", "priority")


@query("""SELECT p.p_partkey, p.p_name, f.first_key, f.first_brand FROM part p
JOIN (SELECT p_name, min(p_partkey) AS first_key, arg_min(p_brand, p_partkey) AS first_brand FROM part GROUP BY p_name) f USING (p_name)""")
def first_match_join(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    first = match.first_per_key(part, "p_name", "p_partkey").withColumnsRenamed({"p_partkey": "first_key", "p_brand": "first_brand"})
    return part.join(first, "p_name").select("p_partkey", "p_name", "first_key", "first_brand")


@query("""WITH n AS (SELECT p_name, min(p_partkey) AS first FROM part GROUP BY p_name), t AS (SELECT DISTINCT reverse(substr(p_name, 3)) AS bad FROM part),
b AS (SELECT bad, min((levenshtein(bad, p_name), first, p_name)) AS m FROM t, n GROUP BY bad)
SELECT p_partkey, bad, m[3] AS nearest, CAST(m[1] AS INTEGER) AS distance FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN reverse(substr(p_name, 3)) END AS bad FROM part) LEFT JOIN b USING (bad)""")
def nearest_string_join(spark, d):
    """Misread names (null for every ninth) and the name of least edits, the first in order of key on ties."""
    part = table(spark, d, "part")
    read = part.select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.reverse(F.expr("substring(p_name, 3)"))).alias("bad"))
    return match.nearest_string(read, "bad", part, "p_name", "p_partkey").select("p_partkey", "bad", "nearest", "distance")


@query("""SELECT p_partkey, p_name, CAST(coalesce(list_filter(flatten(list_transform(range(greatest(4 - 1, 1), 4 + 2), lambda n: list_transform(
range(0, greatest(length(p_name) - n + 1, 0)), lambda s: {'n': n, 's': s}))), lambda x: levenshtein(substr(p_name, CAST(x.s + 1 AS BIGINT), CAST(x.n AS BIGINT)), 'bold') <= 1)[1].s, -1) AS INTEGER) AS at FROM part""")
def fuzzy_find_window(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", X.fuzzy_find(F.lit("bold"), F.col("p_name"), 1).cast("int").alias("at"))


@query("""SELECT o_orderkey, arg_min(l_linenumber, (l_extendedprice, l_linenumber)) AS line, min(l_extendedprice) AS price
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def key_equi_join_top1(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_extendedprice", "l_linenumber")).alias("m"))
    orders = table(spark, d, "orders").select("o_orderkey")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.min("m").alias("m")).select("o_orderkey", F.col("m.l_linenumber").alias("line"), F.col("m.l_extendedprice").alias("price"))


@query("""SELECT c_nationkey, c_custkey, n_orders, c_acctbal FROM (SELECT c_nationkey, c_custkey, n_orders, c_acctbal,
row_number() OVER (PARTITION BY c_nationkey ORDER BY n_orders DESC, c_acctbal ASC NULLS LAST, c_custkey) AS rn
FROM customer JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey) WHERE rn = 1""")
def top1_mixed_direction(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    rows = table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"))
    key = F.struct((-F.col("n_orders")).alias("a"), F.coalesce("c_acctbal", F.lit(float("inf"))).alias("b"), F.col("c_custkey").alias("c"))
    return rows.groupBy("c_nationkey").agg(F.min_by(F.struct("c_custkey", "n_orders", "c_acctbal"), key).alias("t")).select("c_nationkey", "t.*")


@query("""SELECT n_nationkey, arg_min(s_suppkey, (abs(s_acctbal - 5000), CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END, s_suppkey)) AS s_suppkey,
round(min(abs(s_acctbal - 5000)), 4) AS err FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_nationkey""")
def tuple_top1(spark, d):
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.struct(F.abs(F.col("s_acctbal") - 5000).alias("err"), F.when(F.col("s_suppkey") % 2 == 0, 0).otherwise(1).alias("flag"), "s_suppkey")
    return rows.groupBy("n_nationkey").agg(F.min(key).alias("m")).select("n_nationkey", "m.s_suppkey", F.round("m.err", 4).alias("err"))


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def dict_lookup_join(spark, d):
    return table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")


@query("""WITH k AS (SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag || l_linestatus)), '-') AS elements FROM lineitem GROUP BY l_orderkey),
n AS (SELECT elements, count(*) AS alike, min(l_orderkey) AS first_order FROM k GROUP BY elements) SELECT l_orderkey, elements, alike, first_order FROM k JOIN n USING (elements)""")
def set_key_join(spark, d):
    keys = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), "-").alias("elements"))
    sets = keys.groupBy("elements").agg(F.count("*").alias("alike"), F.min("l_orderkey").alias("first_order"))
    return keys.join(sets, "elements").select("l_orderkey", "elements", "alike", "first_order")


_SHARES = """SELECT l_suppkey, sum(l_quantity) FILTER (l_returnflag = 'A') / sum(l_quantity) AS a, sum(l_quantity) FILTER (l_returnflag = 'N') / sum(l_quantity) AS n,
sum(l_quantity) FILTER (l_returnflag = 'R') / sum(l_quantity) AS r FROM lineitem GROUP BY l_suppkey"""


@query(f"""WITH v AS ({_SHARES}), p AS (SELECT x.l_suppkey AS id, y.l_suppkey AS other, round(greatest(abs(x.a - y.a), abs(x.n - y.n), abs(x.r - y.r)), 9) AS err
FROM v x JOIN v y ON x.l_suppkey <> y.l_suppkey), b AS (SELECT id, min((err, other)) AS m FROM p WHERE err <= 0.02 GROUP BY id)
SELECT v.l_suppkey AS id, coalesce(m[2], -1) AS other, m[1] AS err FROM v LEFT JOIN b ON v.l_suppkey = b.id""")
def ratio_tolerance_join(spark, d):
    """Each supplier and the one, of all others, whose shares are nearest; a share that either lacks is not compared."""
    quantity = lambda x: F.sum(F.when(F.col("l_returnflag") == x, F.col("l_quantity")))
    sums = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("all"), *[quantity(x).alias(x) for x in "ANR"])
    held = F.filter(F.array(*[F.when(F.col(x).isNotNull(), x) for x in "ANR"]), lambda x: x.isNotNull())
    shares = F.create_map(*[y for x in "ANR" for y in (F.lit(x), F.try_divide(x, "all"))])
    rows = store.stored(sums.select(F.col("l_suppkey").alias("id"), held.alias("held"), shares.alias("shares")), "compositions")
    # Rows of one set of flags meet rows of another by the flags of both: there are at most eight sets.
    sets = F.broadcast(rows.select(F.col("held").alias("met")).distinct())
    both = F.array_sort(F.array_intersect("held", "met"))
    each = rows.join(sets, F.arrays_overlap("held", "met")).select("id", "held", "met", F.transform(both, lambda x: F.element_at("shares", x)).alias("at"))
    right = each.where("id is not null").select(F.col("met").alias("held"), F.col("held").alias("met"), F.col("id").alias("other"), F.col("at").alias("to"))
    best = match.nearest_shares(each, right, ["held", "met"], "at", "to", 0.02, [], ["other"], digits=9, but=("id", "other"))
    best = best.where("other is not null").groupBy("id").agg(F.min(F.struct("err", "other")).alias("m"))
    return rows.join(best, "id", "left").select("id", F.coalesce("m.other", F.lit(-1).cast("long")).alias("other"), "m.err")


@query("""SELECT k.o_orderkey, CAST(coalesce(arg_min(g.o_orderkey, CASE WHEN g.o_orderkey <= k.o_orderkey THEN 2 * (k.o_orderkey - g.o_orderkey) - CASE WHEN g.o_orderkey = k.o_orderkey THEN 0 ELSE 1 END
ELSE 2 * (g.o_orderkey - k.o_orderkey) END), k.o_orderkey) AS BIGINT) AS page_used, count(g.o_orderkey) > 0 AS verified FROM orders k
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000) g ON g.o_orderkey BETWEEN k.o_orderkey - 3 AND k.o_orderkey + 3 AND g.o_orderkey >= 1 GROUP BY k.o_orderkey""")
def band_search(spark, d):
    orders = table(spark, d, "orders")
    held = orders.select(F.col("o_orderkey").alias("page"), "o_orderstatus", "o_totalprice")
    return match.band_search(orders.select("o_orderkey"), "o_orderkey", held, "page", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000))


@query("""WITH w AS (SELECT w, min(item_id) AS first FROM (SELECT item_id, unnest(string_split(translate(lower(text), 'äöüéèêçàñóíáúß', 'aoueeecanoiaus'), ' ')) AS w FROM benchmark) WHERE length(w) >= 6 GROUP BY w),
t AS (SELECT w, CASE WHEN first % 3 = 0 THEN replace(w, 'i', 'l') WHEN first % 3 = 1 THEN replace(substr(w, 2), 'm', 'rn') ELSE replace(w, 'e', 'c') || '.' END AS bad FROM w), n AS (SELECT * FROM w WHERE first % 2 = 0),
b AS (SELECT bad, min((levenshtein(bad, n.w), first, n.w)) AS m FROM (SELECT DISTINCT bad FROM t), n GROUP BY bad) SELECT w, m[3] AS nearest, CAST(m[1] AS INTEGER) AS distance FROM t JOIN b USING (bad)""")
def nearest_misread_word(spark, d):
    """Words misread in some of their letters, and the nearest among the words of every second passage."""
    each = table(spark, d, "benchmark").select("item_id", F.explode(F.split(F.translate(F.lower("text"), "äöüéèêçàñóíáúß", "aoueeecanoiaus"), " ")).alias("w")).where(F.length("w") >= 6)
    words = each.groupBy("w").agg(F.min("item_id").alias("first"))
    kind, w = F.col("first") % 3, F.col("w")
    bad = F.when(kind == 0, F.translate(w, "i", "l")).when(kind == 1, F.replace(F.substr(w, F.lit(2)), F.lit("m"), F.lit("rn"))).otherwise(F.concat(F.translate(w, "e", "c"), F.lit(".")))
    known = words.where("first % 2 = 0").select(w.alias("word"), "first")
    return match.nearest_string(words.select("w", bad.alias("bad")), "bad", known, "word", "first").select("w", "nearest", "distance")


_NEEDLES = "SELECT item_id, lower(array_to_string(string_split(text, ' ')[1:CASE WHEN item_id % 4 = 3 THEN 6 ELSE 1 + item_id % 4 END], ' ')) AS needle FROM benchmark"


@query(f"""SELECT item_id, count(*) AS documents, min(doc_id) AS first_doc FROM (SELECT item_id, needle FROM ({_NEEDLES}) WHERE needle <> '') JOIN documents ON contains(lower(text), needle) GROUP BY item_id""")
def substring_join(spark, d):
    """Needles of one, two, three and six words, found anywhere in documents, also inside words."""
    words, kind = F.split("text", " "), F.col("item_id") % 4
    needles = table(spark, d, "benchmark").select("item_id", F.lower(F.array_join(F.slice(words, F.lit(1), F.when(kind == 3, 6).otherwise(1 + kind).cast("int")), " ")).alias("needle")).where("needle <> ''")
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("body"))
    found = match.substring_pairs(needles, "item_id", "needle", docs, "doc_id", "body")
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))


@query("""WITH t AS (SELECT p_partkey, p_brand, string_split(p_name, ' ')[1] AS token FROM part), w AS (SELECT p_brand, list(DISTINCT string_split(p_name, ' ')[2]) AS notes FROM part GROUP BY p_brand)
SELECT p_partkey, len(list_filter(notes, lambda n: contains(n, token) OR contains(token, n))) > 0 AS noticed FROM t JOIN w USING (p_brand)""")
def either_contains_join(spark, d):
    part = table(spark, d, "part").withColumn("w", F.split("p_name", " "))
    notes = part.groupBy("p_brand").agg(F.collect_set(F.get("w", F.lit(1))).alias("notes"))
    token = F.get("w", F.lit(0))
    says = F.exists("notes", lambda n: n.contains(token) | token.contains(n))
    return part.join(notes, "p_brand").select("p_partkey", F.coalesce(says, F.lit(False)).alias("noticed"))


@query("""SELECT p_partkey, CASE WHEN p_name LIKE 'small%' OR p_name LIKE '% small%' THEN 'S' WHEN p_name LIKE 'red%' OR p_name LIKE '% red%' THEN 'R' END AS named,
CASE WHEN string_split(p_name, ' ')[-1] LIKE '%ing' THEN 'ing' WHEN string_split(p_name, ' ')[-1] LIKE '%g' THEN 'g' WHEN string_split(p_name, ' ')[-1] LIKE '%t' THEN 't' END AS ending FROM part""")
def prefix_suffix_dict(spark, d):
    words = F.split("p_name", " ")
    starts = F.array(F.struct(F.lit("small").alias("k"), F.lit("S").alias("v")), F.struct(F.lit("red").alias("k"), F.lit("R").alias("v")))
    ends = F.array(F.lit("ing"), F.lit("g"), F.lit("t"))
    named = F.get(F.filter(starts, lambda s: F.exists(words, lambda w: w.startswith(s["k"]))), F.lit(0))["v"]
    return table(spark, d, "part").select("p_partkey", named.alias("named"), F.get(F.filter(ends, lambda e: F.element_at(words, -1).endswith(e)), F.lit(0)).alias("ending"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def semi_filter(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_resume(spark, d):
    """Customers without an urgent order: each has many orders of other kinds."""
    done = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return outcomes.unfinished(table(spark, d, "customer").select("c_custkey", "c_name"), done, "c_custkey")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY n DESC, event_type")
def value_counts_desc(spark, d):
    return outcomes.value_counts(table(spark, d, "events"), "event_type")


@query("""SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_discount > 0.05) AS discounted, count(DISTINCT l_partkey) AS parts, min(l_quantity) AS least, max(l_quantity) AS most, round(avg(l_quantity), 6) AS mean
FROM lineitem GROUP BY l_returnflag""")
def conditional_counts(spark, d):
    aggs = (F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.countDistinct("l_partkey").alias("parts"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"), F.round(F.avg("l_quantity"), 6).alias("mean"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*aggs)


@query("SELECT conv_id, count(*) AS turns, md5(string_agg(role || ':' || text, ' ' ORDER BY turn, role, text)) AS digest FROM conversations GROUP BY conv_id")
def ordered_list_agg(spark, d):
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    said = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), " ")
    return rows.select("conv_id", F.size("t").cast("long").alias("turns"), F.md5(said.cast("binary")).alias("digest"))


@query("""SELECT conv_id, turn, md5(coalesce(string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '')) AS context FROM conversations""")
def lookback_context(spark, d):
    before = W.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(-3, -1)
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(F.array_join(F.collect_list("text").over(before), " ").cast("binary")).alias("context"))


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents"


@query(f"""WITH l AS ({_LINES}), t AS (SELECT doc_id, line_no, CASE WHEN contains(line, 'Licensed') THEN 1 WHEN contains(line, ' token ') THEN 2 END AS tier FROM l)
SELECT doc_id, CAST(min((tier, line_no))[1] AS INTEGER) AS tier, CAST(min((tier, line_no))[2] AS INTEGER) AS line_no FROM t WHERE tier IS NOT NULL GROUP BY doc_id""")
def header_first_tier(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    tier = F.when(F.col("line").contains("Licensed"), 1).when(F.col("line").contains(" token "), 2)
    return lines.withColumn("tier", tier).where("tier is not null").groupBy("doc_id").agg(F.min(F.struct("tier", "line_no")).alias("m")).select("doc_id", "m.tier", "m.line_no")


@query("""WITH e AS (SELECT *, event_type = 'signup' AS base, lag(event_type) OVER w = 'view' AS near FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT *, min(CASE WHEN base AND near THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS first, min(CASE WHEN event_type = 'error' AND value > 480 THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS fin FROM e),
s AS (SELECT *, sum(CASE WHEN base AND (ts, event_id) >= first THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM f WHERE first IS NOT NULL AND (fin IS NULL OR (ts, event_id) < fin)),
k AS (SELECT *, max(run) OVER (PARTITION BY user_id) AS top FROM s) SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS n, min(event_id) AS opened FROM k WHERE run > 0 AND (fin IS NOT NULL OR run < top) GROUP BY user_id, run""")
def segment_runs(spark, d):
    w, whole = W.partitionBy("user_id").orderBy("ts", "event_id"), W.partitionBy("user_id")
    at = F.struct("ts", "event_id")
    e = table(spark, d, "events").withColumns({"at": at, "base": F.col("event_type") == "signup", "near": F.lag("event_type").over(w) == "view"})
    e = e.withColumns({"first": F.min(F.when(F.col("base") & F.col("near"), F.col("at"))).over(whole), "fin": F.min(F.when((F.col("event_type") == "error") & (F.col("value") > 480), F.col("at"))).over(whole)})
    e = e.where("first is not null and (fin is null or at < fin)")
    e = e.withColumn("run", F.sum(F.when(F.col("base") & (F.col("at") >= F.col("first")), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    e = e.withColumn("top", F.max("run").over(whole)).where("run > 0 and (fin is not null or run < top)")
    return e.groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("opened"))


_FOLD = """SELECT user_id, list_reduce(list({'i': event_id, 'k': hour(ts) * 1.0, 'v': value, 'n': 0, 't': NULL::DOUBLE, 'g': NULL::DOUBLE} ORDER BY ts, event_id), lambda a, x: CASE WHEN a.n = 0 OR NOT (x.k < a.t - 0.01 OR x.v > a.g + 100.0)
THEN {'i': x.i, 'k': x.k, 'v': x.v, 'n': a.n + 1, 't': x.k, 'g': x.v} ELSE a END, {'i': -1, 'k': 0.0, 'v': 0.0, 'n': 0, 't': NULL::DOUBLE, 'g': NULL::DOUBLE}) AS r FROM events GROUP BY user_id"""


def _gated(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), "event_id", F.hour("ts").cast("double").alias("t"), F.lit(1.0).alias("s"), F.col("value").alias("g"))
    return series.monotone_gate(e, "user_id", "at", "t", "s", "g", g_slack=100.0)


@query(f"SELECT user_id, CAST(r.n AS BIGINT) AS accepted, r.i AS last_event FROM ({_FOLD})")
def monotone_gate(spark, d):
    rows = _gated(spark, d).where("accepted")
    return rows.groupBy("user_id").agg(F.count("*").alias("accepted"), F.max_by("event_id", "at").alias("last_event"))


_SERIES = "SELECT user_id, event_id, ts, event_id * 0.5 + 300.0 AS t, value AS cp, value / 10 - CASE WHEN event_id % 97 = 0 THEN 49 ELSE 0 END AS s, event_id * 0.05 + value / 100 AS h FROM events"


def _series(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    s = F.col("value") / 10 - F.when(e % 97 == 0, 49).otherwise(0)
    return table(spark, d, "events").select("user_id", "event_id", "ts", (e * 0.5 + 300.0).alias("t"), F.col("value").alias("cp"), s.alias("s"), (e * 0.05 + F.col("value") / 100).alias("h"))


def _slopes(base: str, tag: str = "") -> str:
    """Named parts of a WITH that end in f: the series' rows with slopes (x from h, y from s), inside, fin and flip."""
    return f"""b{tag} AS ({base}), l{tag} AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, lag(t) OVER w AS t1, lag(t, 2) OVER w AS t2, lead(t) OVER w AS t3, lag(cp) OVER w AS c1, lag(cp, 2) OVER w AS c2,
lag(s) OVER w AS s1, lag(s, 2) OVER w AS s2, lead(s) OVER w AS s3, lag(h) OVER w AS h1, lag(h, 2) OVER w AS h2, lead(h) OVER w AS h3, count(*) FILTER (s > 0) OVER (PARTITION BY user_id) AS pos FROM b{tag} WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
raw{tag} AS (SELECT *, CASE WHEN t > t1 THEN 1000.0 * (h - h1) / (t - t1) END AS ha, CASE WHEN t3 > t THEN 1000.0 * (h3 - h) / (t3 - t) END AS hb, CASE WHEN t > t2 THEN 1000.0 * (h - h2) / (t - t2) END AS hc,
CASE WHEN t > t1 THEN (s - s1) / (ln(t) - ln(t1)) END AS sa, CASE WHEN t3 > t THEN (s3 - s) / (ln(t3) - ln(t)) END AS sb, CASE WHEN t > t2 THEN (s - s2) / (ln(t) - ln(t2)) END AS sc FROM l{tag}),
e{tag} AS (SELECT *, CASE WHEN ha BETWEEN -20 AND 900 THEN ha END AS xa, CASE WHEN hb BETWEEN -20 AND 900 THEN hb END AS xb, CASE WHEN hc BETWEEN -20 AND 900 THEN hc END AS xc,
CASE WHEN sa BETWEEN -20 AND 900 THEN sa END AS ya, CASE WHEN sb BETWEEN -20 AND 900 THEN sb END AS yb, CASE WHEN sc BETWEEN -20 AND 900 THEN sc END AS yc FROM raw{tag}),
f{tag} AS (SELECT *, coalesce(i > 0 AND i < n - 1 AND xa IS NOT NULL AND xb IS NOT NULL AND ya IS NOT NULL AND yb IS NOT NULL AND NOT (cp BETWEEN least(xa, xb) - 5 AND greatest(xa, xb) + 5) AND NOT (cp BETWEEN least(ya, yb) - 5 AND greatest(ya, yb) + 5), false) AS inside,
coalesce(i = n - 1 AND n > 2 AND xa IS NOT NULL AND xc IS NOT NULL AND ya IS NOT NULL AND yc IS NOT NULL AND NOT (cp BETWEEN least(xa, xc) - 5 AND greatest(xa, xc) + 5) AND NOT (cp BETWEEN least(ya, yc) - 5 AND greatest(ya, yc) + 5)
AND (i < 2 OR t1 <= t2 OR t <= t1 OR abs((cp - c1) / (t - t1) - (c1 - c2) / (t1 - t2)) > greatest(0.02, 0.4 * abs((c1 - c2) / (t1 - t2)))), false) AS fin,
coalesce(s < 0 AND pos >= n - 1 AND pos > 0 AND (i < 2 OR abs(-s - (s1 + (s1 - s2) / (t1 - t2) * (t - t1))) < abs(s - (s1 + (s1 - s2) / (t1 - t2) * (t - t1)))), false) AS flip FROM e{tag})"""


_SLOPES = f"WITH {_slopes(_SERIES)}"


_WALK = """walk AS (SELECT user_id, rn, k AS t, v AS g, true AS ok FROM o WHERE rn = 1 UNION ALL SELECT o.user_id, o.rn, CASE WHEN NOT (k < t - 0.01 OR v > g + 100.0) THEN k ELSE t END, CASE WHEN NOT (k < t - 0.01 OR v > g + 100.0) THEN v ELSE g END,
NOT (k < t - 0.01 OR v > g + 100.0) FROM walk JOIN o ON o.user_id = walk.user_id AND o.rn = walk.rn + 1)"""
_ACCEPTED = "SELECT user_id, rn AS event_id, t + 273.15 AS t, g / 10 AS cp, 1.0 AS s, g AS h FROM walk WHERE ok"


@query(f"""WITH RECURSIVE o AS (SELECT user_id, CAST(hour(ts) AS DOUBLE) AS k, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE value IS NOT NULL), {_WALK}, {_slopes(_ACCEPTED)}
SELECT user_id, count(*) AS n, count(*) FILTER (inside OR fin) AS cp_wrong, count(*) FILTER (flip) AS s_sign_wrong FROM f GROUP BY user_id""")
def series_quality(spark, d):
    """Flagship: each user's series gated, its slopes checked, and the flags counted."""
    rows = _gated(spark, d).where("accepted").select("user_id", "at", (F.col("t") + 273.15).alias("t"), (F.col("g") / 10).alias("cp"), "s", F.col("g").alias("h"))
    flags = series.consistency_flags(rows, ["user_id"], "at", F.lit(True))
    return flags.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("cp_wrong").alias("cp_wrong"), F.count_if("s_sign_wrong").alias("s_sign_wrong")).orderBy("user_id")


@query(f"{_SLOPES} SELECT event_id, round(xa * 0.2390057, 4) AS from_h, round(ya * 0.2390057, 4) AS from_s FROM f")
def secant_slopes(spark, d):
    rows, one = _series(spark, d), series.Series(["user_id"], "event_id")
    h, s = one.slopes(-1, 0)
    return rows.select("event_id", F.round(h * 0.2390057, 4).alias("from_h"), F.round(s * 0.2390057, 4).alias("from_s"))


@query(f"{_SLOPES} SELECT event_id, inside OR fin AS cp_wrong, flip AS s_sign_wrong FROM f")
def consistency_flags(spark, d):
    return series.consistency_flags(_series(spark, d), ["user_id"], "event_id", F.lit(True)).select("event_id", "cp_wrong", "s_sign_wrong")


def _snapped(old: str, estimate: str) -> str:
    """The single-digit change of a printed number that comes nearest to an estimate, within 0.1."""
    changed = f"CAST(substr(printf('%.3f', {old}), 1, CAST(i - 1 AS BIGINT)) || d || substr(printf('%.3f', {old}), CAST(i + 1 AS BIGINT)) AS DOUBLE)"
    return f"""round(list_min(list_filter(flatten(list_transform(list_filter(range(1, 16), lambda i: regexp_matches(substr(printf('%.3f', {old}), CAST(i AS BIGINT), 1), '[0-9]')), lambda i: list_transform(
list_filter(range(0, 10), lambda d: CAST(d AS VARCHAR) <> substr(printf('%.3f', {old}), CAST(i AS BIGINT), 1)), lambda d: {{'off': round(abs({changed} - ({estimate})), 9), 'i': i, 'd': d, 'v': {changed}}}))), lambda c: c.off < 0.1)).v, 3)"""


_FLIPPED = "SELECT user_id, event_id, ts, t, cp, CASE WHEN flip THEN -s ELSE s END AS s, h, s AS s_read FROM f"
_INNER = "inside AND abs((xa + xb) / 2 - (ya + yb) / 2) <= 5"
_END = """i = n - 1 AND n > 2 AND xa IS NOT NULL AND xc IS NOT NULL AND ya IS NOT NULL AND yc IS NOT NULL AND NOT (cp BETWEEN least(xa, xc) - 5 AND greatest(xa, xc) + 5) AND NOT (cp BETWEEN least(ya, yc) - 5 AND greatest(ya, yc) + 5)
AND (t1 <= t2 OR t <= t1 OR abs((cp1 - q1) / (t - t1) - (q1 - q2) / (t1 - t2)) > greatest(0.02, 0.4 * abs((q1 - q2) / (t1 - t2)))) AND abs((xa + xc) / 2 - (ya + yc) / 2) <= 5"""
_WIDE = "(2 * {} * (t - t2) - (t1 - t2) * q2 - (t - t2) * q1) / (t - t1)"


@query(f"""{_SLOPES}, {_slopes(_FLIPPED, "2")}, p AS (SELECT *, CASE WHEN {_INNER} THEN coalesce({_snapped("cp", "(xa + xb) / 4 + (ya + yb) / 4")}, round((xa + xb) / 4 + (ya + yb) / 4, 3)) ELSE cp END AS cp1 FROM f2),
q AS (SELECT *, lag(cp1) OVER w AS q1, lag(cp1, 2) OVER w AS q2 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
z AS (SELECT *, (2 * xa - q1 + {_WIDE.format("xc")}) / 4 + (2 * ya - q1 + {_WIDE.format("yc")}) / 4 AS ending FROM q), o AS (SELECT *, CASE WHEN coalesce({_END}, false) THEN coalesce({_snapped("cp1", "ending")}, cp1) ELSE cp1 END AS cp_fixed FROM z)
SELECT event_id, round(cp_fixed, 3) AS cp_fixed, round(s, 6) AS s_fixed, concat_ws(',', CASE WHEN cp_fixed <> cp THEN 'Cp' END, CASE WHEN s <> s_read THEN 'S_sign' END) AS reasons FROM o""")
def two_pass_correction(spark, d):
    rows = series.corrections(_series(spark, d), ["user_id"], "event_id", F.lit(True))
    return rows.select("event_id", F.round("cp_fixed", 3).alias("cp_fixed"), F.round("s_fixed", 6).alias("s_fixed"), "reasons")


@query("""WITH v AS (SELECT o_orderkey, printf('%.3f', o_totalprice) AS p, o_totalprice + (o_orderkey % 9) * 100.0 + 0.04 AS est FROM orders),
c AS (SELECT o_orderkey, est, i, d, CAST(substr(p, 1, CAST(i - 1 AS BIGINT)) || d || substr(p, CAST(i + 1 AS BIGINT)) AS DOUBLE) AS x FROM v, range(1, 16) r(i), range(0, 10) s(d) WHERE i <= length(p) AND regexp_matches(substr(p, CAST(i AS BIGINT), 1), '[0-9]') AND substr(p, CAST(i AS BIGINT), 1) <> CAST(d AS VARCHAR)),
b AS (SELECT o_orderkey, arg_min(x, (abs(x - est), i, d)) AS x FROM c WHERE abs(x - est) < 0.1 GROUP BY o_orderkey) SELECT v.o_orderkey, round(x, 3) AS snapped FROM v LEFT JOIN b USING (o_orderkey)""")
def digit_snap(spark, d):
    est = F.col("o_totalprice") + (F.col("o_orderkey") % 9) * 100.0 + 0.04
    return table(spark, d, "orders").select("o_orderkey", F.round(X.snap_digit(F.col("o_totalprice"), est, fallback=False), 3).alias("snapped"))


@query("""WITH RECURSIVE pick AS (SELECT n, size, CAST([] AS BIGINT[]) AS c FROM (VALUES (9, 9), (12, 10), (12, 9), (15, 10), (15, 9)) v(n, size)
UNION ALL SELECT n, size, list_append(c, i) FROM pick, range(15) r(i) WHERE len(c) < size AND i > coalesce(c[-1], -1) AND n - i >= size - len(c)),
ranked AS (SELECT n, c, row_number() OVER (PARTITION BY n ORDER BY size DESC, c) AS rank FROM pick WHERE len(c) = size),
tests AS (SELECT n, c[1] + 1 AS a, c[3] + 1 AS b, c[5] + 1 AS e, c[7] + 1 AS g, min(rank) AS rank FROM ranked GROUP BY ALL),
rows AS (SELECT l_orderkey, flatten(list([l_quantity, l_discount * 10, l_quantity / 7] ORDER BY l_linenumber, l_quantity, l_discount)) AS x FROM lineitem GROUP BY l_orderkey),
best AS (SELECT l_orderkey, min(t.rank) AS rank FROM rows r JOIN tests t ON len(x) = t.n AND abs(x[e] - abs(x[a]) * x[b] / 1000.0 - x[g]) <= 2.0 GROUP BY l_orderkey),
fits AS (SELECT r.l_orderkey, x, list_transform(c, lambda i: x[i + 1]) AS fit, CASE WHEN len(x) >= 9 AND abs(x[5] - abs(x[1]) * x[3] / 1000.0 - x[7]) <= 50.0 THEN x[1:10] END AS front
FROM rows r LEFT JOIN best b ON r.l_orderkey = b.l_orderkey LEFT JOIN ranked k ON k.n = len(x) AND k.rank = b.rank)
SELECT l_orderkey, CAST(len(x) AS INTEGER) AS n, fit IS NULL AND front IS NOT NULL AS used_fallback, md5(array_to_string(list_transform(coalesce(fit, front), lambda v: printf('%.4f', v)), ' ') || CASE WHEN len(coalesce(fit, front)) = 9 THEN ' 0.0000' ELSE '' END) AS fit FROM fits""")
def column_sieve(spark, d):
    """Orders of three numbers a line, put through the column recovery: over 15 numbers there is only the fallback."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_discount"))).alias("x"))
    flat = F.flatten(F.transform("x", lambda x: F.array(x["l_quantity"], x["l_discount"] * 10, x["l_quantity"] / 7)))
    rows = pages.recover_columns(lines.select("l_orderkey", flat.alias("numbers")))
    told = F.array_join(F.transform("fit", lambda v: F.format_string("%.4f", v)), " ")
    return rows.select("l_orderkey", F.size("numbers").alias("n"), "used_fallback", F.md5(told.cast("binary")).alias("fit"))


@query("SELECT o_orderkey, o_orderkey + CASE WHEN o_orderkey <= 924 THEN 114 WHEN o_orderkey <= 1200 THEN 115 ELSE 116 END AS page FROM orders")
def piecewise_offset(spark, d):
    return table(spark, d, "orders").select("o_orderkey", pages.page_offset(F.col("o_orderkey")).alias("page"))


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(\.)[ \t\n\f\r\v]+([0-9])', '\1\2', 'g'), '([-—~])[ \t\n\f\r\v]+([0-9])', '\1\2', 'g'), '([0-9])([-—~])', '\1 \2', 'g') AS x FROM documents)
SELECT doc_id, length(x) AS n, CAST(len(regexp_extract_all(x, '-?[0-9]+\.[0-9]+')) AS INTEGER) AS numbers, nullif(regexp_extract(x, '-?[0-9]+\.[0-9]+'), '') AS first_number FROM t""")
def text_repair_chain(spark, d):
    docs = table(spark, d, "documents").select("doc_id", X.page_repair(F.col("text")).alias("x"))
    found = F.regexp_extract_all("x", F.lit(X.NUMBER), F.lit(0))
    return docs.select("doc_id", F.length("x").cast("long").alias("n"), F.size(found).alias("numbers"), F.get(found, F.lit(0)).alias("first_number"))


_TOKEN = "CAST(o_orderkey * 37 AS VARCHAR)"


@query(f"""SELECT o_orderkey, CASE WHEN regexp_full_match({_TOKEN}, '[0-9]{{4,7}}') THEN left({_TOKEN}, -2) || '.' || right({_TOKEN}, 2) ELSE {_TOKEN} END AS first_token,
CASE WHEN regexp_full_match({_TOKEN}, '[0-9]{{4,7}}') THEN left({_TOKEN}, -3) || '.' || right({_TOKEN}, 3) ELSE {_TOKEN} END AS later_token FROM orders""")
def missing_decimal(spark, d):
    token = (F.col("o_orderkey") * 37).cast("string")
    return table(spark, d, "orders").select("o_orderkey", X.missing_decimal(token, F.lit(True)).alias("first_token"), X.missing_decimal(token, F.lit(False)).alias("later_token"))


@query(r"""SELECT page_id, translate(regexp_replace(regexp_replace(upper(regexp_replace(url, '[^A-Za-z0-9\[\]]', '', 'g')), '\[+', '[', 'g'), '\]+', ']', 'g'), 'OL', '0I') AS match_key,
regexp_replace(url, '[^A-Za-z0-9_.()\[\]*-]', '_', 'g') AS stem FROM pages""")
def normalise_key(spark, d):
    return table(spark, d, "pages").select("page_id", X.match_key(F.col("url")).alias("match_key"), X.file_stem(F.col("url")).alias("stem"))


@query(r"""WITH f AS (SELECT p_partkey, p_brand || CASE p_partkey % 4 WHEN 0 THEN '[A]' WHEN 1 THEN '[A][b]' WHEN 2 THEN '[]' ELSE '' END AS f FROM part)
SELECT p_partkey, regexp_replace(f, '\[[^\]]*\]$', '') AS bare, CASE WHEN regexp_matches(f, '\[[^\]]*\]$') THEN regexp_extract(f, '\[([^\]]*)\]$', 1) END AS tag, regexp_replace(f, '(\[[^\]]*\])+$', '') AS untagged FROM f""")
def strip_tags(spark, d):
    tag = F.when(F.col("p_partkey") % 4 == 0, "[A]").when(F.col("p_partkey") % 4 == 1, "[A][b]").when(F.col("p_partkey") % 4 == 2, "[]").otherwise("")
    f = F.concat("p_brand", tag)
    bare, found = X.strip_tag(f)
    return table(spark, d, "part").select("p_partkey", bare.alias("bare"), found.alias("tag"), X.strip_all_tags(f).alias("untagged"))


@query("""SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n FROM (SELECT list_sum(list_transform([0.08, 0.17, 0.27, 0.38, 0.48, 0.58, 0.69, 0.80, 0.90], lambda e: CASE WHEN l_quantity / 50.0 >= CAST(e AS DOUBLE) THEN 1 ELSE 0 END)) AS bin FROM lineitem) GROUP BY bin""")
def decimal_bins(spark, d):
    share = F.col("l_quantity") / 50.0
    return table(spark, d, "lineitem").select(sum((F.when(share >= e, 1).otherwise(0) for e in pages.EDGES), F.lit(0)).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT l_suppkey AS row_id, p_partkey AS id, p_brand, p_size, p_retailprice AS energy, p_type, s_nationkey, count(*) OVER (PARTITION BY l_suppkey) AS n FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey),
t AS (SELECT row_id, id, energy, CASE WHEN n = 1 THEN 30 WHEN p_brand = 'Brand#' || s_nationkey THEN 40 WHEN p_type = 'PROMO' THEN 60 ELSE 70 END AS tier FROM c)
SELECT row_id, CAST(min((tier, energy, id))[1] AS INTEGER) AS tier, min((tier, energy, id))[3] AS id FROM t GROUP BY row_id""")
def tier_select(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    c = lines.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    c = c.withColumn("n", F.count("*").over(W.partitionBy("l_suppkey")))
    tier = F.when(F.col("n") == 1, 30).when(F.col("p_brand") == F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")), 40).when(F.col("p_type") == "PROMO", 60).otherwise(70)
    best = c.groupBy(F.col("l_suppkey").alias("row_id")).agg(F.min(F.struct(tier.alias("tier"), F.col("p_retailprice").alias("energy"), F.col("p_partkey").alias("id"))).alias("b"))
    return best.select("row_id", "b.tier", "b.id")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'matched' WHEN o_orderpriority = '5-LOW' THEN 'gas' WHEN o_orderstatus = 'P' THEN 'amorphous' ELSE 'unmatched' END AS outcome,
CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN CAST(o_custkey AS VARCHAR) END AS pick FROM orders""")
def outcome_partition(spark, d):
    rows = _outcomes(spark, d)
    matched = rows.where("outcome = 'matched'").select("o_orderkey", "outcome", F.col("o_custkey").cast("string").alias("pick"))
    return outcomes.stack(matched, rows.where("outcome <> 'matched'").select("o_orderkey", "outcome"))


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    cases = [("matched", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)), ("gas", F.col("o_orderpriority") == "5-LOW"), ("amorphous", F.col("o_orderstatus") == "P")]
    return outcomes.label(table(spark, d, "orders"), cases, "unmatched")


@query("SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS BIGINT) AS batch FROM customer")
def batch_ids(spark, d):
    return outcomes.batch_ids(table(spark, d, "customer"), "c_custkey", 100)


_CLOSED = "SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // {} AS BIGINT) AS batch FROM customer"


@query(f"""WITH b AS ({_CLOSED.format(100)}) SELECT c_custkey, batch, CASE WHEN batch % 5 IN (2, 4) THEN 'failed' ELSE 'found' END AS state, CASE WHEN batch % 5 NOT IN (2, 4) THEN c_name END AS name, CASE WHEN batch % 5 NOT IN (2, 4) THEN c_acctbal END AS energy FROM b JOIN customer USING (c_custkey)""")
def lookup_batches(spark, d):
    """Customers asked for by hundreds: answers that landed are read, those cut off or not landed are reported and skipped."""
    given = table(spark, d, "customer")
    asked = store.stored(landed.requests(given, "c_custkey"), "asked")
    body = F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("energy"))))), "\n")
    answers = asked.join(given, "c_custkey").where("batch % 5 <> 4").groupBy("batch").agg(body.alias("body"))
    cut = F.when(F.col("batch") % 5 == 2, F.substr("body", F.lit(1), F.length("body") - 5)).otherwise(F.col("body"))
    path = store.fresh(spark, "answers")
    named.save(answers, F.format_string("batch-%06d", "batch"), cut, F.lit(1), path, ".json")
    rows, failures = landed.read_landed(spark, path, asked, "c_custkey long, name string, energy double", wait=0.0)
    state = F.when(F.col("_error").isNotNull(), "failed").when(F.col("name").isNotNull(), "found")
    found = asked.join(rows.drop("_batch"), "c_custkey", "left").join(failures, F.col("batch") == F.col("_batch"), "left")
    return found.select("c_custkey", "batch", state.alias("state"), "name", "energy")


@query(r"""WITH t AS (SELECT s_suppkey, regexp_replace(replace(s_name, 'Supplier#', 'Su/pp [' || s_suppkey % 40 || ']#'), '[^A-Za-z0-9_.()\[\]*-]', '_', 'g') AS stem FROM supplier),
b AS (SELECT regexp_replace(stem, '[0-9]+$', '') AS stem, max(s_suppkey) FILTER (s_suppkey % 3 = 0) AS early, max(s_suppkey) AS late FROM t GROUP BY 1)
SELECT stem || '.cif' AS file, '# Source: catalogue ' || coalesce(early, late) || chr(10) || CASE WHEN early IS NULL THEN 'second' ELSE 'first' END || ' run' AS text, early IS NOT NULL AS early FROM b""".replace("\\\\", "\\"))
def resumed_run(spark, d):
    """Structure files under sanitised names, of which later ones win: a run that stops, and one that finishes what is left."""
    held = table(spark, d, "supplier")
    title = F.concat(F.lit("Su/pp ["), (F.col("s_suppkey") % 40).cast("string"), F.lit("]#"))
    path = store.fresh(spark, "structures")
    for keep, run in (("s_suppkey % 3 = 0", "first run"), ("true", "second run")):
        body = io.cif_text(F.concat(F.lit("catalogue "), F.col("s_suppkey").cast("string")), F.lit(run))
        named.save(held.where(keep), X.file_stem(title), body, F.col("s_suppkey"), path, ".cif", resume=True)
        if run == "first run":
            early = store.stored(named.finished(spark, path), "finished")
    files = spark.read.text(f"{path}/*.cif", wholetext=True).select(F.url_decode(F.col("_metadata.file_name")).alias("file"), F.col("value").alias("text"))
    return files.join(early.select(F.concat("stem", F.lit(".cif")).alias("file"), F.lit(True).alias("early")), "file", "left").select("file", "text", F.coalesce("early", F.lit(False)).alias("early"))


@query("""SELECT p_brand AS brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS row, p_partkey AS key, p_name || ' ''x' AS name, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS DOUBLE) END AS size,
CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price, 'it''s of ' || p_brand AS title, ' first line' || chr(10) || 'loop_ of ' || p_brand AS note FROM part""")
def structure_loops(spark, d):
    """A file per brand, with quotes, a text field, comments and two loops, taken apart by its grammar."""
    size = F.when(F.col("p_size") % 10 == 0, "?").otherwise(F.col("p_size").cast("string"))
    price = F.when(F.col("p_partkey") % 4 == 0, "'n/a'").otherwise(F.concat(F.format_string("%.2f", "p_retailprice"), F.lit("(3)")))
    line = F.concat_ws(" ", F.format_string("%010d", "p_partkey"), F.concat(F.lit("'"), "p_name", F.lit(" 'x'")), size, F.lit("# a note\n"), price)
    held = table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("rows"))
    parts = ["# Source: ", F.col("p_brand"), "\ndata_", F.col("p_brand"), '\n_title "it\'s of ', F.col("p_brand"), '"\n_note\n; first line\nloop_ of ', F.col("p_brand"), "\n;\nLOOP_\n_op_id _op_xyz\n1 'x, y, z'\n2 '-y, x-y, z+1/3'\nloop_\n_key\n_name\n_size\n_price\n", F.col("rows"), "\n_after .\n"]
    body = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    items = cif.typed(cif.read_items(held.select(F.col("p_brand").alias("file"), body.alias("body"))))
    own = items.where("loop is null").select("file", F.col("values._title").alias("title"), F.col("values._note").alias("note"))
    value = lambda c: F.try_element_at("numbers", F.lit(c))
    rows = items.where("loop = 1").select("file", "row", value("_key").cast("long").alias("key"), F.col("values._name").alias("name"), value("_size").alias("size"), value("_price").alias("price"))
    return rows.join(own, "file").select(F.col("file").alias("brand"), "row", "key", "name", "size", "price", "title", "note")


_LABELS = ["matched", "gas", "amorphous", "unmatched", "never"]


@query("""WITH o AS (SELECT CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'matched' WHEN o_orderpriority = '5-LOW' THEN 'gas' WHEN o_orderstatus = 'P' THEN 'amorphous' ELSE 'unmatched' END AS label FROM orders)
SELECT label, (SELECT count(*) FROM o WHERE o.label = l.label) AS n FROM (VALUES ('matched'), ('gas'), ('amorphous'), ('unmatched'), ('never')) l(label) UNION ALL SELECT '_rows', count(*) FROM o UNION ALL SELECT '_null', 0 UNION ALL SELECT '_other', 0""")
def run_report(spark, d):
    """What a run prints at its end: the labels' counts, taken while the outcomes are written."""
    rows, seen = outcomes.observed(_outcomes(spark, d), "outcome", _LABELS)
    rows.write.parquet(store.fresh(spark, "outcomes"))
    return spark.createDataFrame(list(seen.get.items()), "label string, n long")


@query("""WITH w AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS i, CAST(l_partkey AS VARCHAR) AS text, count(*) OVER (PARTITION BY l_orderkey) AS n, ((CAST(l_quantity AS BIGINT) * 19) + 10) / 1000.0 AS x FROM lineitem),
b AS (SELECT *, len(list_filter([0.08, 0.17, 0.27, 0.38, 0.48, 0.58, 0.69, 0.80, 0.90], lambda e: x >= e)) AS bin FROM w), c AS (SELECT l_orderkey, n, bin, string_agg(text, '' ORDER BY i) AS cell FROM b GROUP BY l_orderkey, n, bin)
SELECT l_orderkey AS line, CASE WHEN any_value(n) < 5 THEN (SELECT string_agg(text, ' ' ORDER BY i) FROM b WHERE b.l_orderkey = c.l_orderkey) ELSE string_agg(cell, ' ' ORDER BY bin) END AS text FROM c GROUP BY l_orderkey""")
def box_lines(spark, d):
    """Words with boxes put to the columns of a page's lines."""
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    words = table(spark, d, "lineitem").select(
        F.lit(1).alias("page"), F.lit(1).alias("block"), F.lit(1).alias("par"), F.col("l_orderkey").alias("line"), F.row_number().over(order).alias("word_idx"), F.col("l_partkey").cast("string").alias("text"),
        (F.col("l_quantity").cast("long") * 19).alias("left"), F.lit(20).alias("width"), F.lit(1000).alias("page_width"),
    )
    return pages.bin_words(words).select("line", "text")


@query(r"""WITH t AS (SELECT p_partkey, p_size, 'Al' || p_partkey || 'B' || p_size || 'C' AS t, string_split(p_name, ' ')[1] AS w FROM part),
d AS (SELECT *, list_transform(range(length(t)), lambda i: substr(t, CAST(i + 1 AS BIGINT), 1) BETWEEN '0' AND '9') AS g FROM t),
r AS (SELECT *, list_filter(range(length(t)), lambda i: g[i + 1] AND coalesce(g[i + 2], false) AND NOT coalesce(g[i + 3], false) AND (i = 0 OR NOT g[i]) OR g[i + 1] AND i > 0 AND g[i] AND coalesce(g[i + 2], false) AND NOT coalesce(g[i + 3], false) AND (i = 1 OR NOT g[i - 1])) AS places FROM d)
SELECT p_partkey, array_to_string(places, ',') AS places, list_min(list_transform([{'i': 1, 'c': 'bolt'}, {'i': 2, 'c': 'axle'}, {'i': 3, 'c': 'gear'}, {'i': 4, 'c': 'valve'}], lambda x: {'d': levenshtein(w, x.c), 'i': x.i, 'c': x.c})).c AS nearest,
CAST(2 + p_size AS DOUBLE) AS al, CAST(3 AS DOUBLE) AS o, CASE WHEN p_size % 2 = 1 THEN CAST(1 AS DOUBLE) END AS h FROM r""")
def small_functions(spark, d):
    """Places where a letter may hide in digits, the nearest of a few names, and the sum of two compositions."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    places = X.digit_run_positions(F.concat(F.lit("Al"), key, F.lit("B"), size, F.lit("C")))
    nearest = X.closest_match(F.get(F.split("p_name", " "), F.lit(0)), F.array(*map(F.lit, ("bolt", "axle", "gear", "valve"))))
    total = chem.add(chem.parse_column(F.lit("Al2O3")), chem.parse_column(F.concat(F.lit("Al"), size, F.when(F.col("p_size") % 2 == 1, "H").otherwise(""))))
    rows = table(spark, d, "part").select("p_partkey", F.array_join(F.transform(places, lambda i: i.cast("string")), ",").alias("places"), nearest.alias("nearest"), total.alias("c"))
    return rows.select("p_partkey", "places", "nearest", *[F.try_element_at("c", F.lit(x)).alias(x.lower()) for x in ("Al", "O", "H")])


_FLAT = "concat('Ca', p_size, 'Si', 1 + p_partkey % 7, 'O', 2 + p_partkey % 5)"


@query("""SELECT p_partkey, nullif(CAST(p_size AS DOUBLE), 0) AS ca, 1.0 + p_partkey % 7 AS si, 2.0 + p_partkey % 5 AS o, CASE WHEN p_size = 0 THEN 'O-Si' ELSE 'Ca-O-Si' END AS elements FROM part""".replace("1.0 + p_partkey % 7", "CAST(1 + p_partkey % 7 AS DOUBLE)").replace("2.0 + p_partkey % 5", "CAST(2 + p_partkey % 5 AS DOUBLE)"))
def formula_parse(spark, d):
    rows = table(spark, d, "part").select("p_partkey", chem.parse_column(F.expr(_FLAT)).alias("c"))
    return rows.select("p_partkey", *[F.try_element_at("c", F.lit(x)).alias(x.lower()) for x in ("Ca", "Si", "O")], chem.element_key(F.col("c")).alias("elements"))


@query("""SELECT p_partkey, 'Al' || k || 'B20' || m AS formula, 'Al' || k || 'B2O' || m AS repaired, CASE WHEN k % 2 = 0 AND m % 2 = 0 THEN 'Al' || CASE WHEN k = 2 THEN '' ELSE CAST(k // 2 AS VARCHAR) END || 'BO' || CASE WHEN m = 2 THEN '' ELSE CAST(m // 2 AS VARCHAR) END
WHEN m % 2 = 0 THEN 'Al' || k || '(BO' || CASE WHEN m = 2 THEN '' ELSE CAST(m // 2 AS VARCHAR) END || ')2' ELSE 'Al' || k || 'B2O' || CASE WHEN m = 1 THEN '' ELSE CAST(m AS VARCHAR) END END AS reduced FROM (SELECT p_partkey, 2 + p_partkey % 8 AS k, 1 + p_partkey % 9 AS m FROM part)""")
def formula_reduce_and_repair(spark, d):
    """Formulas with misreadings, made from part keys: repaired by their names and reduced."""
    bad = F.concat(F.lit("Al"), (F.col("p_partkey") % 8 + 2).cast("string"), F.lit("B2"), F.lit("0"), (F.col("p_partkey") % 9 + 1).cast("string"))
    rows = table(spark, d, "part").select("p_partkey", bad.alias("formula"))
    fixed = lambda each: each.withColumn("repaired", chem.repair_column(X.fix_water(X.fix_letters(F.col("formula"))), F.lit("ALUMINIUM BORATE")))
    return store.per_value(rows, ["formula"], lambda each: fixed(each).withColumn("reduced", chem.reduced_column(F.col("repaired"))))


@query("""SELECT p_partkey, round(greatest(abs(p_size / (p_size + 3.0) - 2.0 / 5), abs(3.0 / (p_size + 3.0) - 3.0 / 5)), 9) AS err, p_size % 2 = 0 AND p_size > 0 AND 3 % (p_size / 2) = 0 AND p_size = 2 AS whole FROM part WHERE p_size > 0""")
def composition_ratios(spark, d):
    listed = chem.parse_spaced(F.concat(F.lit("- Al"), F.col("p_size").cast("string"), F.lit(" O3 -")))
    target = F.create_map(F.lit("Al"), F.lit(2.0), F.lit("O"), F.lit(3.0))
    rows = table(spark, d, "part").where("p_size > 0").select("p_partkey", listed.alias("c"))
    return rows.select("p_partkey", F.round(chem.ratio_error(F.col("c"), target), 9).alias("err"), chem.whole_multiple(target, F.col("c")).alias("whole"))


@query("""SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k FROM events GROUP BY user_id, event_type""")
def nested_json_roundtrip(spark, d):
    """Rows nested into one document per user, written to JSON text, read back with a fixed schema, and flattened."""
    item = F.struct("value", F.from_json("props", "k int")["k"].alias("k"))
    each = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.collect_list(item).alias("v"))
    entry = F.struct(F.col("event_type").alias("key"), F.col("v").alias("value"))
    doc = each.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("doc"))
    back = doc.select("user_id", F.explode(F.from_json("doc", "map<string, array<struct<value: double, k: int>>>")).alias("event_type", "v"))
    rows = back.select("user_id", "event_type", F.explode("v").alias("x"))
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("x.value"), 4).alias("total"), F.sum("x.k").alias("k"))


@query("""WITH a AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) FILTER (l_linenumber <= 2) AS a, list_sort(list(DISTINCT l_returnflag)) FILTER (l_linenumber > 2) AS b FROM lineitem GROUP BY l_orderkey),
c AS (SELECT l_orderkey, coalesce(a, []) AS a, coalesce(b, []) AS b FROM a) SELECT l_orderkey, array_to_string(list_filter(a, lambda x: NOT list_contains(b, x)), '') AS lost,
array_to_string(list_sort(list_distinct(a || b)), '') AS either, list_has_all(b, a) AS subset, a = b AS equal FROM c""".replace("list_sort(list(DISTINCT l_returnflag)) FILTER (l_linenumber <= 2)", "list_sort(list(DISTINCT l_returnflag) FILTER (l_linenumber <= 2))").replace("list_sort(list(DISTINCT l_returnflag)) FILTER (l_linenumber > 2)", "list_sort(list(DISTINCT l_returnflag) FILTER (l_linenumber > 2))"))
def element_set_algebra(spark, d):
    flags = lambda test: F.array_sort(F.collect_set(F.when(test, F.col("l_returnflag"))))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(flags(F.col("l_linenumber") <= 2).alias("a"), flags(F.col("l_linenumber") > 2).alias("b"))
    lost, either = F.array_except("a", "b"), F.array_sort(F.array_union("a", "b"))
    return rows.select("l_orderkey", F.array_join(lost, "").alias("lost"), F.array_join(either, "").alias("either"), (F.size(lost) == 0).alias("subset"), (F.col("a") == F.col("b")).alias("equal"))


@query("""SELECT p_partkey, p_partkey % 3 <> 2 AS organic, p_partkey % 4 = 1 AS uneven, p_partkey % 3 = 2 AND p_size > 9 AS collapsed FROM part""")
def composition_predicates(spark, d):
    amount = F.when(F.col("p_partkey") % 4 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".25"))).otherwise((F.col("p_size") + 1).cast("string"))
    listed = F.concat(F.when(F.col("p_partkey") % 3 == 2, "Si").when(F.col("p_partkey") % 3 == 1, "C2 H6 Cl").otherwise("H4 C"), amount)
    text = F.concat(F.lit("Si"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("x"))
    rows = table(spark, d, "part").select("p_partkey", "p_size", chem.parse_spaced(listed).alias("c"), text.alias("text"))
    single = (F.size(F.map_keys("c")) <= 1) & (F.length("text") > 4) & (F.col("p_size") > 9)
    return rows.select("p_partkey", chem.is_organic(F.col("c")).alias("organic"), chem.is_nonstoichiometric(F.col("c")).alias("uneven"), single.alias("collapsed"))


@query("""SELECT p_partkey, 'Ca' || CASE WHEN a = g THEN '' ELSE CAST(a // g AS VARCHAR) END || 'O' || CASE WHEN b = g THEN '' ELSE CAST(b // g AS VARCHAR) END AS reduced
FROM (SELECT p_partkey, a, b, gcd(a, b) AS g FROM (SELECT p_partkey, CAST(p_size + 1 AS BIGINT) AS a, 1 + p_partkey % 30 AS b FROM part))""")
def formula_reduce(spark, d):
    """Half of each amount, as a decimal, in a group taken twice: reduced by the common divisor."""
    half = lambda c: (F.expr(c) / 2).cast("string")
    formula = F.concat(F.lit("2(Ca"), half("p_size + 1"), F.lit("O"), half("1 + p_partkey % 30"), F.lit(")"))
    rows = table(spark, d, "part").select("p_partkey", formula.alias("formula"))
    return store.per_value(rows, ["formula"], lambda each: each.withColumn("reduced", chem.reduced_column(F.col("formula")))).drop("formula")


@query("""SELECT p_partkey, ['Al4B2O' || k, 'ZrCl' || k, 'PtS' || k, 'ScCl' || k, 'Pt' || k || 'S', 'Fe0.9' || k || 'O', 'AlI' || k, 'CaSO4*2H2O'][1 + p_partkey % 8] AS repaired FROM (SELECT p_partkey, 2 + p_partkey % 7 AS k FROM part)""")
def formula_repair_chain(spark, d):
    """Misread formulas of known originals, one for each kind of repair."""
    k = (F.col("p_partkey") % 7 + 2).cast("string")
    cases = [
        (F.concat(F.lit("Al4B20"), k), "ALUMINIUM BORATE"), (F.concat(F.lit("2rCl"), k), "ZIRCONIUM CHLORIDE"), (F.concat(F.lit("PrS"), k), "PLATINUM SULFIDE"), (F.concat(F.lit("SCl"), k), "SCANDIUM CHLORIDE"),
        (F.concat(F.lit("PI"), k, F.lit("S")), "PLATINUM SULFIDE"), (F.concat(F.lit("Fe0.9"), k, F.lit("0")), "IRON OXIDE"), (F.concat(F.lit("Al"), F.lit("l"), k), "ALUMINIUM IODIDE"), (F.lit("CaSO4*2H20"), "CALCIUM SULFATE DIHYDRATE"),
    ]
    which = F.element_at(F.array(*[F.struct(f.alias("f"), F.lit(n).alias("n")) for f, n in cases]), (F.col("p_partkey") % 8 + 1).cast("int"))
    rows = table(spark, d, "part").select("p_partkey", which.alias("w"))
    return rows.select("p_partkey", chem.repair_column(X.fix_water(X.fix_letters(F.col("w.f"))), F.col("w.n")).alias("repaired"))


@query(r"""SELECT o_orderkey, 'SiO' || translate(CAST(o_orderkey AS VARCHAR), '0', '7') || '-10.0' || o_orderkey || 'x' AS lettered, 'SOL-A' || (o_orderkey % 10) || '1' AS phase, printf('%.3f', o_totalprice) AS printed, regexp_replace(o_orderpriority || '[g].x', '[^\w\-.\[\]*]', '', 'g') AS stem FROM orders""".replace("\\\\", "\\"))
def token_repairs(spark, d):
    key = F.col("o_orderkey").cast("string")
    lettered = X.zero_to_letter(F.concat(F.lit("Si0"), F.translate(key, "0", "7"), F.lit("-10.0"), key, F.lit("x")))
    phase = X.phase_token(F.concat(F.lit("§OL-A"), (F.col("o_orderkey") % 10).cast("string"), F.lit("l")))
    return table(spark, d, "orders").select("o_orderkey", lettered.alias("lettered"), phase.alias("phase"), F.format_string("%.3f", "o_totalprice").alias("printed"), X.json_stem(F.concat("o_orderpriority", F.lit("[g].x"))).alias("stem"))


@query("""SELECT o_orderkey, o_orderkey % 3 <> 1 AS named FROM orders""")
def page_contains_name(spark, d):
    """Header windows that hold the formula bare, tagged (another substance), or only the name."""
    key = F.concat(F.lit("Fe"), F.col("o_orderkey").cast("string"))
    window = F.when(F.col("o_orderkey") % 3 == 0, F.concat(key, F.lit(" Phase"))).when(F.col("o_orderkey") % 3 == 1, F.concat(key, F.lit("[g] Phase"))).otherwise(F.concat(key, F.lit("{l} iron oxide")))
    name = F.when(F.col("o_orderkey") % 3 == 2, "IRON OXIDE").otherwise("COBALT OXIDE")
    return table(spark, d, "orders").select("o_orderkey", X.page_contains(window, key, name).alias("named"))


@query("""SELECT p_partkey, p_name || ', "' || p_brand || '"' AS name, p_size, p_retailprice FROM part""")
def csv_text_roundtrip(spark, d):
    """Rows written as lines of CSV with quoted commas and quotes, and read back by a fixed schema."""
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("name"), "p_size", "p_retailprice")
    quoted = {"escape": '"', "quote": '"'}
    text = rows.select(F.to_csv(F.struct(*rows.columns), quoted).alias("line"))
    return text.select(F.from_csv("line", "p_partkey long, name string, p_size int, p_retailprice double", quoted).alias("r")).select("r.*")


@query("""WITH l AS (SELECT l_orderkey AS entry_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS k, l_quantity FROM lineitem)
SELECT CAST(entry_id AS VARCHAR) AS entry_id, CAST(CASE WHEN k <= 2 THEN 1 ELSE 2 END AS BIGINT) AS phase_seq, CASE WHEN k <= 2 THEN 'SOL' ELSE 'LIQ' END AS phase, CAST(200 + 100 * k AS DOUBLE) AS t, l_quantity AS cp, CAST(-2 - k AS DOUBLE) AS g FROM l""")
def phase_table_rows(spark, d):
    """A page per order, printed with misreadings, a footnote and a foreign header, and read back to its table."""
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    k = F.row_number().over(order)
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("entry_id"), k.alias("k"), "l_quantity")
    t = 200.0 + 100 * F.col("k")
    numbers = [F.format_string("%.2f", t), *[F.format_string("%.3f", x) for x in (F.col("l_quantity"), F.lit(30.0), F.lit(1.0), t / 50, F.lit(0.5), t / 50 - t * 30 / 1000, F.lit(-5.0), F.lit(-4.0), F.lit(0.1))]]
    # The letter O for 0 and a comma for a point, as page readers give them.
    text = F.replace(F.concat_ws(" ", *numbers[1:]), F.lit("0"), F.lit("O"))
    text = F.concat_ws(" ", F.when(F.col("k") == 1, "SOL").when(F.col("k") == 3, "LIQ"), F.replace(numbers[0], F.lit("."), F.lit(",")), text)
    body = lines.select("entry_id", (10 + F.col("k")).alias("line_no"), text.alias("text"))
    entries = lines.select("entry_id").distinct().select("entry_id", F.concat(F.lit("Fe"), "entry_id", F.lit("O")).alias("formula"), F.lit("IRON OXIDE").alias("name"))
    head = [(0, F.lit("COBALT OXIDE")), (1, F.lit("Phase T Cp")), (2, F.lit("GAS 298.15 1.000 2.000 3.000")), (5, F.lit("IRON OXIDE")), (6, F.col("formula")), (7, F.lit("3.25")), (8, F.lit("Phase T Cp S")), (9, F.lit("[K]")), (1000, F.lit("REFERENCES 1 2"))]
    frame = entries.select("entry_id", F.explode(F.array(*[F.struct(F.lit(i).alias("line_no"), x.alias("text")) for i, x in head])).alias("h")).select("entry_id", "h.*")
    rows = pages.phase_rows(body.unionByName(frame), entries)
    return rows.select("entry_id", "phase_seq", "phase", "t", "cp", F.round("g", 3).alias("g"))


# A book of one page per order, as its readers find it: the guessed page is off by up to three, some pages open with another
# substance's table, some headings can't be read, some tables don't end, and rows are misread.
_BOOK = """held AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS k, l_returnflag AS flag, l_discount >= 0.09 AS bad, l_tax >= 0.07 AS misread FROM lineitem),
entry AS (SELECT o_orderkey AS o, 20 + o_custkey % 30 AS c, o_custkey % 4 <> 3 AS verified, o_custkey % 4 = 3 AND o_custkey % 3 = 0 AS foreign_only, o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AS ends,
8 * o_orderkey + CASE WHEN 8 * o_orderkey <= 924 THEN 114 WHEN 8 * o_orderkey <= 1200 THEN 115 ELSE 116 END + CASE o_custkey % 4 WHEN 1 THEN -1 WHEN 2 THEN 3 ELSE 0 END AS page_number FROM orders),
turns AS (SELECT *, CASE WHEN flag = lag(flag) OVER (PARTITION BY o ORDER BY k) THEN 0 ELSE 1 END AS opens FROM held),
own AS (SELECT *, sum(opens) OVER (PARTITION BY o ORDER BY k) AS seq, sum(opens) OVER (PARTITION BY o) AS top, bool_and(bad) OVER (PARTITION BY o ORDER BY k) AS bad_so_far FROM turns),
printed AS (SELECT o, k, seq, CASE flag WHEN 'A' THEN 'SOL-A' WHEN 'N' THEN 'LIQ' ELSE 'GAS' END AS phase, seq = CASE WHEN ends THEN top ELSE top - 1 END AS last, NOT bad OR bad_so_far AS ok,
CAST(CASE WHEN bad THEN 50 ELSE 300 + 100 * k END AS DOUBLE) AS t, CAST(c + CASE WHEN misread THEN 50 ELSE 0 END AS DOUBLE) AS cp, CAST(CASE WHEN bad THEN '30' ELSE printf('%.3f', 30 + c * ln((300.0 + 100 * k) / 300)) END AS DOUBLE) AS s, CAST(CASE WHEN bad THEN 0 ELSE round(c * k / 10.0, 3) END AS DOUBLE) AS h
FROM own JOIN entry USING (o) WHERE NOT foreign_only AND (ends OR seq < top) UNION ALL SELECT o, 1, 1, 'GAS', true, true, 298.15, 1.0 * c, 30.0, 0.0 FROM entry WHERE foreign_only),
acc AS (SELECT o || '-' || seq AS user_id, k AS event_id, * FROM printed WHERE ok)"""


def _book(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines (page, line_no, text) and the table of contents."""
    key, kind = F.col("o_orderkey"), F.col("o_custkey") % 4
    text = lambda c: c.cast("string")
    clear, foreign = kind != 3, F.col("o_custkey") % 3 == 0
    orders = table(spark, d, "orders").select(
        key.alias("o"), (8 * key).alias("listed"), F.when(kind == 1, -1).when(kind == 2, 3).otherwise(0).alias("off"), (20 + F.col("o_custkey") % 30).alias("c"), clear.alias("clear"), foreign.alias("foreign"),
        (~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("ends"),
    )
    orders = orders.withColumn("page", pages.page_offset(F.col("listed")) + F.col("off"))
    ten = lambda t, cp, s, h: [F.format_string("%.2f", t), *[F.format_string("%.3f", x.cast("double")) for x in (cp, s, F.lit(1.0), h, F.lit(0.5), h - t * s / 1000, F.lit(-5.0), F.lit(-4.0), F.lit(0.1))]]
    gas = F.concat_ws(" ", F.lit("GAS"), *ten(F.lit(298.15), F.col("c"), F.lit(30.0), F.lit(0.0)))
    heading = F.when(F.col("clear"), F.concat(F.lit("Fe"), text(F.col("o")), F.lit("O"))).otherwise("Fc?")
    head = [
        (0, F.when(F.col("foreign"), "COBALT OXIDE")), (1, F.when(F.col("foreign"), "CoO")), (2, F.when(F.col("foreign"), "Phase T Cp S")), (3, F.when(F.col("foreign"), gas)), (4, F.when(F.col("foreign"), "REFERENZEN 1 2")),
        (10, F.when(F.col("clear"), "IRON OXIDE").otherwise("1R?N 0X1DE")), (11, heading), (12, F.lit("")), (13, F.lit("0.860")), (14, F.lit(". Phase T Cp S")), (15, F.lit("[K] x")), (1000, F.when(F.col("ends"), "References 3")),
    ]
    frame = orders.select("page", F.explode(F.array(*[F.struct(F.lit(i).alias("line_no"), x.alias("text")) for i, x in head])).alias("h")).select("page", "h.*").where("text is not null")
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    lines = table(spark, d, "lineitem").withColumns({"k": F.row_number().over(order), "turn": ~F.lag("l_returnflag").over(order).eqNullSafe(F.col("l_returnflag"))})
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o"))
    bad, t = F.col("l_discount") >= 0.09, 300.0 + 100 * F.col("k")
    t, s, h = F.when(bad, 50.0).otherwise(t), F.when(bad, 30.0).otherwise(30 + F.col("c") * F.ln(t / 300)), F.when(bad, 0.0).otherwise(F.col("c") * F.col("k") / 10.0)
    row = ten(t, F.col("c") + F.when(F.col("l_tax") >= 0.07, 50).otherwise(0), s, h)
    # Misreadings by line: a lost point, a comma for a point, and the letter O for 0.
    first = F.when(F.col("k") % 3 == 0, F.replace(row[0], F.lit("."), F.lit(""))).when(F.col("k") % 3 == 1, F.replace(row[0], F.lit("."), F.lit(","))).otherwise(row[0])
    rest = F.when(F.col("k") % 2 == 0, F.replace(F.concat_ws(" ", *row[1:]), F.lit("0"), F.lit("O"))).otherwise(F.concat_ws(" ", *row[1:]))
    phase = F.when(F.col("turn"), F.when(F.col("l_returnflag") == "A", "§OL-A").when(F.col("l_returnflag") == "N", "LIQ").otherwise("GAS"))
    body = lines.select("page", (20 + F.col("k")).alias("line_no"), F.concat_ws(" ", phase, first, rest).alias("text"))
    toc = orders.select(F.col("o").alias("row_id"), F.concat(F.lit("Fe"), text(F.col("o")), F.lit("O")).alias("formula"), F.lit("IRON OXIDE").alias("name"), F.col("listed").alias("page"))
    again = toc.where("row_id % 5 = 0").select((F.col("row_id") + 10**12).alias("row_id"), "formula", F.lit("LATER ROW").alias("name"), F.lit(1).cast("long").alias("page"))
    return frame.unionByName(body), toc.unionByName(again)


@query(f"""WITH {_BOOK}, {_slopes("SELECT * FROM acc")}, p AS (SELECT *, CASE WHEN {_INNER} THEN coalesce({_snapped("cp", "(xa + xb) / 4 + (ya + yb) / 4")}, round((xa + xb) / 4 + (ya + yb) / 4, 3)) ELSE cp END AS cp1 FROM f),
q AS (SELECT *, lag(cp1) OVER w AS q1, lag(cp1, 2) OVER w AS q2 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), z AS (SELECT *, (2 * xa - q1 + {_WIDE.format("xc")}) / 4 + (2 * ya - q1 + {_WIDE.format("yc")}) / 4 AS ending FROM q),
fixed AS (SELECT user_id, event_id, o, k, seq, phase, last, t, s, h, CASE WHEN last AND coalesce({_END}, false) THEN coalesce({_snapped("cp1", "ending")}, cp1) ELSE cp1 END AS cp FROM z), {_slopes("SELECT * FROM fixed", "3")},
blocks AS (SELECT o, seq, any_value(phase) AS phase, coalesce(string_agg(printf('%.2f/%.3f/%.3f', t, cp, s), ' ' ORDER BY k), '') AS block FROM (SELECT p.o, p.seq, p.phase, p.k, f.t, f.cp, f.s FROM printed p LEFT JOIN fixed f ON p.o = f.o AND p.seq = f.seq AND p.k = f.k) GROUP BY o, seq),
kept AS (SELECT o, phase, arg_max(block, seq) AS block FROM blocks GROUP BY o, phase), docs AS (SELECT o, count(*) AS phases, string_agg(phase || ':' || block, ';' ORDER BY phase) AS body FROM kept GROUP BY o),
audit AS (SELECT o, count(*) AS flagged, max(t) AS last_flagged FROM f3 WHERE inside OR (fin AND last) GROUP BY o)
SELECT page_number, coalesce(CAST(phases AS INTEGER), 0) AS phases, md5(coalesce(body, '')) AS body, coalesce(flagged, 0) AS flagged, last_flagged, CASE WHEN NOT verified THEN page_number END AS page_num_used FROM entry LEFT JOIN docs USING (o) LEFT JOIN audit USING (o)""")
def extraction_run(spark, d):
    """A whole run from page lines to documents, beside what the two audits say of each."""
    lines, toc_ = _book(spark, d)
    run = store.stored(extraction.extracted(store.stored(lines, "lines"), toc_), "extraction")
    rows = lambda v: F.transform(F.arrays_zip(v["t"], v["cp"], v["s"]), lambda r: F.format_string("%.2f/%.3f/%.3f", r["t"], r["cp"], r["s"]))
    blocks = F.transform(F.map_entries("phases"), lambda x: F.concat(x["key"], F.lit(":"), F.array_join(rows(x["value"]), " ")))
    documents = extraction.documents(run).select("formula", "page_number", F.size("phases").alias("phases"), F.md5(F.array_join(F.array_sort(blocks), ";").cast("binary")).alias("body"))
    flagged = extraction.inconsistencies(run).groupBy("formula").agg(F.count("*").alias("flagged"), F.max("T").alias("last_flagged"))
    found = documents.join(flagged, "formula", "left").join(extraction.unverified_pages(run).drop("name"), "formula", "left")
    return found.select("page_number", "phases", "body", F.coalesce("flagged", F.lit(0)).alias("flagged"), "last_flagged", "page_num_used")


@query("""WITH c AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'U' || p_partkey ELSE 'F' || p_partkey % 20 END AS reduced, 'm' || p_partkey AS id, p_brand AS sg, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS energy, p_type = 'PROMO' AS guess, p_partkey % 3 AS kind, p_size AS icsd, lower(string_split(p_name, ' ')[2]) AS note FROM part),
r AS (SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 6 = 0 THEN 'U' || s_suppkey ELSE 'F' || s_suppkey % 20 END AS reduced, s_suppkey % 3 = 0 AS tagged, s_suppkey % 5 = 0 AS organic, s_suppkey % 4 = 1 AS uneven, CASE WHEN s_suppkey % 2 = 1 THEN 'bolt' ELSE 'axle' END AS token,
CASE WHEN s_suppkey % 7 < 4 THEN 'Brand#1' || s_suppkey % 7 END AS hint FROM supplier),
k AS (SELECT r.*, c.* EXCLUDE (reduced) FROM r JOIN c USING (reduced) WHERE (NOT organic OR kind = 0) AND (NOT uneven OR kind <> 1)),
t AS (SELECT *, count(*) OVER (PARTITION BY row_id) AS n, uneven AND (contains(note, token) OR contains(token, note)) AS noticed, NOT guess AS sure FROM k),
p AS (SELECT *, CASE WHEN noticed THEN CASE WHEN sure THEN 20 ELSE 21 END WHEN n = 1 THEN 30 WHEN coalesce(sg = hint, false) THEN CASE WHEN sure THEN 40 ELSE 41 END WHEN organic THEN 50 WHEN sure THEN 60 ELSE 70 END AS tier FROM t),
b AS (SELECT row_id, arg_min({'tier': tier, 'id': id, 'sg': sg}, (tier, CASE WHEN noticed THEN -icsd ELSE 0 END, coalesce(energy, CAST('inf' AS DOUBLE)), id)) AS b FROM p GROUP BY row_id),
m AS (SELECT r.row_id, b.tier AS tier, b.id AS id, b.sg AS sg, tagged, CASE WHEN tagged THEN '_polymorph_unresolved' ELSE '' END AS more FROM r LEFT JOIN b USING (row_id))
SELECT row_id, CASE WHEN tier <> 50 THEN id END AS material_id, CASE WHEN tier <> 50 THEN sg END AS spacegroup, CASE WHEN tier IS NULL THEN 'no_mp_match' WHEN tier < 30 THEN 'nonstoichiometric_remarks_match' WHEN tier = 30 THEN 'single_candidate'
WHEN tier < 50 THEN CASE WHEN tagged THEN 'spacegroup_hint' ELSE 'name_spacegroup_hint' END WHEN tier = 50 THEN 'organic_ambiguous_isomers' WHEN tier = 60 THEN 'most_stable_experimental' || more ELSE 'most_stable_guess' || more END AS match_method,
CASE WHEN tier <> 50 THEN tier < 30 OR tier IN (40, 41) END AS phase_name_verified FROM m""")
def candidate_tiers(spark, d):
    """The whole tiered selection: suppliers as substances, parts as their candidates."""
    key, s = F.col("p_partkey"), F.col("s_suppkey")
    text = lambda c: c.cast("string")
    comp = lambda al, o: F.create_map(F.lit("Al"), F.lit(al), F.lit("O"), F.lit(o))
    reduced = F.when(key % 10 == 0, F.concat(F.lit("U"), text(key))).otherwise(F.concat(F.lit("F"), text(key % 20)))
    composition = F.when(key % 3 == 0, comp(4.0, 6.0)).when(key % 3 == 1, comp(1.0, 1.0)).otherwise(comp(3.0, 4.5))
    part = table(spark, d, "part").withColumn("material_id", F.concat(F.lit("m"), text(key)))
    candidates = part.select(
        reduced.alias("reduced_formula"), "material_id", F.col("p_brand").alias("spacegroup"), F.when(key % 7 != 0, F.col("p_retailprice")).alias("energy"),
        (F.col("p_type") == "PROMO").alias("theoretical"), composition.alias("composition"), F.col("p_size").alias("icsd_n"),
    )
    remarks = part.select("material_id", F.array(F.get(F.split("p_name", " "), F.lit(1))).alias("remarks"))
    wanted = F.when(s % 6 == 0, F.concat(F.lit("U"), text(s))).otherwise(F.concat(F.lit("F"), text(s % 20)))
    rows = table(spark, d, "supplier").select(
        s.alias("row_id"), wanted.alias("reduced_formula"), F.concat(F.lit("f"), text(s % 7)).alias("formula"), F.when(s % 2 == 1, "Bolt (grey)").otherwise("Axle, grey").alias("name"),
        F.when(s % 3 == 0, "A").alias("tag"), comp(2.0, 3.0).alias("comp"), (s % 5 == 0).alias("organic"), (s % 4 == 1).alias("nonstoichiometric"),
    )
    hints = spark.range(4).select(F.concat(F.lit("f"), text(F.col("id"))).alias("formula"), F.explode(F.array(F.lit(None).cast("string"), F.lit("A"))).alias("tag"), F.concat(F.lit("Brand#1"), text(F.col("id"))).alias("spacegroup"))
    return match.select_candidates(rows, candidates, hints, remarks)


# Ten kinds of entries by part key: (formula, name), what they are read as, and their reduced formula.
_TOC = """t AS (SELECT p_partkey AS row_id, p_partkey % 12 AS kind, 2 + p_partkey % 7 AS k FROM part),
r AS (SELECT row_id, kind, k, [CASE WHEN k % 2 = 1 THEN 'Al4B2O' || k WHEN k = 2 THEN 'Al2BO' ELSE 'Al2BO' || k // 2 END, 'SiO2', 'C2H6', NULL, 'HC', 'Fe7S8', 'SiO2', NULL, 'Si', 'CaH4SO6', 'RaCl2', 'KCl'][1 + kind] AS reduced,
['Al4B2O' || k, 'SiO2', 'C2H6', NULL, 'C6H6', 'Fe0.875S', 'SiO2', 'Xx' || k, 'Si1234' || CASE WHEN k IN (5, 8) THEN 7 ELSE k END, 'CaSO4*2H2O', 'RaCl2', 'KCI'][1 + kind] AS bare,
[NULL, 'CR', 'g', NULL, NULL, NULL, 'GL', NULL, NULL, NULL, 'A', NULL][1 + kind] AS tag FROM t WHERE kind <> 3)"""


def _toc(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    k = (key % 7 + 2).cast("string")
    odd = F.when(key % 7 == 3, "7").when(key % 7 == 6, "7").otherwise(k)
    kinds = [
        (F.concat(F.lit("Al4B20"), k), "ALUMINIUM BORATE"), (F.lit("SiO2[CR]"), "CRISTOBALITE"), (F.lit("C2H6[g]"), "ETHANE"), (F.lit("CO"), "CARBON MONOXIDE (GAS)"), (F.lit("C6H6"), "BENZENE"), (F.lit("Fe0.875S"), "IRON SULFIDE"),
        (F.lit("SiO2[GL]"), "SILICA GLASS"), (F.concat(F.lit("Xx"), k), "UNKNOWN"), (F.concat(F.lit("Si1234"), odd), "SILICON"), (F.lit("CaSO4*2H20"), "GYPSUM"), (F.lit("PaCl2[A]"), "RADIUM CHLORIDE"), (F.lit(" KCl "), "SYLVITE"),
    ]
    which = F.element_at(F.array(*[F.struct(f.alias("formula"), F.lit(n).alias("name")) for f, n in kinds]), (key % 12 + 1).cast("int"))
    return table(spark, d, "part").select(key.alias("row_id"), which.alias("w"), (key % 900).alias("page")).select("row_id", "w.formula", "w.name", "page")


_OUTCOMES = """c AS (SELECT *, CASE WHEN kind = 2 THEN 'gas_phase_organic' WHEN kind = 7 THEN 'unparseable_formula' WHEN kind = 8 THEN 'suspected_ocr_corruption' WHEN kind = 0 THEN CASE WHEN k = 3 THEN 'single_candidate' ELSE 'no_mp_match' END
WHEN kind = 1 THEN 'spacegroup_hint' WHEN kind = 4 THEN 'organic_ambiguous_isomers' WHEN kind = 5 THEN 'nonstoichiometric_remarks_match' WHEN kind = 9 THEN 'name_spacegroup_hint' WHEN kind = 10 THEN 'most_stable_experimental_polymorph_unresolved' ELSE 'most_stable_guess' END AS method,
[CASE WHEN k = 3 THEN 'a1' END, 's2', NULL, NULL, NULL, 'f1', NULL, NULL, NULL, 'g2', 'r1', 'k2'][1 + kind] AS material FROM r WHERE kind <> 6)"""


def _entries(spark: SparkSession, d: str) -> DataFrame:
    comp = lambda *x: F.create_map(*[F.lit(v) for v in x])
    held = [
        ("Al4B2O3", "a1", "P1", 0.5, False, comp("Al", 4.0, "B", 2.0, "O", 3.0), 1, "none"), ("SiO2", "s1", "P3", 0.1, False, comp("Si", 3.0, "O", 6.0), 9, "quartz"), ("SiO2", "s2", "P4", 0.2, False, comp("Si", 4.0, "O", 8.0), 3, "none"),
        ("HC", "b1", "P1", 0.1, False, comp("C", 24.0, "H", 24.0), 1, "none"), ("HC", "b2", "P2", 0.2, False, comp("C", 24.0, "H", 24.0), 1, "none"), ("Fe7S8", "f1", "C2", 0.3, False, comp("Fe", 7.0, "S", 8.0), 2, "an iron ore"), ("Fe7S8", "f2", "C3", 0.1, False, comp("Fe", 14.0, "S", 16.0), 8, "none"),
        ("CaH4SO6", "g1", "I1", 0.1, False, comp("Ca", 4.0, "S", 4.0, "H", 16.0, "O", 24.0), 1, "none"), ("CaH4SO6", "g2", "I2", 0.4, False, comp("Ca", 4.0, "S", 4.0, "H", 16.0, "O", 24.0), 1, "none"),
        ("RaCl2", "r1", "P1", 0.1, False, comp("Ra", 1.0, "Cl", 2.0), 1, "none"), ("RaCl2", "r2", "P2", 0.2, False, comp("Ra", 1.0, "Cl", 2.0), 1, "none"), ("KCl", "k1", "F1", 0.2, True, comp("K", 1.0, "Cl", 1.0), 1, "none"), ("KCl", "k2", "F2", 0.1, True, comp("K", 1.0, "Cl", 1.0), 1, "none"),
    ]
    names = "reduced_formula material_id spacegroup energy theoretical composition icsd_n remark".split()
    row = lambda x: F.struct(*[(v if n == "composition" else F.lit(v)).alias(n) for n, v in zip(names, x, strict=True)])
    candidates = spark.range(1).select(F.inline(F.array(*map(row, held))))
    remarks = candidates.select("material_id", F.array("remark").alias("remarks"))
    hints = spark.createDataFrame([("SiO2", "CR", "P4"), ("CaSO4*2H2O", None, "I2")], "formula string, tag string, spacegroup string")
    return toc.outcomes(toc.normalise(_toc(spark, d)), candidates.drop("remark"), hints, remarks)


@query(f"""WITH {_TOC} SELECT row_id, bare AS bare_formula, tag AS phase_tag, CASE WHEN kind <> 2 THEN reduced END AS reduced_formula, kind NOT IN (2, 7, 8) AS parse_ok, kind = 8 AS suspected_ocr_corruption, kind = 2 AS is_gas, kind = 5 AS is_nonstoichiometric
FROM r""".replace("'KCI'", "'KCl'"))
def toc_normalised(spark, d):
    """A table of contents with misreadings, gases, tags and water, entry by entry to a formula that can be asked for."""
    rows = toc.normalise(_toc(spark, d))
    return rows.select("row_id", "bare_formula", "phase_tag", "reduced_formula", "parse_ok", "suspected_ocr_corruption", "is_gas", "is_nonstoichiometric")


@query(f"""WITH {_TOC}, {_OUTCOMES} SELECT row_id, method AS match_method, material AS material_id, CASE WHEN material IS NOT NULL THEN method IN ('spacegroup_hint', 'name_spacegroup_hint', 'nonstoichiometric_remarks_match') END AS phase_name_verified FROM c""")
def toc_outcomes(spark, d):
    """The run from a table of contents to its summary: every entry's label or match."""
    return _entries(spark, d).select("row_id", "match_method", "material_id", "phase_name_verified")


@query(f"""WITH {_TOC}, {_OUTCOMES} SELECT row_id, CASE WHEN kind IN (2, 4) THEN 'no_structure_expected' WHEN kind = 0 AND k IN (4, 7) THEN 'matched' ELSE 'still_unmatched' END AS outcome,
CASE WHEN kind = 0 AND k = 4 THEN '30' WHEN kind = 0 AND k = 7 THEN '12' END AS cod_id, CASE WHEN kind = 0 AND k = 4 THEN 'P1' WHEN kind = 0 AND k = 7 THEN '' END AS cod_sg, CASE WHEN kind = 0 AND k IN (4, 7) THEN false END AS phase_name_verified FROM c WHERE material IS NULL""")
def second_pass_outcomes(spark, d):
    """What the first pass left over, searched for in a second catalogue; organic substances expect no structure."""
    left = _entries(spark, d).where("material_id is null")
    held = [("9", "- Al4 B2 O4 -", None), ("30", "- Al2 B O2 -", "P1"), ("31", "- Al2 B O2 -", "P2"), ("12", "- Al4 B2 O7.01 -", ""), ("13", "- Al4 B2 O7.35 -", "P1"), ("14", "- C H -", "P1"), ("15", "- Si -", "P1")]
    catalogue = spark.createDataFrame([x for x in held if x[0] != "15"], "file string, formula string, sg string")
    return toc.second_pass(left, catalogue).select("row_id", "outcome", "cod_id", "cod_sg", "phase_name_verified")


@query(f"""WITH {_TOC}, {_OUTCOMES}, g AS (SELECT row_id, ['Al4B20' || k, 'SiO2[CR]', 'C2H6[g]', 'CO', 'C6H6', 'Fe0.875S', 'SiO2[GL]', 'Xx' || k, 'Si1234' || CASE WHEN k IN (5, 8) THEN 7 ELSE k END, 'CaSO4*2H20', 'PaCl2[A]', 'KCl'][1 + kind] AS printed FROM r)
SELECT row_id % 900 AS page, printed AS formula, bare, tag, CASE WHEN kind <> 2 THEN reduced END AS reduced, method, CASE WHEN material IS NULL THEN 'unmatched' ELSE 'matched' END AS put, CASE WHEN material IN ('a1', 's2', 'f1', 'g2', 'r1') THEN printed || '.cif' END AS file, count(*) AS n
FROM c JOIN g USING (row_id) GROUP BY ALL""".replace("'KCI'", "'KCl'"))
def toc_tables(spark, d):
    """The two tables that a run ends with: matched rows with their structure's file, where one landed, and the others."""
    landed_ids = spark.createDataFrame([("a1",), ("s2",), ("f1",), ("g2",), ("r1",)], "material_id string")
    matched, unmatched = toc.tables(_entries(spark, d), landed_ids)
    rows = outcomes.stack(matched.withColumn("put", F.lit("matched")), unmatched.withColumn("put", F.lit("unmatched")))
    named_ = {"Page number": "page", "Formula": "formula", "bare_formula": "bare", "phase_tag": "tag", "reduced_formula": "reduced", "match_method": "method", "cif_file": "file"}
    return rows.withColumnsRenamed(named_).groupBy(*named_.values(), "put").agg(F.count("*").alias("n"))
