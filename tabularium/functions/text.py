"""Text repair and matching as Column functions: regular expressions, translation and higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label of a temperature column, and a number with a point. The characters and patterns inside
# ``page_repair``, ``row_repair``, ``phase_token`` and ``match_key`` below are fixed values too.
TEMP_LABEL = r"^[\[{(]+[kK]+[\]})]+$"
NUMBER = r"-?\d+\.\d+"


def closest_match(text: Column, candidates: Column) -> Column:
    """The first of an array of candidates at the least edit distance."""
    ranked = F.transform(candidates, lambda c, i: F.struct(F.levenshtein(text, c).alias("d"), i.alias("i"), c.alias("c")))
    return F.array_min(ranked)["c"]


def fuzzy_find(needle: Column, hay: Column, most: int) -> Column:
    """0-based start of the first part of ``hay`` within ``most`` edits of ``needle``: shorter parts first, then
    earlier ones; -1 if there is none or the needle is empty.

    Cut into one piece more than edits, a near needle leaves a piece whole: texts without one are not searched.
    """
    if most == 0:
        return F.when(F.length(needle) > 0, F.instr(hay, needle) - 1).otherwise(F.lit(-1))
    sizes = F.sequence(F.greatest(F.length(needle) - most, F.lit(1)), F.length(needle) + most)
    fits = F.filter(sizes, lambda n: n <= F.length(hay))
    starts = F.flatten(F.transform(fits, lambda n: F.transform(F.sequence(F.lit(0), F.length(hay) - n), lambda s: F.struct(n.alias("n"), s.alias("s")))))
    near = F.filter(starts, lambda x: F.levenshtein(F.substring(hay, x["s"] + 1, x["n"]), needle) <= most)
    cut = lambda i: F.floor(F.length(needle) * i / (most + 1)).cast("int")
    whole = F.lit(False)
    for i in range(most + 1):
        whole |= hay.contains(F.substr(needle, cut(i) + 1, cut(i + 1) - cut(i)))
    return F.when((F.length(needle) > 0) & whole, F.coalesce(F.get(near, F.lit(0))["s"], F.lit(-1))).otherwise(F.lit(-1))


def zero_to_letter(formula: Column) -> Column:
    """A zero before a digit is the letter O, unless it stands in a decimal number."""
    runs = F.regexp_extract_all(formula, F.lit(r"(\d+\.\d+|\D+|\d+)"), F.lit(1))
    outside = lambda p: F.when(p.rlike(r"^\d+\.\d+$"), p).otherwise(F.regexp_replace(p, r"0(?=\d)", "O"))
    return F.array_join(F.transform(runs, outside), "")


def page_repair(text: Column) -> Column:
    """Rejoin numbers split after a point or a dash, and part a dash from the digit before it."""
    text = F.regexp_replace(text, r"(?<=\.)\s+(?=\d)", "")
    text = F.regexp_replace(text, r"(?<=[-—~])\s+(?=\d)", "")
    return F.regexp_replace(text, r"(?<=\d)([-—~])", " $1")


def missing_decimal(token: Column, first: Column) -> Column:
    """Four to seven bare digits lost their point: two places from the right in the first column, else three."""
    places = F.when(first, F.lit(2)).otherwise(F.lit(3))
    cut = F.length(token) - places
    return F.when(token.rlike(r"^-?\d{4,7}$"), F.concat(F.substr(token, F.lit(1), cut), F.lit("."), F.substr(token, cut + 1, places))).otherwise(token)


def _exchange(text: Column, old: str, new: str) -> Column:
    """``F.translate`` for a few characters of which none in ``new`` is in ``old``: a search for each takes less than a look-up of all."""
    for a, b in zip(old, new, strict=True):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def row_repair(line: Column) -> Column:
    """A table row's usual misreadings: letters for digits, dashes, commas, split and glued numbers."""
    tokens = F.filter(F.split(F.trim(line), r"\s+"), lambda t: t != "")
    line = F.when(line.rlike(r"^\s|\s\z|\s\s|[^\S ]"), F.array_join(tokens, " ")).otherwise(line)
    # As ``missing_decimal`` does for a token: in the first column two places, else three.
    line = F.regexp_replace(line, r"^(-?\d{2,5})(\d{2})(?!\S)", "$1.$2")
    line = F.regexp_replace(line, r"(?<= )(-?\d{1,4})(\d{3})(?!\S)", "$1.$2")
    line = _exchange(line, "§BSOl—–−~_,", "58501-----.")
    line = F.regexp_replace(line, r"(?<=[.-])\s+(?=\d)", "")
    return F.regexp_replace(line, r"(?<=\d)-", " -")


def numbers(line: Column) -> Column:
    """All decimal numbers of a line."""
    return F.transform(F.regexp_extract_all(line, F.lit(NUMBER), F.lit(0)), lambda x: x.cast("double"))


def phase_token(token: Column) -> Column:
    """A phase name's first token: marks read for S, and a capital, digits and a final l read for digits and 1.

    As in the original's results, a 1 is put for the l, after the digits that are there.
    """
    token = F.translate(token, "§$", "SS")
    return F.when(token.rlike(r"[A-Z]\d+l$"), F.concat(F.substr(token, F.lit(1), F.length(token) - 1), F.lit("1"))).otherwise(token)


def strip_first(line: Column, token: Column) -> Column:
    """What follows the first occurrence of a token."""
    return F.substr(line, F.instr(line, token) + F.length(token), F.length(line))


def match_key(text: Column) -> Column:
    """One spelling for page matching: letters, digits and brackets only, in capitals, O as 0, L as I."""
    text = F.upper(F.regexp_replace(_exchange(text, "{}", "[]"), r"[^A-Za-z0-9\[\]]+", ""))
    return _exchange(F.regexp_replace(text, r"(?<=\[)\[+|(?<=\])\]+", ""), "OL", "0I")


def looks_like_tag(text: Column) -> Column:
    return text.rlike(r"^\[[A-Za-z0-9,]{1,6}\]")


def page_contains(window: Column, formula: Column, name: Column) -> Column:
    """Does a header window name the substance? Only the formula's first hit counts, and not if a tag follows it,
    unless the formula is tagged itself; else the name decides."""
    hay, f, n = match_key(window), match_key(formula), match_key(name)
    at = F.when(F.length(f) > 0, F.instr(hay, f)).otherwise(F.lit(0))
    after = F.substr(hay, at + F.length(f), F.lit(8))
    return ((at > 0) & (f.contains("[") | ~looks_like_tag(after))) | ((F.length(n) > 0) & hay.contains(n))


def strip_tag(formula: Column) -> tuple[Column, Column]:
    """(bare formula, tag); the tag is null where there is none and may be empty."""
    tagged = formula.rlike(r"\[[^\]]*\]$")
    return F.regexp_replace(formula, r"\[[^\]]*\]$", ""), F.when(tagged, F.regexp_extract(formula, r"\[([^\]]*)\]$", 1))


def strip_all_tags(formula: Column) -> Column:
    return F.regexp_replace(formula, r"(\[[^\]]*\])+$", "")


def fix_letters(formula: Column) -> Column:
    """A small l that no two-letter symbol can end with is a capital I, and the reverse after A and C."""
    out = F.regexp_replace(formula, r"(?<![ACT])l", "I")
    return F.replace(F.replace(out, F.lit("AI"), F.lit("Al")), F.lit("CI"), F.lit("Cl"))


def fix_water(formula: Column) -> Column:
    """In every part after the first '*', a final H20 is water."""
    return F.array_join(F.transform(F.split(formula, r"\*"), lambda p, i: F.when(i > 0, F.regexp_replace(p, "H20$", "H2O")).otherwise(p)), "*")


def file_stem(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9_.()\[\]*-]", "_")


def json_stem(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}_\-.\[\]*]", "")


def digit_run_positions(text: Column) -> Column:
    """0-based places where a letter may hide in a digit run: the first of two digits, the middle of three."""
    places = F.transform(F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0))), lambda i: i)
    rest = lambda i, n: F.substr(text, i + 1, F.lit(n))
    before = lambda i, n: F.when(i >= n, F.substr(text, i - n + 1, F.lit(n))).otherwise(F.lit(""))
    two = lambda i: rest(i, 3).rlike(r"^\d\d(\D|$)") & ~before(i, 1).rlike(r"\d")
    three = lambda i: before(i, 1).rlike(r"\d") & ~before(i, 2).rlike(r"\d\d") & rest(i, 3).rlike(r"^\d\d(\D|$)")
    return F.filter(places, lambda i: two(i) | three(i))


def snap_digit(old: Column, estimate: Column, tolerance: float = 0.1, fallback: bool = True) -> Column:
    """The single-digit change of ``old`` (three decimals) that comes strictly nearest to the estimate within the
    tolerance, the earliest on ties; else the rounded estimate, or null without fallback."""
    digits = F.sequence(F.lit(0), F.lit(9))

    def best(text: Column) -> Column:
        dot, value = F.instr(text, "."), text.cast("double")
        sign = F.when(text.startswith("-"), -1.0).otherwise(1.0)
        # A digit's change moves the value by whole places: no candidate's text need be made.
        place = lambda i: F.pow(F.lit(10.0), dot - i - F.when(i < dot, 1).otherwise(0))
        spots = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.struct(i.alias("i"), (F.ascii(F.substr(text, i, F.lit(1))) - 48).alias("digit"), (sign * place(i)).alias("place")))
        spots = F.filter(spots, lambda x: x["digit"].between(0, 9))

        def changed(x: Column, d: Column) -> Column:
            made = value + (d - x["digit"]) * x["place"]
            off = F.floor(F.abs(made - estimate) * 1e9 + 0.5) / 1e9
            return F.struct(off.alias("off"), x["i"].alias("i"), d.alias("d"), made.alias("v"))

        near = lambda x, d: (d != x["digit"]) & (F.abs(value + (d - x["digit"]) * x["place"] - estimate) < tolerance + 1e-6)
        every = F.flatten(F.transform(spots, lambda x: F.transform(F.filter(digits, lambda d: near(x, d)), lambda d: changed(x, d))))
        return F.array_min(F.filter(every, lambda c: c["off"] < tolerance))["v"]

    found = F.get(F.transform(F.array(F.format_string("%.3f", old)), best), F.lit(0))
    return F.coalesce(F.round(found, 3), F.round(estimate, 3) if fallback else F.lit(None).cast("double"))
