"""Compositions: formulas parsed, reduced and compared as columns; names read and formulas repaired in Python, Arrow-batched."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements by atomic number.
SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba "
    "La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm"
).split()
# Pauling electronegativities, for the order in a reduced formula.
PAULING = {
    "H": 2.20, "Li": 0.98, "Be": 1.57, "B": 2.04, "C": 2.55, "N": 3.04, "O": 3.44, "F": 3.98, "Na": 0.93, "Mg": 1.31, "Al": 1.61, "Si": 1.90, "P": 2.19, "S": 2.58, "Cl": 3.16,
    "K": 0.82, "Ca": 1.00, "Sc": 1.36, "Ti": 1.54, "V": 1.63, "Cr": 1.66, "Mn": 1.55, "Fe": 1.83, "Co": 1.88, "Ni": 1.91, "Cu": 1.90, "Zn": 1.65, "Ga": 1.81, "Ge": 2.01, "As": 2.18, "Se": 2.55, "Br": 2.96, "Kr": 3.00,
    "Rb": 0.82, "Sr": 0.95, "Y": 1.22, "Zr": 1.33, "Nb": 1.6, "Mo": 2.16, "Tc": 1.9, "Ru": 2.2, "Rh": 2.28, "Pd": 2.20, "Ag": 1.93, "Cd": 1.69, "In": 1.78, "Sn": 1.96, "Sb": 2.05, "Te": 2.1, "I": 2.66, "Xe": 2.6,
    "Cs": 0.79, "Ba": 0.89, "La": 1.1, "Ce": 1.12, "Pr": 1.13, "Nd": 1.14, "Pm": 1.13, "Sm": 1.17, "Eu": 1.2, "Gd": 1.2, "Tb": 1.1, "Dy": 1.22, "Ho": 1.23, "Er": 1.24, "Tm": 1.25, "Yb": 1.1, "Lu": 1.27, "Hf": 1.3, "Ta": 1.5, "W": 2.36, "Re": 1.9, "Os": 2.2, "Ir": 2.2,
    "Pt": 2.28, "Au": 2.54, "Hg": 2.00, "Tl": 1.62, "Pb": 2.33, "Bi": 2.02, "Po": 2.0, "At": 2.2, "Ra": 0.9, "Ac": 1.1, "Th": 1.3, "Pa": 1.5, "U": 1.38, "Np": 1.36, "Pu": 1.28, "Am": 1.3, "Cm": 1.3,
}
# English names that a substance's name may begin a word with.
NAMES = {
    "HYDROGEN": "H", "HELIUM": "He", "LITHIUM": "Li", "BERYLLIUM": "Be", "BORON": "B", "CARBON": "C", "NITROGEN": "N", "OXYGEN": "O", "FLUORINE": "F", "NEON": "Ne", "SODIUM": "Na", "MAGNESIUM": "Mg",
    "ALUMINIUM": "Al", "ALUMINUM": "Al", "SILICON": "Si", "PHOSPHORUS": "P", "SULFUR": "S", "SULPHUR": "S", "CHLORINE": "Cl", "ARGON": "Ar", "POTASSIUM": "K", "CALCIUM": "Ca", "SCANDIUM": "Sc", "TITANIUM": "Ti",
    "VANADIUM": "V", "CHROMIUM": "Cr", "MANGANESE": "Mn", "IRON": "Fe", "COBALT": "Co", "NICKEL": "Ni", "COPPER": "Cu", "ZINC": "Zn", "GALLIUM": "Ga", "GERMANIUM": "Ge", "ARSENIC": "As", "SELENIUM": "Se",
    "BROMINE": "Br", "KRYPTON": "Kr", "RUBIDIUM": "Rb", "STRONTIUM": "Sr", "YTTRIUM": "Y", "ZIRCONIUM": "Zr", "NIOBIUM": "Nb", "MOLYBDENUM": "Mo", "TECHNETIUM": "Tc", "RUTHENIUM": "Ru", "RHODIUM": "Rh",
    "PALLADIUM": "Pd", "SILVER": "Ag", "CADMIUM": "Cd", "INDIUM": "In", "TIN": "Sn", "ANTIMONY": "Sb", "TELLURIUM": "Te", "IODINE": "I", "XENON": "Xe", "CESIUM": "Cs", "CAESIUM": "Cs", "BARIUM": "Ba",
    "LANTHANUM": "La", "CERIUM": "Ce", "PRASEODYMIUM": "Pr", "NEODYMIUM": "Nd", "SAMARIUM": "Sm", "EUROPIUM": "Eu", "GADOLINIUM": "Gd", "TERBIUM": "Tb", "DYSPROSIUM": "Dy", "HOLMIUM": "Ho", "ERBIUM": "Er",
    "THULIUM": "Tm", "YTTERBIUM": "Yb", "LUTETIUM": "Lu", "HAFNIUM": "Hf", "TANTALUM": "Ta", "TUNGSTEN": "W", "RHENIUM": "Re", "OSMIUM": "Os", "IRIDIUM": "Ir", "PLATINUM": "Pt", "GOLD": "Au", "MERCURY": "Hg",
    "THALLIUM": "Tl", "LEAD": "Pb", "BISMUTH": "Bi", "POLONIUM": "Po", "RADON": "Rn", "FRANCIUM": "Fr", "RADIUM": "Ra", "ACTINIUM": "Ac", "THORIUM": "Th", "PROTACTINIUM": "Pa", "URANIUM": "U",
    "NEPTUNIUM": "Np", "PLUTONIUM": "Pu", "AMERICIUM": "Am", "CURIUM": "Cm",
}
# Endings of compound classes in order of precedence, and the elements that they imply.
ENDINGS = {
    "OXIDE": {"O"}, "HYDROXIDE": {"O", "H"}, "PEROXIDE": {"O"}, "CARBONATE": {"C", "O"}, "CARBIDE": {"C"}, "CYANIDE": {"C", "N"}, "SULFATE": {"S", "O"}, "SULFITE": {"S", "O"}, "SULFIDE": {"S"},
    "NITRATE": {"N", "O"}, "NITRITE": {"N", "O"}, "NITRIDE": {"N"}, "PHOSPHATE": {"P", "O"}, "PHOSPHITE": {"P", "O"}, "PHOSPHIDE": {"P"}, "CHLORATE": {"Cl", "O"}, "PERCHLORATE": {"Cl", "O"},
    "CHLORIDE": {"Cl"}, "CHLORITE": {"Cl", "O"}, "BROMATE": {"Br", "O"}, "BROMIDE": {"Br"}, "IODATE": {"I", "O"}, "IODIDE": {"I"}, "FLUORIDE": {"F"}, "SELENATE": {"Se", "O"}, "SELENITE": {"Se", "O"},
    "SELENIDE": {"Se"}, "TELLURATE": {"Te", "O"}, "TELLURIDE": {"Te"}, "ARSENATE": {"As", "O"}, "ARSENIDE": {"As"}, "ANTIMONATE": {"Sb", "O"}, "ANTIMONIDE": {"Sb"}, "BORATE": {"B", "O"}, "BORIDE": {"B"},
    "SILICATE": {"Si", "O"}, "SILICIDE": {"Si"}, "CHROMATE": {"Cr", "O"}, "VANADATE": {"V", "O"}, "MOLYBDATE": {"Mo", "O"}, "TUNGSTATE": {"W", "O"}, "TITANATE": {"Ti", "O"}, "ALUMINATE": {"Al", "O"},
    "STANNATE": {"Sn", "O"}, "PLUMBATE": {"Pb", "O"}, "FERRATE": {"Fe", "O"}, "MANGANATE": {"Mn", "O"}, "ZIRCONATE": {"Zr", "O"}, "NIOBATE": {"Nb", "O"}, "URANATE": {"U", "O"},
}
# Prefixes of halide complexes, elements of organic substances, and last digits that stand for letters.
HALIDES = ("FLUORO", "CHLORO", "BROMO", "IODO")
ORGANIC = ("C", "H", "N", "O", "S", "P", "F", "Cl", "Br", "I")
TRAILING = {"0": "O", "8": "S", "1": "I", "5": "S"}

# Gases that exist in pairs, and peroxides, named by their whole molecule.
DIATOMIC = ("H", "N", "O", "F", "Cl")
PEROXIDES = {"LiO": "Li2O2", "NaO": "Na2O2", "KO": "K2O2", "HO": "H2O2", "CsO": "Cs2O2", "RbO": "Rb2O2"}

_TOKEN = re.compile(r"([A-Z][a-z]?)(\d+\.?\d*|\.\d+)?|(\()|\)(\d+\.?\d*|\.\d+)?")
_LEAD = re.compile(r"(\d+)/(\d+)(?=[A-Za-z(])|(\d+\.?\d*)(?=[A-Za-z(])")
_KNOWN = frozenset(SYMBOLS)
Composition = dict[str, float]


def parse(formula: str | None) -> Composition | None:
    """Element amounts of a formula with groups, '*' adducts and leading multipliers; null if it can't be read."""
    if not formula:
        return None
    total: Composition = {}
    for part in formula.split("*"):
        times, at = 1.0, 0
        if lead := _LEAD.match(part):
            if lead[2] and not int(lead[2]):
                return None
            times, at = (int(lead[1]) / int(lead[2]) if lead[2] else float(lead[3])), lead.end()
        stack: list[Composition] = [{}]
        while at < len(part):
            m = _TOKEN.match(part, at)
            if not m:
                return None
            at = m.end()
            if m[1]:
                if m[1] not in _KNOWN and m[1][0] in _KNOWN and len(m[1]) == 2:
                    return None
                if m[1] not in _KNOWN:
                    return None
                stack[-1][m[1]] = stack[-1].get(m[1], 0.0) + float(m[2] or 1)
            elif m[3]:
                stack.append({})
            else:
                if len(stack) == 1:
                    return None
                inner = stack.pop()
                for k, v in inner.items():
                    stack[-1][k] = stack[-1].get(k, 0.0) + v * float(m[4] or 1)
        if len(stack) > 1 or not stack[0]:
            return None
        for k, v in stack[0].items():
            total[k] = total.get(k, 0.0) + v * times
    return {k: v for k, v in total.items() if v} or None


def rationalise(comp: Composition, most: int = 20) -> dict[str, int]:
    """Nearest whole-number ratio, each amount a fraction with a denominator up to ``most``."""
    near = {k: Fraction(v).limit_denominator(most) for k, v in comp.items()}
    scale = math.lcm(*(f.denominator for f in near.values()))
    whole = {k: int(f * scale) for k, f in near.items()}
    shared = math.gcd(*whole.values()) or 1
    return {k: v // shared for k, v in whole.items()}


def reduced_formula(comp: Composition | None) -> str | None:
    """Canonical text: smallest whole numbers, least electronegative first; equal ends grouped; known exceptions."""
    if not comp:
        return None
    whole = rationalise(comp)
    order = sorted(whole, key=lambda k: (PAULING.get(k, 9.9), k))
    text = lambda names, by=1: "".join(k + (str(whole[k] // by) if whole[k] // by != 1 else "") for k in names)
    if len(order) == 1:
        return order[0] + ("2" if order[0] in DIATOMIC else "")
    out = text(order)
    if len(order) > 2:
        a, b = order[-2:]
        shared = math.gcd(whole[a], whole[b])
        if PAULING.get(b, 9.9) - PAULING.get(a, 9.9) < 1.65 and shared > 1:
            out = f"{text(order[:-2])}({text((a, b), shared)}){shared}"
    return PEROXIDES.get(out, out)


def implied(name: str | None) -> frozenset[str]:
    """Elements that a name claims: element names that begin a word, and the first ending that a word has."""
    upper = str(name or "").upper()
    found = {symbol for long, symbol in NAMES.items() if re.search(rf"\b{long}", upper)}
    for word in re.findall("[A-Z]+", upper):
        ending = next(((e, x) for e, x in ENDINGS.items() if word.endswith(e)), None)
        if ending:
            complex_ = ending[0].endswith(("ATE", "ITE")) and word[: -len(ending[0])].endswith(HALIDES)
            found |= ending[1] - ({"O"} if complex_ else set())
    return frozenset(found)


def _runs(formula: str) -> list[int]:
    return [m.start() + (len(m[0]) == 3) for m in re.finditer(r"\d+", formula) if len(m[0]) in (2, 3)]


def _same(a: Composition, b: Composition, but: set[str]) -> bool:
    return all(abs(a.get(k, 0) - b.get(k, 0)) < 1e-6 for k in (a.keys() | b.keys()) - but)


def _edits(kind: str, formula: str, have: set[str], need: frozenset[str]) -> Iterator[tuple[str, set[str] | None]]:
    """(edited formula, elements that the edit may change) in the order in which they are tried."""
    missing, extra = sorted(need - have), sorted(have - need)
    single = {x for x in extra if len(x) == 1}
    for new in missing:
        if kind == "hidden":
            yield from ((formula[:i] + new + formula[i + 1 :], None) for i in _runs(formula))
        elif kind == "swap":
            yield from ((formula.replace(old, new, 1), {old, new}) for old in extra if len(old) == len(new) and old in formula)
        elif kind == "merge" and len(new) == 2:
            yield from ((formula[:i] + new + formula[i + 2 :], {*formula[i : i + 2], new}) for i in range(len(formula) - 1) if set(formula[i : i + 2]) <= single)
        elif kind == "extend" and len(new) == 2:
            yield from ((formula.replace(old, new, 1), {old, new}) for old in extra if old == new[0] and old in formula)


def repair(formula: str, name: str | None) -> str:
    """A formula made to agree with its name: the first edit of each kind, in order, that explains every element."""
    need = implied(name)
    if parse(formula) is None and re.match(r"\d[a-z]", formula):
        tries = (x + formula[2:] for x in sorted(need) if len(x) == 2 and x[1] == formula[1])
        formula = next((t for t in tries if parse(t)), formula)
    for kind in ("hidden", "swap", "merge", "extend"):
        comp = parse(formula)
        if comp is None:
            break
        for tried, free in _edits(kind, formula, set(comp), need):
            made = parse(tried)
            if made and need <= made.keys() and (free is None or _same(comp, made, free)):
                formula = tried
                break
    comp = parse(formula)
    if comp is not None and len(comp) <= 1 and len(formula) > 4 and formula[-1] in TRAILING:
        tried = formula[:-1] + TRAILING[formula[-1]]
        if len(parse(tried) or ()) > 1:
            return tried
    return formula


def _batched(kind: str, f: Callable) -> Callable[..., Column]:
    @F.pandas_udf(kind)
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([f(*(None if x is pd.NA or isinstance(x, float) else x for x in row)) for row in zip(*cols, strict=True)], dtype=object)

    return run


_AMOUNT = r"(?:\d+\.?\d*|\.\d+)"
_MAP, _STACK = "map<string,double>", "struct<ok:boolean,stack:array<map<string,double>>>"


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _sum(a: Column, b: Column, times: Column) -> Column:
    """a + times * b."""
    return F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0)) * times)


def _adduct(part: Column) -> Column:
    """Amounts of one part of a formula, its multiplier applied; null if it can't be read.

    A fold over the part's tokens with a stack of compositions, one for each open group, in an array.
    """
    lead = F.regexp_extract(part, rf"^(?:\d+/\d+|\d+\.?\d*)(?=[A-Za-z(])", 0)
    over = F.split(lead, "/")
    times = F.when(lead == "", 1.0).when(F.size(over) > 1, F.try_divide(F.get(over, F.lit(0)).try_cast("double"), F.get(over, F.lit(1)).try_cast("double"))).otherwise(lead.try_cast("double"))
    body = F.substr(part, F.length(lead) + 1, F.length(part))
    token = rf"[A-Z][a-z]?{_AMOUNT}?|\(|\){_AMOUNT}?"
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    begin = F.struct(F.lit(True).alias("ok"), F.array(empty).alias("stack")).cast(_STACK)

    def step(acc: Column, found: Column) -> Column:
        stack, symbol = acc["stack"], F.regexp_extract(found, "^[A-Z][a-z]?", 0)
        amount = F.coalesce(F.nullif(F.regexp_extract(found, r"[\d.]+$", 0), F.lit("")).try_cast("double"), F.lit(1.0))
        depth, top = F.size(stack), F.element_at(stack, -1)
        under = lambda n: F.slice(stack, F.lit(1), F.greatest(depth - n, F.lit(0)))
        element = F.concat(under(1), F.array(_sum(top, F.create_map(symbol, amount), F.lit(1.0))))
        closed = F.concat(under(2), F.array(_sum(F.get(stack, depth - 2), top, amount)))
        ok = acc["ok"] & ((depth > 1) | ~found.startswith(")")) & ((symbol == "") | symbol.isin(*SYMBOLS))
        after = F.when(~ok, stack).when(symbol != "", element).when(found == "(", F.concat(stack, F.array(empty))).otherwise(closed)
        return F.struct(ok.alias("ok"), after.alias("stack")).cast(_STACK)

    held = F.aggregate(F.regexp_extract_all(body, F.lit(token), F.lit(0)), begin, step)
    done = lambda x: F.when(x["ok"] & (F.size(x["stack"]) == 1) & (F.size(F.get(x["stack"], F.lit(0))) > 0), F.transform_values(F.get(x["stack"], F.lit(0)), lambda _, v: v * times))
    return F.when(body.rlike(f"^(?:{token})+$"), _once(held, done)).cast(_MAP)


def parse_column(formula: Column) -> Column:
    """MAP<STRING, DOUBLE> of a formula column, as ``parse`` has it, in the JVM."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))

    def total(parts: Column) -> Column:
        added = F.aggregate(parts, empty.cast(_MAP), lambda a, p: _sum(a, p, F.lit(1.0)).cast(_MAP))
        some = _once(added, lambda m: F.map_filter(m, lambda _, v: v != 0))
        return F.when(~F.exists(parts, lambda p: p.isNull()), _once(some, lambda m: F.when(F.size(m) > 0, m)))

    return F.when(F.length(formula) > 0, _once(F.transform(F.split(formula, r"\*", -1), _adduct), total))


def repair_column(formula: Column, name: Column) -> Column:
    return _batched("string", lambda f, n: None if f is None else repair(f, n))(formula, name)


def _gcd(a: Column, b: Column) -> Column:
    pair = lambda x, y: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    # Two steps at least halve a number: these are enough for any 64 bits.
    return F.aggregate(F.sequence(F.lit(1), F.lit(92)), pair(a, b), lambda s, _: F.when(s["y"] == 0, s).otherwise(pair(s["y"], F.try_mod(s["x"], s["y"]))), lambda s: s["x"])


def rationalised(comp: Column, most: int = 20) -> Column:
    """``rationalise`` as a column: an array of (key, value) in the composition's order, values whole and without a common divisor."""
    near = lambda v: F.array_min(F.transform(F.sequence(F.lit(1), F.lit(most)), lambda q: F.struct(F.abs(v - F.rint(v * q) / q).alias("off"), q.cast("long").alias("q"), F.rint(v * q).cast("long").alias("p"))))
    ratios = F.transform(F.map_entries(comp), lambda x: F.struct(x["key"].alias("key"), near(x["value"]).alias("r")))

    def whole(found: Column) -> Column:
        scale = F.aggregate(found, F.lit(1).cast("long"), lambda a, x: (a / _gcd(a, x["r"]["q"])).cast("long") * x["r"]["q"])
        return F.transform(found, lambda x: F.struct(x["key"].alias("key"), (x["r"]["p"] * (scale / x["r"]["q"]).cast("long")).alias("value")))

    def least(found: Column) -> Column:
        shared = F.aggregate(found, F.lit(0).cast("long"), lambda a, x: _gcd(x["value"], a))
        return _once(shared, lambda n: F.transform(found, lambda x: F.struct(x["key"].alias("key"), (x["value"] / F.greatest(n, F.lit(1))).cast("long").alias("value"))))

    return _once(_once(ratios, whole), least)


def reduced_of(comp: Column) -> Column:
    """``reduced_formula`` of a composition column, in the JVM."""
    weights = F.create_map(*[F.lit(x) for pair in PAULING.items() for x in pair])
    ranked = lambda w: F.array_sort(F.transform(w, lambda x: F.struct(F.coalesce(F.try_element_at(weights, x["key"]), F.lit(9.9)).alias("en"), x["key"].alias("key"), x["value"].alias("n"))))
    count = lambda n: F.when(n == 1, "").otherwise(n.cast("string"))
    text = lambda names, by=F.lit(1): F.array_join(F.transform(names, lambda x: F.concat(x["key"], count((x["n"] / by).cast("long")))), "")

    def named(order: Column) -> Column:
        size = F.size(order)
        ends = F.slice(order, F.greatest(size - 1, F.lit(1)), F.lit(2))
        a, b = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
        grouped = lambda n: F.when((size > 2) & (b["en"] - a["en"] < 1.65) & (n > 1), F.concat(text(F.slice(order, F.lit(1), F.greatest(size - 2, F.lit(0)))), F.lit("("), text(ends, n), F.lit(")"), n.cast("string"))).otherwise(text(order))
        pairs = F.when(a["key"].isin(*DIATOMIC), F.concat(a["key"], F.lit("2"))).otherwise(a["key"])
        return F.when(size == 1, pairs).otherwise(_once(_gcd(a["n"], F.coalesce(b["n"], F.lit(0))), grouped))

    peroxides = F.create_map(*[F.lit(x) for pair in PEROXIDES.items() for x in pair])
    out = _once(_once(rationalised(comp), ranked), named)
    return F.when(F.size(comp) > 0, _once(out, lambda t: F.coalesce(F.try_element_at(peroxides, t), t)))


def reduced_column(formula: Column) -> Column:
    return reduced_of(parse_column(formula))


def parse_spaced(text: Column) -> Column:
    """MAP of a spaced listing such as '- Al2 O5 Si -'; amounts default to 1."""
    tokens = F.regexp_extract_all(F.translate(text, "-", " "), F.lit(r"[A-Z][a-z]?\s*(?:\d+\.?\d*|\.\d+)?"), F.lit(0))
    amount = lambda t: F.coalesce(F.nullif(F.regexp_extract(t, r"([\d.]+)", 1), F.lit("")).cast("double"), F.lit(1.0))
    entries = F.transform(tokens, lambda t: F.struct(F.regexp_extract(t, r"([A-Z][a-z]?)", 1).alias("key"), amount(t).alias("value")))
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def element_key(comp: Column) -> Column:
    """One text per element set."""
    return F.array_join(F.array_sort(F.map_keys(comp)), "-")


def is_organic(comp: Column) -> Column:
    keys = F.map_keys(comp)
    return F.array_contains(keys, "C") & F.array_contains(keys, "H") & (F.size(F.array_except(keys, F.array(*map(F.lit, ORGANIC)))) == 0)


def is_nonstoichiometric(comp: Column) -> Column:
    return F.exists(F.map_values(comp), lambda v: F.abs(v - F.rint(v)) > 1e-6)


def fractions(comp: Column) -> Column:
    total = F.aggregate(F.map_values(comp), F.lit(0.0), lambda a, v: a + v)
    return F.transform_values(comp, lambda k, v: v / total)


def shares(comp: Column) -> Column:
    """Fractions in the order of the elements' symbols; null if there are none."""
    total = F.aggregate(F.map_values(comp), F.lit(0.0), lambda a, v: a + v)
    found = F.transform(F.array_sort(F.map_keys(comp)), lambda k: F.try_divide(F.element_at(comp, k), total))
    return F.when(~F.exists(found, lambda x: x.isNull()), found)


def ratio_error(target: Column, other: Column) -> Column:
    """Largest difference of fractions; null if the element sets differ."""
    a, b = fractions(target), fractions(other)
    return F.when(element_key(target) == element_key(other), F.array_max(F.transform(F.map_keys(a), lambda k: F.abs(F.element_at(a, k) - F.element_at(b, k)))))


def whole_multiple(target: Column, other: Column, tolerance: float = 1e-2) -> Column:
    """Is one composition a whole multiple of the other? Null compositions pass."""
    ratios = F.transform(F.map_keys(target), lambda k: F.try_element_at(other, k) / F.element_at(target, k))
    k = F.greatest(F.rint(F.get(ratios, F.lit(0))), F.lit(1.0))
    same = element_key(target) == element_key(other)
    return F.coalesce(same & F.forall(ratios, lambda r: F.abs(r - k) <= tolerance), target.isNull() | other.isNull())


def ratio_close(target: Column, other: Column, tolerance: float = 0.05) -> Column:
    """Do all amounts, relative to the target's first element, agree? Null compositions pass."""
    first = F.get(F.map_keys(target), F.lit(0))
    off = F.transform(F.map_keys(target), lambda k: F.abs(F.element_at(target, k) / F.element_at(target, first) - F.try_element_at(other, k) / F.try_element_at(other, first)))
    return F.coalesce((element_key(target) == element_key(other)) & F.forall(off, lambda x: x <= tolerance), target.isNull() | other.isNull())


def add(a: Column, b: Column) -> Column:
    """Sum of two compositions."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0)))
