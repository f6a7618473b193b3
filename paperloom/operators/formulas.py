"""Formulas: stated results, sign variants, LaTeX balance, table shapes, forms that mean the same, and what a second reading missed."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .. import fixed
from ..functions import text as T
from ..functions.arrays import following, let

# How numbers, powers of ten and results are written.
_NUMBER = r"(-?\d+(?:[.,]\d+)?)"
_POWER = r"(?:\s*(?:\\times|×|\.)\s*10\^\{?(-?\d+)\}?)?"
_GIVES = r"\s*(?:=|\\simeq|\\approx|≈|≃)\s*"
_TIMES = r"\s*(?:\\times|×)\s*"
_VALUE = _NUMBER + _POWER
_FORMS = {
    "fraction": r"\\frac\{\s*" + _VALUE + r"\s*(?:\\times|×)?\s*" + _NUMBER + "?" + _POWER + r"\s*\}\{\s*" + _VALUE + r"\s*\}" + _GIVES + _VALUE,
    "product": _VALUE + r"\s*(?:\\times|×|\*)\s*" + _VALUE + _GIVES + _VALUE,
    "quotient": _VALUE + r"\s*[/÷]\s*" + _VALUE + _GIVES + _VALUE,
    "root": r"\\sqrt\{\s*" + _VALUE + r"\s*\}" + _GIVES + _VALUE,
}
#: Relative difference up to which a stated result counts as rounded, and the size that a stated 0 may have.
TOLERANCE, ZERO = 0.03, 1e-9


def _amount(x: Column, form: str, group: int) -> Column:
    """A number with its power of ten; null where the form has none there."""
    field = lambda k: F.nullif(F.regexp_extract(x, form, k), F.lit(""))
    base, power = F.replace(field(group), F.lit(","), F.lit(".")).try_cast("double"), field(group + 1).try_cast("double")
    return base * F.pow(F.lit(10.0), F.coalesce(power, F.lit(0.0)))


def rounded_to(computed: Column, stated: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether a stated result may be the computed one rounded: within the tolerance, or half a unit of its third figure."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.nullif(F.abs(stated), F.lit(0.0)))) - 2)
    near = (F.abs(computed - stated) <= tolerance * F.abs(stated)) | (F.abs(computed - stated) <= 0.5 * unit)
    return F.when(stated == 0, F.abs(computed) < ZERO).otherwise(near)


def slips(text: Column, tolerance: float = TOLERANCE) -> Column:
    """Array of (kind, expr, computed, stated) of the fractions, products, quotients and roots in a text whose stated result is off; what
    can't be computed is no slip."""
    return F.concat(*(_off(text, kind, form, tolerance) for kind, form in _FORMS.items()))


def _off(text: Column, kind: str, form: str, tolerance: float) -> Column:
    amount = lambda x, k: _amount(x, form, k)
    computed, last = {
        "fraction": (lambda x: F.try_divide(amount(x, 1) * F.coalesce(amount(x, 3), F.lit(1.0)), amount(x, 5)), 7),
        "product": (lambda x: amount(x, 1) * amount(x, 3), 5),
        "quotient": (lambda x: F.try_divide(amount(x, 1), amount(x, 3)), 5),
        "root": (lambda x: F.when(amount(x, 1) >= 0, F.sqrt(amount(x, 1))), 3),
    }[kind]
    found = F.regexp_extract_all(text, F.lit(f"({form})"), F.lit(1))
    each = F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("expr"), computed(x).alias("computed"), amount(x, last).alias("stated")))
    return F.filter(each, lambda s: F.coalesce(~rounded_to(s["computed"], s["stated"], tolerance), F.lit(False)))


def inline(text: Column) -> Column:
    """Distinct formulas between dollars that state an equality, without blanks and layout."""
    bare = lambda x: reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), (("\\left", ""), ("\\right", ""), ("\\dfrac", "\\frac"), ("\\displaystyle", "")), F.regexp_replace(x, r"(?U)\s+", ""))
    found = F.regexp_extract_all(text, F.lit(r"\$([^$]{6,120})\$"), F.lit(1))
    return F.array_distinct(F.transform(F.filter(found, lambda x: F.contains(x, F.lit("="))), bare))


#: What is left out of two formulas before they are compared.
_SIGNS, _EXPONENTS = "[-+]", r"\^\{[^}]*\}|\^."


def sign_variants(left: DataFrame, right: DataFrame, unit: str, formula: str, least: int = 12) -> DataFrame:
    """(unit, left, right, differs_in): formulas of a unit that the right side doesn't have, and that differ from one of it in signs, or else in
    exponents only. Shorter ones don't count."""
    plain = lambda df, name: df.filter(F.col(formula).isNotNull()).select(unit, F.col(formula).alias(name)).distinct()
    ours = plain(left, "left").filter(F.length("left") >= least).join(plain(right, "left"), [unit, "left"], "left_anti")
    theirs = plain(right, "right")
    key = lambda c, out: F.regexp_replace(c, out, "")
    by_sign = ours.withColumn("_k", key("left", _SIGNS)).join(theirs.withColumn("_k", key("right", _SIGNS)), [unit, "_k"]).select(unit, "left", "right", F.lit("sign").alias("differs_in"))
    by_power = ours.withColumn("_k", key("left", _EXPONENTS)).join(theirs.withColumn("_k", key("right", _EXPONENTS)), [unit, "_k"])
    by_power = by_power.filter(key("left", _SIGNS) != key("right", _SIGNS)).select(unit, "left", "right", F.lit("exponent").alias("differs_in"))
    return by_sign.unionByName(by_power)


def latex_counts(text: Column) -> dict[str, Column]:
    """odd_dollars (double ones aside), brace_gap (open minus closed), bare_fractions (no argument after them), dangling (whether a
    ^ or _ is followed by nothing up to a dollar, a line's end or the text's)."""
    count = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    single = F.replace(text, F.lit("$$"), F.lit(""))
    return {
        "odd_dollars": count(single, "$") % 2 == 1,
        "brace_gap": count(text, "{") - count(text, "}"),
        "bare_fractions": F.regexp_count(text, F.lit(r"\\frac(?!\{)")),
        "dangling": text.rlike(r"[\^_](?U:\s*)(?:\$|\n|$)"),
    }


def latex_issues(text: Column, subject: Column) -> Column:
    """Names of what is wrong with a page's LaTeX; braces and exponents count in science only."""
    c = latex_counts(text)
    science = subject.isin(*fixed.SCIENCE) & F.contains(text, F.lit("\\"))
    checks = ((c["odd_dollars"], "odd_dollars"), (science & (F.abs(c["brace_gap"]) > 2), "braces"), (science & (c["bare_fractions"] > 0), "bare_fraction"), (science & c["dangling"], "dangling"))
    return F.array_compact(F.array(*(F.when(x, name) for x, name in checks)))


def uneven_table(text: Column, separator: str = "|", least: int = 3) -> Column:
    """(n_rows, n_off) of a page whose table rows, the lines that begin and end with the separator, too often have another number of separators
    than most: more than one and more than a third; null for other pages. In the page's own row, without a shuffle."""
    framed = lambda x: let(T.strip(x), lambda t: t.startswith(separator) & t.endswith(separator))
    shape = F.transform(F.filter(T.all_lines(text), framed), lambda x: F.length(x) - F.length(F.replace(x, F.lit(separator), F.lit(""))))

    def judged(shapes: Column) -> Column:
        n = F.size(shapes)
        first = F.filter(F.transform(shapes, lambda x, i: F.when((i == 0) | (x != F.get(shapes, F.greatest(i - 1, F.lit(0)))), i)), lambda i: i.isNotNull())
        most = F.array_max(F.transform(following(first), lambda p: F.coalesce(p["next"], n) - p["x"]))
        return let(most, lambda m: F.when((n >= least) & (n - m > F.greatest(F.lit(1), F.floor(n / 3))), F.struct(n.alias("n_rows"), (n - m).alias("n_off"))))

    return let(F.array_sort(shape), judged)  # equal ones are neighbours


def canonical(formula: Column) -> Column:
    """One form of formulas that mean the same: without dollars, layout and blanks, one sign for products, equalities and minus, decimal points, no
    braces around single characters."""
    bare = F.regexp_replace(T.strip(formula), r"^\$+|\$+$", "")
    bare = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), fixed.FORMULA_FORMS, T.strip(bare))
    return F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+", ""), r"\{([^{}])\}", "$1")


@F.pandas_udf(DoubleType())
def _likeness(items: pd.Series, forms: pd.Series) -> pd.Series:
    """The largest matching-blocks ratio of an item with any form; there is no JVM function for it."""
    best = lambda a, many: max((difflib.SequenceMatcher(None, a, b).ratio() for b in many), default=0.0)
    return pd.Series([0.0 if a is None or many is None else best(a, many) for a, many in zip(items, forms)])


def matched(item: Column, page: Column, least: float = 0.92) -> Column:
    """Whether a formula of a second reading is on a page: as it is, in or around one of the page's formulas, by its numbers if it is hardly
    more than those, or nearly as one of the page's."""
    one, whole = canonical(item), canonical(page)
    forms = F.transform(F.regexp_extract_all(page, F.lit(r"\$\$?([^$]{1,300})\$\$?"), F.lit(1)), canonical)
    around = F.exists(forms, lambda f: F.contains(f, one) | (F.contains(one, f) & (F.length(f) >= F.greatest(F.lit(4), F.floor(F.length(one) / 2)))))
    numbers = F.regexp_extract_all(one, F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1))
    only_numbers = (F.size(numbers) > 0) & ~one.rlike(r"\^\{?[^{}\s]{1,12}|_\{?[^{}\s]{1,8}") & (F.length(one) <= 8)
    return (F.length(one) < 2) | F.contains(whole, one) | around | F.when(only_numbers, F.forall(numbers, lambda n: F.contains(whole, n))).otherwise(_likeness(one, forms) >= least)


def is_noise(item: Column) -> Column:
    """Whether an item of a list of formulas says nothing: a name alone, a rule, a fence."""
    bare = T.strip(F.regexp_replace(T.strip(item), r"^`+|`+$", ""))
    return reduce(Column.__or__, (bare.rlike(p) for p in fixed.FORMULA_NOISE))


def atoms(formula: Column) -> Column:
    """Words, numbers and indexed names of a formula; no macros, units, function names and single digits."""
    level = F.translate(T.nfkc(formula), fixed.RAISED, fixed.LEVEL)
    bare = F.replace(F.regexp_replace(level, fixed.ATOM_MACROS, " "), F.lit(","), F.lit("."))
    found = F.array_distinct(F.regexp_extract_all(bare, F.lit(f"({fixed.ATOM})"), F.lit(1)))
    return F.filter(F.array_except(found, F.array(*map(F.lit, fixed.NO_ATOMS))), lambda a: ~a.rlike(r"^\d$"))


def missing_atoms(items: DataFrame) -> DataFrame:
    """items(key, subject, item, page) -> (key, subject, n_real, numeric_only): pages by how many items have an atom that the page has not; pages
    on which only numbers are missing, ticks of axes mostly, are told apart."""
    # the normal form comes from Python, which no lambda takes: a step of its own
    rows = items.select("key", "subject", atoms(F.col("item")).alias("atoms"), F.replace(F.translate(T.nfkc(F.col("page")), fixed.RAISED, fixed.LEVEL), F.lit(","), F.lit(".")).alias("page"))
    there, flat = F.regexp_extract_all("page", F.lit(f"({fixed.ATOM})"), F.lit(1)), F.regexp_replace("page", r"[\s{}\\$_^]", "")
    rows = rows.select("key", "subject", "atoms", there.alias("there"), flat.alias("flat"))
    missing = F.filter(F.array_except("atoms", "there"), lambda a: ~F.contains("flat", a))
    rows = rows.select("key", "subject", missing.alias("missing")).filter(F.size("missing") > 0)
    numbers = F.forall("missing", lambda a: a.rlike(r"^\d+(?:\.\d+)?$"))
    return rows.groupBy("key", "subject").agg(F.count(F.lit(1)).alias("n_real"), F.bool_and(numbers).alias("numeric_only"))


def density(text: Column) -> Column:
    """How much of a page is formulas: backslashes, exponents and indices."""
    return F.regexp_count(text, F.lit(r"\\|\^|_\{"))
