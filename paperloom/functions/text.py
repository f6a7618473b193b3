"""Column functions on page text: scripts, tokens, lines, labels, similarity of token sets."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import fixed
from .arrays import let

# Unicode blocks of Arabic letters and forms; digits of Arabic script.
ARABIC = "\\u0600-\\u06FF\\u0750-\\u077F\\u08A0-\\u08FF\\uFB50-\\uFDFF\\uFE70-\\uFEFF"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
# Invisible format characters, and the Arabic elongation sign.
INVISIBLE = "[\\u200B-\\u200F\\u202A-\\u202F\\u2060-\\u2064\\uFEFF\\u0640]"
# Characters that are their own compatibility normal form and join with none before them, of the scripts that texts are mostly in.
# The frequent ones stand before the class of the others, which is then seldom asked.
NORMAL = (
    "\\x00-\\x9F\\u0621-\\u063F\\u0641-\\u064A[\\u00C0-\\u0131\\u0134-\\u013E\\u0141-\\u0148\\u014A-\\u017E\\u0391-\\u03A1\\u03A3-\\u03CE\\u0400-\\u0482\\u05D0-\\u05EA\\u0660-\\u066F"
    "\\u2012-\\u2016\\u2018-\\u2023\\u3041-\\u3096\\u30A1-\\u30FA\\u4E00-\\u9FFF\\uAC00-\\uD7A3]"
)


def count_of(text: Column, character_class: str) -> Column:
    """Characters of a class, by what is left without them: counting matches makes a string of each."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{character_class}]+", ""))


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def western_digits(text: Column) -> Column:
    return F.translate(text, ARABIC_DIGITS, "0123456789")


@F.pandas_udf(ArrayType(StringType()))
def _nfkc_each(pieces: pd.Series) -> pd.Series:
    return pieces.map(lambda ps: None if ps is None else [unicodedata.normalize("NFKC", p) for p in ps])


def nfkc(text: Column) -> Column:
    """Compatibility normal form; there is no JVM function for it. Python gets what normalizing may change, with the letter before it, and the rest stays where it is."""
    odd = f"[{NORMAL}]?[^{NORMAL}]+"
    new = _nfkc_each(let(text, lambda t: F.when(t.rlike(f"[^{NORMAL}]"), F.regexp_extract_all(t, F.lit(f"({odd})"), F.lit(1)))))
    joined = F.array_join(F.zip_with(F.split(text, odd, -1), new, lambda gap, piece: F.concat(gap, F.coalesce(piece, F.lit("")))), "")
    return F.when(new.isNull(), text).otherwise(joined)


def normalized(text: Column) -> Column:
    """Invisible characters dropped, NFKC, blanks and blank lines collapsed, ends stripped."""
    seen = nfkc(F.regexp_replace(text, INVISIBLE, ""))
    return strip(F.regexp_replace(F.regexp_replace(seen, "[ \t]{2,}", " "), "\n{3,}", "\n\n"))


def collapsed(text: Column) -> Column:
    """The JVM part of normalized()."""
    return F.regexp_replace(F.regexp_replace(text, "[ \t]{2,}", " "), "\n{3,}", "\n\n")


def script(text: Column) -> Column:
    """arabic above 60 % Arabic of Arabic and ASCII letters, latin below 20 %, mixed between, unknown without either."""
    letters = "".join(map(chr, (*range(65, 91), *range(97, 123))))
    latin = F.length(text) - F.length(F.translate(text, letters, ""))
    arabic = F.when(text.rlike(f"[{ARABIC}]"), count_of(text, ARABIC)).otherwise(0)  # most texts have none, which is told without counting

    def of(n: Column) -> Column:
        share = n["arabic"] / (n["arabic"] + n["latin"])
        return F.when(n["arabic"] + n["latin"] == 0, "unknown").when(share > 0.6, "arabic").when(share < 0.2, "latin").otherwise("mixed")

    return F.when(text.isNotNull(), let(F.struct(arabic.alias("arabic"), latin.alias("latin")), of)).otherwise("mixed")


def words(text: Column) -> Column:
    """Between white space of any script."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def mean_length(words_: Column) -> Column:
    return let(words_, lambda ws: F.when(F.size(ws) > 0, F.aggregate(ws, F.lit(0), lambda s, x: s + F.length(x)) / F.size(ws)).otherwise(0.0))


def _arabic_words(text: Column) -> Column:
    """Those of words() with any Arabic character."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)((?<!\S)[^\s{ARABIC}]*+[{ARABIC}]\S*+)"), F.lit(1))


def arabic_word_length(text: Column) -> Column:
    """Mean length of the words that are Arabic by more than half; 0 without any."""
    return mean_length(F.filter(_arabic_words(text), lambda w: 2 * count_of(w, ARABIC) > F.length(w)))


def arabic_token_length(text: Column) -> Column:
    """Mean length of the words with any Arabic character; 0 without any."""
    return mean_length(_arabic_words(text))


def arabic_density(text: Column) -> Column:
    """Arabic characters to all of the stripped text; 0 for blank text."""
    return F.coalesce(count_of(text, ARABIC) / F.nullif(F.length(strip(text)), F.lit(0)), F.lit(0.0))


def all_lines(text: Column) -> Column:
    """Lines ended by any line end of Unicode; an end at the very end opens no further line."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, r"\R\z", ""), r"\R"))


def short(text: Column, most: int = 110) -> Column:
    """One line of at most so many characters, without markup."""
    return F.substring(strip(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\*\*|<[^>]+>", ""), r"(?U)\s+", " ")), 1, most)


def leading(label: Column) -> Column:
    """The first number of a label."""
    return F.split_part(label, F.lit("."), F.lit(1)).try_cast("int")


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def average_token(text: Column) -> Column:
    """Mean length of tokens; 0 without any."""
    t = tokens(text)
    return F.when(F.size(t) == 0, 0.0).otherwise(F.aggregate(t, F.lit(0), lambda s, x: s + F.length(x)) / F.size(t))


def restored_digits(line: Column) -> Column:
    """Each run of digits of a right-to-left line turned around."""
    return F.array_join(F.transform(F.regexp_extract_all(line, F.lit(r"(\d+|\D+)"), F.lit(1)), lambda x: F.when(x.rlike(r"^\d+$"), F.reverse(x)).otherwise(x)), "")


def anchors(text: Column, stop: tuple[str, ...] = ()) -> Column:
    """Distinct lower-case words of two letters or digits or more, without stop words."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]{2,})"), F.lit(1)))
    return F.array_except(found, F.array(*map(F.lit, stop))) if stop else found


def key_tokens(text: Column) -> Column:
    """What tells a question's or an answer's subject: words, numbers, and the macros, names and numbers inside formulas, each once;
    without stop words, single characters and macros of layout."""
    bare = F.regexp_replace(F.regexp_replace(text, fixed.MARKS, ""), fixed.CELL_MARKUP, "")
    found = F.regexp_extract_all(bare, F.lit(f"(?U)({fixed.TOKEN})"), F.lit(1))
    inner = F.flatten(F.transform(F.filter(found, lambda t: t.startswith("$")), lambda t: F.regexp_extract_all(t, F.lit(r"(\\[a-zA-Z]+|[A-Za-z](?U:\w)*|\d+(?:[.,]\d+)?)"), F.lit(1))))
    plain = F.filter(F.transform(F.filter(found, lambda t: ~t.startswith("$")), F.lower), lambda w: F.length(w) >= 2)
    names = lambda values: F.array(*map(F.lit, values))
    return F.array_union(F.array_except(inner, names(fixed.LAYOUT_MACROS)), F.array_except(plain, names(fixed.STOP_WORDS)))


def lexical(a: Column, b: Column) -> Column:
    """Cosine of two bags taken as sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.sqrt(F.size(a) * F.size(b).cast("double")))


def flipped(label: Column) -> Column:
    return F.array_join(F.reverse(F.split(label, r"\.")), ".")


def label_agreement(a: Column, b: Column) -> Column:
    """1 for equal labels in either direction, 0.5 if one opens the other, else 0; null agrees with nothing."""
    sides = [(x, y) for x in (a, flipped(a)) for y in (b, flipped(b))]
    equal = reduce(Column.__or__, (x == y for x, y in sides))
    opens = reduce(Column.__or__, (x.startswith(F.concat(y, F.lit("."))) | y.startswith(F.concat(x, F.lit("."))) for x, y in sides))
    return F.coalesce(F.when(equal, 1.0).when(opens, 0.5), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def verdict(reply: Column, key: str, good: str, bad: str) -> Column:
    """A model's verdict from its first 200 characters: KEY: value first, then the bare words, else UNCLEAR."""
    head = F.upper(F.substring(reply, 1, 200))
    return (
        F.when(head.contains(f"{key}: {good}") | head.contains(f"{key}:{good}"), good)
        .when(head.contains(f"{key}: {bad}") | head.contains(f"{key}:{bad}"), bad)
        .when(head.contains(good), good)
        .when(head.contains(bad), bad)
        .otherwise("UNCLEAR")
    )
