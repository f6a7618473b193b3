"""Column functions on what external models return: JSON in prose, tagged lines, usage, retries; and which method a page is read by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from . import text as T

# Kinds of images, in the order in which replies are searched for them.
CATEGORIES = ("DECORATIVE", "TEXTUAL", "EQUATION", "GRAPH", "DIAGRAM", "TABLE", "FIGURE", "LOGO", "BLANK")
#: Backslashes that JSON doesn't know, as LaTeX has them.
_STRAY = r'\\(?!["\\/bfnrtu])'


def unfenced(reply: Column) -> Column:
    """Without a code fence around it."""
    return F.regexp_replace(F.regexp_replace(T.strip(reply), r"(?i)^```[a-z]*\s*", ""), r"\s*```$", "")


def json_of(reply: Column, schema: DataType | str) -> Column:
    """The object or array of a reply: the whole reply, else what is between its first and last bracket, each also with stray
    backslashes doubled; null if none can be read."""
    body = unfenced(reply)
    inner = F.regexp_extract(body, r"(?s)(\{.*\}|\[.*\])", 1)
    valid = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    forms = [f for x in (body, inner) for f in (x, F.regexp_replace(x, _STRAY, r"\\\\\\\\"))]
    return F.from_json(F.coalesce(*(valid(F.nullif(f, F.lit(""))) for f in forms)), schema, {"mode": "PERMISSIVE"})


def tagged(reply: Column, tag: str, most: int = 200) -> Column:
    """What follows TAG: on its line, stripped; empty without one."""
    return F.substring(T.strip(F.regexp_extract(reply, rf"(?im)^{tag}:(.*)$", 1)), 1, most)


def category(reply: Column) -> Column:
    """The kind of image that a reply states, else UNCLEAR."""
    head, found = F.upper(reply), None
    for name in CATEGORIES:
        here = F.contains(head, F.lit(f"CATEGORY: {name}")) | F.contains(head, F.lit(f"CATEGORY:{name}"))
        found = F.when(here, name) if found is None else found.when(here, name)
    return found.otherwise("UNCLEAR")


def meaningful(reply: Column) -> Column:
    """MEANINGFUL: YES or NO; null for neither."""
    return F.when(F.upper(reply).rlike("MEANINGFUL: ?YES"), True).when(F.upper(reply).rlike("MEANINGFUL: ?NO"), False)


def retry_after(error: Column, attempt: Column) -> Column:
    """Seconds until a failed call is made again: as the reply says and 2 more where a limit was met, growing where the service was
    away; null where another model has to be asked."""
    said = F.nullif(F.regexp_extract(error, r"(?i)retry[^\d]*(\d+(?:\.\d+)?)\s*s", 1), F.lit("")).cast("double")
    return F.when(error.rlike("429|RESOURCE_EXHAUSTED"), F.coalesce(said, F.lit(60.0)) + 2).when(error.rlike("503|UNAVAILABLE"), F.least(F.lit(4.0) * (attempt + 1), F.lit(30.0)))


def routed(text: Column, low_quality: Column, rendered: Column, ocr_text: Column, ocr_confidence: Column) -> Column:
    """(method, confidence, failed, text) of a page: its own text where it is good; else what OCR read, by its confidence; a page
    that was rendered and not read failed, and one that could not be rendered keeps the text it has."""
    read = T.strip(F.coalesce(ocr_text, F.lit(""))) != ""
    own = F.struct(F.lit("pdfplumber").alias("method"), F.lit(1.0).alias("confidence"), F.lit(False).alias("failed"), text.alias("text"))
    by_ocr = F.struct(F.when(ocr_confidence >= 0.9, "gemini").otherwise("paddleocr").alias("method"), ocr_confidence.cast("double").alias("confidence"), F.lit(False).alias("failed"), ocr_text.alias("text"))
    lost = F.struct(F.lit("failed").alias("method"), F.lit(0.0).alias("confidence"), F.lit(True).alias("failed"), text.alias("text"))
    return F.when(~low_quality, own).when(rendered & read, by_ocr).when(rendered, lost).when(T.strip(text) == "", lost).otherwise(own)


def cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Of calls, prices being for a million tokens."""
    return F.round(F.sum(tokens_in) * price_in / 1e6 + F.sum(tokens_out) * price_out / 1e6, 4)
