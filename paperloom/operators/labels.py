"""Labels, items and blocks of whole texts as columns; null texts give null."""

from __future__ import annotations

from pyspark.sql import Column

from ..functions.text import all_lines
from . import reading
from .reading import block_mentions, blocks, cleaned, is_question, item_label, items, legends, oriented, stubs

__all__ = ["block_mentions", "blocks", "cleaned", "is_question", "item_label", "items", "legends", "oriented", "seen_lines", "stubs"]


def seen_lines(text: Column) -> Column:
    return reading.seen_lines(all_lines(text))
