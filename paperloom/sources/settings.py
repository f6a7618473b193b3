"""Settings from the session, the environment and a file of NAME=value lines, in this order, else defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    provider: str = "gemini"
    model: str = ""
    fallback_models: str = ""
    base_url: str = "http://localhost:11434"
    vector_store_url: str = "http://localhost:6333"
    cache_url: str = "redis://localhost:6379/0"
    embedding_model: str = "intfloat/multilingual-e5-large"


def pairs(text: str) -> dict[str, str]:
    """NAME=value lines; blank lines and those that begin with # are none."""
    lines = [x.strip() for x in text.splitlines()]
    return {k.strip(): v.strip() for k, _, v in (x.partition("=") for x in lines if x and not x.startswith("#") and "=" in x)}


def load(spark: SparkSession, text: str = "", prefix: str = "paperloom.") -> Settings:
    """`text` is the content of the file; a name that the environment has keeps its value there."""
    named = pairs(text) | {k: v for k, v in os.environ.items()}
    found = {}
    for f in fields(Settings):
        value = spark.conf.get(prefix + f.name, None)
        value = named.get(f.name.upper()) if value is None else value
        if value is not None:
            found[f.name] = value
    return Settings(**found)
