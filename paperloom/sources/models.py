"""Readers and models from outside as functions: what reads a page's characters, renders a page, or answers about an image is given by the caller.

Each task calls for its own rows, with the models in turn, waits between calls and stops at its share of a budget; results are a keyed table, so a
pass that is run again does what is left (operators.overlay.pending)."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RETRY = re.compile(r"retry[^\d]*(\d+(?:\.\d+)?)\s*s", re.I)


def extracted(files: DataFrame, extract: Callable[[bytes], list[dict]], schema: str, key: str = "path", content: str = "content") -> DataFrame:
    """A row for each record that extract() finds in a file's bytes: characters, boxes, words or page sizes of a document, with the file's key in front."""
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [{key: k, **r} for k, data in zip(frame[key], frame[content]) if data is not None for r in extract(bytes(data))]
            yield pd.DataFrame(rows, columns=[key, *names])

    return files.select(key, content).mapInPandas(run, f"{key} string, {schema}")


def rendered(pages: DataFrame, render: Callable[..., bytes], columns: list[str], key: str = "name") -> DataFrame:
    """(name, png) of what render(*columns) draws. Images are a table; a sink writes them where files are needed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "png": [render(*row) for row in frame[columns].itertuples(index=False)]})

    return pages.select(key, *columns).mapInPandas(run, f"{key} string, png binary")


def wait_after(error: str, attempt: int) -> float | None:
    """Seconds until a failed call is made again; None where another model has to be asked."""
    if "429" in error or "RESOURCE_EXHAUSTED" in error:
        said = _RETRY.search(error)
        return (float(said[1]) if said else 60.0) + 2
    if "503" in error or "UNAVAILABLE" in error:
        return min(4.0 * (attempt + 1), 30.0)
    return None


def ask(call: Callable[[str, tuple], tuple[str, int, int]], models: list[str], row: tuple, attempts: int = 4, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The first reply of the models in turn: (status, reply, model, tokens_in, tokens_out, error)."""
    error = "no model"
    for model in models:
        for attempt in range(attempts):
            try:
                reply, tokens_in, tokens_out = call(model, row)
                return {"status": "OK", "reply": reply, "model": model, "tokens_in": tokens_in, "tokens_out": tokens_out, "error": None}
            except Exception as e:  # noqa: BLE001 what a service raises is its own
                error = str(e)
                wait = wait_after(error, attempt)
                if wait is None:
                    break
                sleep(wait)
    return {"status": "ERROR", "reply": None, "model": None, "tokens_in": 0, "tokens_out": 0, "error": error[:200]}


REPLY = "status string, reply string, model string, tokens_in long, tokens_out long, error string"


def answered(rows: DataFrame, key: str, columns: list[str], call: Callable[[str, tuple], tuple[str, int, int]], models: list[str], interval: float = 0.0, price_in: float = 0.0, price_out: float = 0.0, budget: float | None = None, tasks: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(key, status, reply, model, tokens_in, tokens_out, error) for each row, by `tasks` callers. The least interval between calls of all callers and the budget, prices being for a
    million tokens, are dealt evenly among them; rows beyond it are BUDGET_STOP."""
    pause, share = interval * tasks, None if budget is None else budget / tasks

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, last = 0.0, None
        for frame in frames:
            out = []
            for k, *row in frame[[key, *columns]].itertuples(index=False):
                if share is not None and spent >= share:
                    out.append({key: k, "status": "BUDGET_STOP"})
                    continue
                if last is not None and pause:
                    sleep(max(0.0, pause - (time.monotonic() - last)))
                last = time.monotonic()
                got = ask(call, models, tuple(row), sleep=sleep)
                spent += (got["tokens_in"] * price_in + got["tokens_out"] * price_out) / 1e6
                out.append({key: k, **got})
            yield pd.DataFrame(out, columns=[key, *(x.split()[0] for x in REPLY.split(", "))]).astype({"tokens_in": "Int64", "tokens_out": "Int64"})

    return rows.select(key, *columns).repartition(tasks, F.col(key)).mapInPandas(run, f"{key} string, {REPLY}")
