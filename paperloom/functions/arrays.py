"""Array expressions that name a value once and that carry a state along, inside a row and without a Python worker.

An expression that a lambda refers to is put in its place and then worked out for every element. let() binds it instead."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that a scan gathers before it appends them to the rest: appending copies an array, so n elements cost n * STRETCH and not n * n.
STRETCH = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def following(values: Column) -> Column:
    """Each element with the next one: structs of x and next, which is null for the last; none for an empty array."""
    pairs = lambda v: F.zip_with(v, F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), lambda x, y: F.struct(x.alias("x"), y.alias("next")))
    return let(values, lambda v: F.when(F.size(v) > 0, pairs(v)).otherwise(F.slice(pairs(v), F.lit(1), F.lit(0))))


def scan(values: Column, start: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The states after each element, of a type `kind` that start and step(state, element) have."""
    none = F.array().cast(f"array<{kind}>")

    def one(s: Column, x: Column) -> Column:
        return let(step(s["state"], x).cast(kind), lambda n: F.struct(n.alias("state"), F.array_append(s["out"], n).alias("out")))

    def stretch(s: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(s["state"].alias("state"), none.alias("out")), one)
        return let(done, lambda r: F.struct(r["state"].alias("state"), F.array_append(s["out"], r["out"]).alias("out")))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STRETCH).cast("int")), lambda k: F.slice(values, k * STRETCH + 1, F.lit(STRETCH)))
    begin = F.struct(start.cast(kind).alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.when(F.size(values) > 0, F.flatten(F.aggregate(parts, begin, stretch)["out"])).otherwise(none)


def cut_at(values: Column, starts: Column) -> Column:
    """The runs of an array that begin at these places (from 0, growing), each up to the next one."""
    return let(
        starts,
        lambda p: F.transform(p, lambda at, k: F.slice(values, at + 1, F.coalesce(F.get(p, k + 1), F.size(values)) - at)),
    )


def places(values: Column, test: Callable[[Column], Column]) -> Column:
    """The places from 0 on of the elements that pass a test."""
    return F.filter(F.transform(values, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())


def walk(values: Column, start: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """As scan(), with every state appended to those before: for arrays of some thousands, and where scans lie within each other, for the analyser takes its
    time for each level."""
    none = F.array().cast(f"array<{kind}>")
    begin = F.struct(start.cast(kind).alias("state"), none.alias("out"))
    one = lambda s, x: let(step(s["state"], x).cast(kind), lambda n: F.struct(n.alias("state"), F.array_append(s["out"], n).alias("out")))
    return F.aggregate(values, begin, one)["out"]
