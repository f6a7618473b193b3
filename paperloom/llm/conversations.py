"""Repair of the structure of conversations by cost layers.

For each increasing cost a layer holds, for each place among a conversation's turns, a bitset of the grammar's states from which the
rest can be accepted at that cost. The first layer that has the start state gives the cost, and the way back through the layers, least
letter first, the audit. Long conversations are cut into blocks: layers of a block to each of its end states give a 4 x 4 table of costs,
and such tables are put together over levels of blocks, so that no conversation is ever in one task.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import joined_small, staged, table
from .spelling import CRC_TABLE, crc_sql

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: States: at the start, after a system turn, after a user's, after an assistant's. Role initials lead from one to another.
STATES, ACCEPTED = 4, (0, 3)
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state after a user or assistant turn that an edit makes, and its role.
MADE, ROLES = (2, 2, 3, 2), {2: "user", 3: "assistant"}
#: Costs of the edits: delete, insert, change the role; and of a truncated turn that stays.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Turns of a block, and blocks of a group on the next level.
BLOCK, GROUP = 128, 1024
#: No cost, for a state from which nothing can be accepted.
NEVER = 1 << 40


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of rows(conv_id, turn, role, text): by crc32(conv_id:turn) % 20 a row goes (0), loses its text (1) or its
    ends of sentences (2), comes twice (3) or gets the role user (4). A null counts as one space, but stays null in conv_id and turn."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), (F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "utf-8")) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.filter("h <> 0").select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("h") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _same() -> tuple[Column, ...]:
    """Names of a turn's conversation, role and text."""
    return (F.xxhash64("conv_id", "role", "text").alias("a"), F.xxhash64("text", "role", "conv_id").alias("b"))


def turns(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text, copies) in order, equal ones as one with the sum of their copies: + conv, pos, blank, again, truncated.

    pos grows along each conversation, by turn (null first), then role and text. again: the role and text came in an earlier turn; copies of a row
    after its first are again in any case. Dealt out by ranges of all columns, so a long conversation is on many tasks; the written table fixes pos."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).select("*", *_same())
    rows = staged(rows.withColumn("known", F.col("turn").isNotNull()), "conversation-rows")
    # the first turn of each role and text that a conversation has in several turns
    first = rows.groupBy("a", "b").agg(F.min(F.struct("known", "turn")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b", "first")
    rows = joined_small(rows, staged(first, "conversation-repeats"), ["a", "b"], "left")
    end = F.substr(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(-1))
    blank = F.rtrim(F.col("text"), F.lit(BLANKS)) == ""
    again = F.coalesce(F.col("first.known") != F.col("known"), F.lit(False)) | F.coalesce(F.col("first.turn") != F.col("turn"), F.lit(False))
    named = rows.select(
        F.col("conv_id").isNotNull().alias("has_id"), "conv_id", "known", "turn", "role", "text", "copies", blank.alias("blank"), (~blank & again).alias("again"), (~blank & ~again & ~end.isin(*ENDS)).alias("truncated"),
        F.struct(F.xxhash64("conv_id").alias("a"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("b")).alias("conv"),
    )
    order = ["has_id", "conv_id", "known", "turn", "role", "text"]
    return staged(named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()), "conversation-turns")


# ---- layers, in plain Python over short strings

_AFTER_KEEP = {c: [sum(1 << s for s in range(STATES) if to[s] is not None and bits >> to[s] & 1) for bits in range(1 << STATES)] for c, to in KEEP.items()}
_AFTER_KEEP["o"] = [0] * (1 << STATES)
_AFTER_MADE = [sum(1 << s for s in range(STATES) if bits >> MADE[s] & 1) for bits in range(1 << STATES)]


def layers(codes: str, ends: tuple[int, ...], last: bool, starts: int) -> list[list[int]]:
    """Layer by layer, for each place among the turns, the states from which the rest is accepted at a cost up to the layer's number, where the end is
    accepted from state s at the cost ends[s]. Layers end with the first that has all of the states `starts` (a bitset) at place 0.

    codes: of each turn that may stay its role's initial (s, u, a; o: another), in upper case if it is truncated. last: turns may be inserted at the end."""
    n = len(codes)
    none = [0] * (n + 1)
    out: list[list[int]] = []
    known = [(_AFTER_KEEP[c.lower()], TRUNCATED if c.isupper() else 0) for c in codes]
    back = lambda k: out[k] if k >= 0 else none
    while True:
        c = len(out)
        deleted, inserted = back(c - DELETE), back(c - INSERT)
        row = [0] * (n + 1)
        out.append(row)
        row[n] = sum(1 << s for s in range(STATES) if ends[s] <= c) | (_AFTER_MADE[inserted[n]] if last else 0)
        for i in range(n - 1, -1, -1):
            keep, more = known[i]
            row[i] = deleted[i + 1] | _AFTER_MADE[inserted[i]] | keep[(back(c - more) if more else row)[i + 1]] | _AFTER_MADE[back(c - REROLE - more)[i + 1]]
        if row[0] & starts == starts:
            return out


def traced(codes: str, ends: tuple[int, ...], last: bool, start: int) -> tuple[int, int, list[str]]:
    """(cost, end state, least audit) from a start state; the cost includes that of the end. The audit has the letters of each turn, with those inserted
    before it, and at last those inserted at the end."""
    found = layers(codes, ends, last, 1 << start)
    c = cost = len(found) - 1
    at = lambda k, i, s: k >= 0 and found[k][i] >> s & 1
    audit, s = [], start
    for i, code in enumerate(codes):
        more, kept, mine = (TRUNCATED if code.isupper() else 0), KEEP.get(code.lower(), (None,) * STATES)[s], ""
        while not at(c - DELETE, i + 1, s) and at(c - INSERT, i, MADE[s]):  # D before I before K before R
            mine += "I"
            s, c = MADE[s], c - INSERT
            kept = KEEP.get(code.lower(), (None,) * STATES)[s]
        if at(c - DELETE, i + 1, s):
            audit.append(mine + "D")
            c -= DELETE
        elif kept is not None and at(c - more, i + 1, kept):
            audit.append(mine + "K")
            s, c = kept, c - more
        else:
            audit.append(mine + "R")
            s, c = MADE[s], c - REROLE - more
    end = ""
    while last and ends[s] > c:
        end += "I"
        s, c = MADE[s], c - INSERT
    return cost, s, [*audit, end]


AT_END = tuple(0 if s in ACCEPTED else NEVER for s in range(STATES))
#: Which states can be reached from which: the start only from itself, and after a system turn from the start too.
_REACHED = {0: (0,), 1: (0, 1), 2: (0, 1, 2, 3), 3: (0, 1, 2, 3)}


def table_of(codes: str) -> list[int]:
    """The costs of a block from each state (row) to each (column), NEVER where there is no way."""
    out = [NEVER] * (STATES * STATES)
    for e in range(STATES):
        ends = tuple(0 if s == e else NEVER for s in range(STATES))
        reached = _possible(codes, e)
        if not reached:
            continue
        found = layers(codes, ends, False, sum(1 << s for s in reached))
        for s in reached:
            out[s * STATES + e] = next(k for k, row in enumerate(found) if row[0] >> s & 1)
    return out


def _possible(codes: str, e: int) -> list[int]:
    """The states from which a block can end in e: turns may go, so a state can stay; user and assistant turns are made where a turn may follow.
    The state after a system turn comes from the start, if the block has such a turn."""
    if e == 0 or not codes:
        return [e]
    if e == 1:
        return [0, 1] if "s" in codes.lower() else [1]
    return [0, 1, 2, 3]


def times(a: list[int], b: list[int]) -> list[int]:
    """The costs through a block, then another."""
    return [min(min(a[s * STATES + m] + b[m * STATES + e] for m in range(STATES)), NEVER) for s in range(STATES) for e in range(STATES)]


def before(a: list[int], ends: list[int]) -> list[int]:
    """The costs at a block's start, of those at its end."""
    return [min(min(a[s * STATES + e] + ends[e] for e in range(STATES)), NEVER) for s in range(STATES)]


# ---- over blocks


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv, block, n_blocks, at, codes, initials): turns() in blocks of BLOCK rows, numbered along each conversation. at: pos, copies and code of each row. Rows
    that must go, and copies after the first, have no code: they are deleted whatever else happens, before anything is inserted."""
    initial = F.substr("role", F.lit(1), F.lit(1))
    known = F.when(initial.isin(*KEEP), initial).otherwise("o")
    code = F.when(F.col("blank") | F.col("again"), "").when(F.col("truncated"), F.upper(known)).otherwise(known)
    narrow = rows.select("conv", F.shiftright("pos", 33).cast("int").alias("part"), "pos", "copies", code.alias("code"), known.alias("initial"))
    # a stretch is what one task sorted of a conversation; no conversation has more of them than there were tasks
    stretches = narrow.groupBy("conv", "part").agg(F.min("pos").alias("first"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("size"))
    whole = Window.partitionBy("conv")
    stretches = stretches.select("conv", "part", "first", (F.sum("size").over(whole.orderBy("part")) - F.col("size")).alias("skip"), F.sum("size").over(whole).alias("n_blocks"))
    placed = joined_small(narrow, staged(stretches, "conversation-stretches"), ["conv", "part"], "inner")
    placed = placed.select("conv", "n_blocks", (F.col("skip") + F.floor((F.col("pos") - F.col("first")) / BLOCK)).cast("long").alias("block"), F.struct("pos", "copies", "code", "initial").alias("t"))
    made = placed.groupBy("conv", "n_blocks", "block").agg(F.array_sort(F.collect_list("t")).alias("t"))
    joint = lambda c: F.array_join(F.transform("t", lambda x: x[c]), "")
    at = F.transform("t", lambda x: F.struct(x["pos"].alias("pos"), x["copies"].alias("copies"), x["code"].alias("code")))
    return staged(made.select("conv", F.col("n_blocks").cast("long").alias("n_blocks"), "block", at.alias("at"), joint("code").alias("codes"), joint("initial").alias("initials")), "conversation-blocks")


def _once(f, kind: str):
    """f of each row's columns, worked out once for equal ones of a batch. Arrays come as tuples."""

    def run(*columns: pd.Series) -> pd.Series:
        made: dict = {}
        out = []
        for key in zip(*(c.map(lambda x: tuple(x) if hasattr(x, "__len__") and not isinstance(x, str) else x) for c in columns)):
            if key not in made:
                made[key] = f(*key)
            out.append(made[key])
        return pd.DataFrame(out, columns=[x.split()[0] for x in kind.split(", ")]) if ", " in kind else pd.Series(out)

    run.__annotations__["return"] = pd.DataFrame if ", " in kind else pd.Series
    return F.pandas_udf(run, kind)


def ends_of(blocks: DataFrame) -> DataFrame:
    """(conv, block, ends, last): what it costs from each state at a block's end to the conversation's. blocks: of conversations of several."""

    def product(rows: pd.DataFrame) -> list[int]:
        out = None
        for t in rows.sort_values("block")["costs"]:
            out = list(t) if out is None else times(out, list(t))
        return out

    def upper(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"conv": [{"a": rows["a"].iloc[0], "b": rows["b"].iloc[0]}], "block": [int(rows["block"].iloc[0]) // GROUP], "costs": [product(rows)]})

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """From a group's end to its start."""
        rows = rows.sort_values("block", ascending=False)
        ends, out = list(rows["group_ends"].iloc[0]), []
        for t in rows["costs"]:
            out.append(ends)
            ends = before(list(t), ends)
        return pd.DataFrame({"conv": [{"a": a, "b": b} for a, b in zip(rows["a"], rows["b"])], "block": rows["block"].astype("int64"), "ends": out})

    flat = lambda df: df.select(F.col("conv.a").alias("a"), F.col("conv.b").alias("b"), *(c for c in df.columns if c != "conv"))
    levels = [staged(blocks.select("conv", "block", "costs"), "conversation-costs")]
    while levels[-1].filter(F.col("block") >= GROUP).limit(1).count():
        group = F.floor(F.col("block") / GROUP)
        levels.append(staged(flat(levels[-1]).groupBy("a", "b", group.alias("g")).applyInPandas(upper, "conv struct<a:long,b:string>, block long, costs array<long>"), "conversation-costs"))
    # above the last level is the end of the conversation
    above = levels[-1].select("conv", F.lit(0).cast("long").alias("g")).distinct().withColumn("group_ends", F.array(*(F.lit(x).cast("long") for x in AT_END_INSERTED)))
    for level in reversed(levels):
        rows = level.withColumn("g", F.floor(F.col("block") / GROUP)).join(above, ["conv", "g"])
        found = staged(flat(rows).groupBy("a", "b", "g").applyInPandas(walk, "conv struct<a:long,b:string>, block long, ends array<long>"), "conversation-ends")
        above = found.select("conv", F.col("block").alias("g"), F.col("ends").alias("group_ends"))
    return found


#: What the end costs from each state with the turns that may be inserted there.
AT_END_INSERTED = tuple(len(layers("", AT_END, True, 1 << s)) - 1 for s in range(STATES))


def starts_of(ways: DataFrame) -> DataFrame:
    """(conv, block, state) at which each block begins, of ways(conv, block, next): the state after it for each state before it."""

    def through(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        now = list(range(STATES))
        for to in rows.sort_values("block")["next"]:
            now = [to[s] for s in now]
        return pd.DataFrame({"conv": [{"a": rows["a"].iloc[0], "b": rows["b"].iloc[0]}], "block": [int(rows["block"].iloc[0]) // GROUP], "next": [now]})

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        s, out = int(rows["group_state"].iloc[0]), []
        for to in rows["next"]:
            out.append(s)
            s = int(to[s])
        return pd.DataFrame({"conv": [{"a": a, "b": b} for a, b in zip(rows["a"], rows["b"])], "block": rows["block"].astype("int64"), "state": out})

    flat = lambda df: df.select(F.col("conv.a").alias("a"), F.col("conv.b").alias("b"), *(c for c in df.columns if c != "conv"))
    levels = [staged(ways.select("conv", "block", "next"), "conversation-ways")]
    while levels[-1].filter(F.col("block") >= GROUP).limit(1).count():
        levels.append(staged(flat(levels[-1]).groupBy("a", "b", F.floor(F.col("block") / GROUP).alias("g")).applyInPandas(through, "conv struct<a:long,b:string>, block long, next array<int>"), "conversation-ways"))
    above = levels[-1].select("conv", F.lit(0).cast("long").alias("g")).distinct().withColumn("group_state", F.lit(0))
    for level in reversed(levels):
        rows = level.withColumn("g", F.floor(F.col("block") / GROUP)).join(above, ["conv", "g"])
        found = staged(flat(rows).groupBy("a", "b", "g").applyInPandas(walk, "conv struct<a:long,b:string>, block long, state int"), "conversation-starts")
        above = found.select("conv", F.col("block").alias("g"), F.col("state").alias("group_state"))
    return found


def audited(blocks: DataFrame) -> DataFrame:
    """blocks_of() with the state before each block, and its own cost and the letters of its turns with a code (and of the end), without those of other rows.
    Conversations of one block need only their own layers."""

    def whole(codes: str) -> tuple:
        cost, _, letters = traced(codes, AT_END, True, 0)
        return cost, letters

    kind = "cost long, letters array<string>"
    one = blocks.filter("n_blocks = 1").select("*", F.lit(0).alias("state"), _once(whole, kind)("codes").alias("found"))
    several = blocks.filter("n_blocks > 1")
    if not several.limit(1).count():
        return staged(one, "conversation-audits")
    ends = ends_of(several.select("conv", "block", _once(table_of, "array<long>")("codes").alias("costs")))

    def ways(codes: str, ends: tuple[int, ...], last: bool) -> tuple:
        own = AT_END if last else tuple(int(x) - int(min(ends)) for x in ends)  # a few at most, so layers are as many as the block's own costs
        got = [traced(codes, own, last, s) if s in starts else (NEVER, s, []) for starts in [_starts(codes, own, last)] for s in range(STATES)]
        return [int(x[1]) for x in got], [{"cost": int(x[0]) - (0 if last else own[x[1]]), "letters": x[2]} for x in got]

    made = _once(ways, f"next array<int>, founds array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>")
    found = several.join(ends, ["conv", "block"]).withColumn("w", made("codes", "ends", F.col("block") == F.col("n_blocks") - 1))
    found = staged(found.drop("ends"), "conversation-several")
    many = found.join(starts_of(found.select("conv", "block", "w.next")), ["conv", "block"])
    many = many.withColumn("found", F.element_at("w.founds", F.col("state") + 1)).drop("w")
    return staged(one.unionByName(many, allowMissingColumns=False), "conversation-audits")


def _starts(codes: str, ends: tuple[int, ...], last: bool) -> set[int]:
    """The states from which a block's end can be accepted at all."""
    return {s for s in range(STATES) if last or any(ends[e] < NEVER // 2 and s in _possible(codes, e) for e in range(STATES))}


def _edits(letters, state: int, at) -> list[dict]:
    """What an audit changes among the turns with a code: inserted ones, k-th before a row (copy 0) or after the last one (copy 1), and rows that go or
    change their role."""
    out, s = [], state
    coded = [x for x in at if x["code"]]
    places = [(x["pos"], 0, x["code"]) for x in coded] + [(at[-1]["pos"], 1, "")]
    for (pos, copy, code), mine in zip(places, letters):
        for k, letter in enumerate(mine):
            s = KEEP[code.lower()][s] if letter == "K" else MADE[s] if letter in "RI" else s
            if letter != "K":
                out.append({"pos": int(pos), "copy": copy, "k": k, "kind": letter, "role": ROLES.get(s) if letter in "RI" else None})
    return out


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, pos, copy, k, role, text): the turns of each conversation after its repair, in order of pos, copy and k.

    Only edits travel to the turns; a turn without one stays as it is, and those that must go have gone before."""

    @F.pandas_udf("array<struct<pos:long,copy:int,k:int,kind:string,role:string>>")
    def edits(letters: pd.Series, state: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([_edits(*x) for x in zip(letters, state, at)])

    each = audits.filter(F.exists("found.letters", lambda x: x.rlike("[DIR]"))).select("conv", F.explode(edits("found.letters", "state", "at")).alias("e")).select("conv", "e.*")
    each = staged(each, "conversation-edits")
    inserted = each.filter("kind = 'I'").select("conv", "pos", "copy", "k", "role", F.lit("").alias("text"))
    changed = staged(each.filter("kind <> 'I'").select("pos", "kind", F.col("role").alias("new")), "conversation-row-edits")
    left = joined_small(rows.filter(~F.col("blank") & ~F.col("again")).select("conv", "pos", "role", "text"), changed, ["pos"], "left")
    kept = left.filter("kind IS NULL OR kind = 'R'").select("conv", "pos", F.lit(0).alias("copy"), F.lit(1 << 30).alias("k"), F.coalesce("new", "role").alias("role"), "text")
    return kept.unionByName(inserted)


def digests(turns_: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's role:text, newline-joined. A digest needs its turns one after another: they stream through one task, sorted, of
    which it holds only a batch. An operator's results don't need this, only the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            for a, b, role, text in zip(*(c.to_pylist() for c in batch.columns[:4])):
                if (a, b) != now:
                    if digest is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (a, b), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(done) >= 1 << 12:
                yield _digest_batch(done)
                done = []
        if digest is not None:
            done.append((*now, digest.hexdigest()))
        yield _digest_batch(done)

    flat = turns_.select(F.col("conv.a").alias("a"), F.col("conv.b").alias("b"), "role", "text", "pos", "copy", "k")
    dealt = flat.repartition("a", "b").sortWithinPartitions("a", "b", "pos", "copy", "k")
    return dealt.mapInArrow(run, "a long, b string, repaired_sha256 string").select(F.struct("a", "b").alias("conv"), "repaired_sha256")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string()), pa.array(c, pa.string())], names=["a", "b", "repaired_sha256"])


def illegal(initials: Column) -> Column:
    """Neighbours that are none of su, ua, au."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(initials) - 1), lambda i: F.substr(initials, i, F.lit(2)))
    return F.when(F.length(initials) < 2, 0).otherwise(F.size(F.filter(pairs, lambda x: ~x.isin("su", "ua", "au"))))


def _audit(letters, at) -> str:
    mine = iter(letters)
    return "".join(next(mine) + "D" * (int(x["copies"]) - 1) if x["code"] else "D" * int(x["copies"]) for x in at) + "".join(mine)


def counts(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)."""
    measured = rows.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.count_if("truncated").alias("truncated"),
        F.sum(F.col("copies") - 1).alias("more"),
        F.min("turn").alias("least"),
        F.max("turn").alias("most"),
    )
    numbers = rows.filter("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg(F.count(F.lit(1)).alias("numbers"))
    edge = audits.filter("block > 0").select("conv", (F.col("block") - 1).alias("block"), F.substr("initials", F.lit(1), F.lit(1)).alias("after"))

    @F.pandas_udf("string")
    def audit(letters: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([_audit(*x) for x in zip(letters, at)])

    within = audits.join(edge, ["conv", "block"], "left").select("conv", "block", "found.cost", audit("found.letters", "at").alias("audit"), illegal(F.concat("initials", F.coalesce("after", F.lit("")))).alias("illegal"))
    summed = within.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = measured.join(numbers, "conv", "left").join(summed, "conv")
    gone = F.col("blank") + F.col("duplicate")
    values = {"gaps": F.coalesce(F.col("most") - F.col("least") + 1 - F.col("numbers"), F.lit(0)), "illegal": F.col("illegal") + F.col("more"), "cost": F.col("cost") + DELETE * gone}
    return out.select("conv", *((values.get(c, F.col(c))).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), "audit")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counts, turns) of rows(conv_id, turn, role, text[, copies]): one row a conversation with faults, cost and audit, and its repaired turns.

    Nulls: texts and roles count as one space (so a text is blank); null turns come first and have no gaps; rows without conv_id are one
    conversation. Ties: rows of one turn by role and text; repeated rows are duplicates of the first. A role whose initial is not s, u or a can't
    stay. Texts of any length stay in their row. Conversations of any length are cut into blocks. An empty table gives none; other columns are ignored."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    ordered = turns(rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), copies.alias("copies")))
    audits = audited(blocks_of(ordered))
    return counts(ordered, audits), repaired(ordered, audits)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, fixed = repair(damaged(rows))
    conv = F.struct(F.xxhash64("conv_id").alias("a"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("b"))
    every = rows.select("conv_id").distinct().withColumn("conv", conv)
    out = every.join(found, "conv", "left").join(digests(fixed), "conv", "left")
    zero = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in COLUMNS[1:7]]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _oracle() -> str:
    """A recursion over each conversation's turns that holds, for each state, the cheapest and then least way there."""
    best = lambda *ways: f"list_min([{', '.join(ways)}])"
    way = lambda s, c, a, r: f"{{'c': {s}.c + {c}, 'a': {s}.a || '{a}', 'r': list_concat({s}.r, {r})}}"
    none, start = (f"{{'c': {c}::BIGINT, 'a': '', 'r': []::VARCHAR[]}}" for c in (10**9, 0))
    inserted = lambda s, to: way(s, 2, "I", f"['{ROLES[to]}:']")
    keep = lambda s, initial: f"CASE WHEN fault < 2 AND i = '{initial}' THEN {way(s, 'fault', 'K', '[role || chr(58) || x]')} ELSE {none} END"
    made = lambda s, to: f"CASE WHEN fault < 2 THEN {way(s, '2 + fault', 'R', f'[{chr(39)}{ROLES[to]}:{chr(39)} || x]')} ELSE {none} END"
    gone = lambda s: way(s, 3, "D", "[]::VARCHAR[]")
    closed2, closed3 = best("w2", inserted("w0", 2), inserted("w1", 2), inserted("w3", 2)), best("w3", inserted("v2", 3))
    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS x, {crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(x, '.!?', '') ELSE x END AS x, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM b WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(x)) AS k FROM d),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, x ORDER BY k) AS again FROM o),
f AS (SELECT conv_id, turn, role, x, k, substr(role, 1, 1) AS i, CASE WHEN NOT regexp_matches(x, '[^\\x20\\x09-\\x0D]') THEN 3 WHEN again > 1 THEN 2 WHEN NOT regexp_matches(x, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault FROM g),
n AS (SELECT conv_id, count(*) AS n, count_if(fault = 3) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 1) AS truncated, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv_id),
p AS (SELECT conv_id, count_if(k > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id, k, lag(i) OVER (PARTITION BY conv_id ORDER BY k) || i AS pair FROM f) GROUP BY conv_id),
step AS (
  SELECT conv_id, 0::BIGINT AS k, {start} AS w0, {none} AS w1, {none} AS w2, {none} AS w3 FROM n
  UNION ALL
  SELECT conv_id, k, {best(gone('w0'), none)}, {best(gone('w1'), keep('w0', 's'))}, {best(gone('v2'), keep('w0', 'u'), keep('w1', 'u'), keep('v3', 'u'), made('w0', 2), made('w1', 2), made('v3', 2))}, {best(gone('v3'), keep('v2', 'a'), made('v2', 3))}
  FROM (SELECT *, {closed3} AS v3 FROM (SELECT s.conv_id, f.k, f.role, f.x, f.i, f.fault, w0, w1, w3, {closed2} AS v2 FROM step s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.k = s.k + 1))),
e AS (SELECT conv_id, {best('w0', 'w3', inserted('v2', 3))} AS w FROM (SELECT s.conv_id, w0, w3, {closed2} AS v2 FROM step s JOIN n ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.n = s.k))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(array_to_string(w.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""


ORACLE = _oracle()
