"""Repair the structure of conversations: cheapest edits that give the roles ``(s?(ua)+)?``.

Every row becomes one letter, its role and its fault; a conversation becomes a signature.  Distinct signatures of all
conversations are ordered by their ends, so that those with a common ending follow one another, and each task walks them
as an automaton whose nodes are endings: a node is entered once, and for each state of the grammar it holds the cost to go
and the edit that begins the best audit.  A signature's audit is read off by following these edits.

Conversations are cut into blocks of a bounded number of rows by ranges of the global order.  A block that does not end its
conversation is solved for every state it may end in, and the blocks of a conversation are chained by their costs.  Texts are
moved once, in the order in which the audits are applied to them.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hustings.llm.tables import own_columns, stored
from hustings.operators.ordering import positions
from hustings.operators.skew import spread_join

BLOCK = 4096
NOT_BLANK = r"[^\x20\x09-\x0D]"
CLOSED = r"[.!?][\x20\x09-\x0D]*\z"

# Costs of the edits and of leaving a truncated row.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5

# States of the grammar: nothing yet, after system, after user, after assistant.
STATES = range(4)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
# The only role other than a kept system that may follow, and the state it leads to.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60
# Cost to go and edits at the end of a conversation.
END = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")

# Letters of a row: sound, truncated and to be deleted, each for system, user, assistant and any other role.
SOUND, CUT, GONE = "suao", "SUAO", "1234"

REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` damaged by the CRC-32 of ``conv_id:turn`` modulo 20, with ``times``, how often a row stands.

    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user.  Nulls count as one
    space.  The columns are ``conv_id, turn, role, text, times``; a dropped row stays with ``times`` 0.
    """
    rows = own_columns(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(named) % 20
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("bigint").alias("times"),
    )


def keyed(turns: DataFrame, times: str | None) -> DataFrame:
    """The rows under the operator's own names; ``c`` is the conversation as text that is never null."""
    names = {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"}
    rows = own_columns(turns, **names, **({"times": times} if times else {}))
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c"),
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("times") if times else F.lit(1)).cast("bigint").alias("times"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def lettered(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text: ``before`` (global place), ``letters`` and counts of first faults."""
    standing = rows.where("times > 0")
    blank = ~F.col("text").rlike(NOT_BLANK)
    slim = standing.select("c", "turn", "role", "digest", "times", blank.alias("blank"), (~F.col("text").rlike(CLOSED)).alias("cut"))
    single = stored(
        slim.groupBy("c", "turn", "role", "digest").agg(F.sum("times").alias("times"), F.max("blank").alias("blank"), F.max("cut").alias("cut")),
        "turns",
    )
    # Texts that a conversation holds at several turns, and the first of these; nulls come first.
    repeated = (
        single.where("not blank")
        .groupBy("c", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    joined = spread_join(single, repeated, ["c", "role", "digest"], ["turn"])
    first = F.col("first").isNull() | F.col("turn").eqNullSafe(F.col("first.turn"))
    new = F.when(F.col("blank") | ~first, 0).otherwise(1)
    kind = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)), F.lit(4))
    kind = F.when(F.col("role") == "", 4).otherwise(kind)

    def letter(of: str) -> Column:
        return F.substring(F.lit(of), kind, F.lit(1))

    own = F.when(new == 0, "").when(F.col("cut"), letter(CUT)).otherwise(letter(SOUND))
    again = F.col("times") - new
    marked = joined.select(
        F.struct("c", "turn", "role", "digest").alias("key"),
        F.concat(own, F.repeat(letter(GONE), again.cast("int"))).alias("letters"),
        F.when(F.col("blank"), F.col("times")).otherwise(0).alias("n_blank"),
        F.when(F.col("blank"), 0).otherwise(again).alias("n_duplicate"),
        F.when(F.col("cut"), new).otherwise(0).alias("n_truncated"),
    )
    return positions(marked, "key").select(F.col("key.c").alias("c"), F.col("key.turn").alias("turn"), "before", "letters", "n_blank", "n_duplicate", "n_truncated")


def cut_to_blocks(letters: DataFrame, block: int) -> DataFrame:
    """Runs of at most ``block`` rows of a conversation, with their signature and what the report needs."""
    in_order = F.array_sort(F.collect_list(F.struct("before", "letters")))
    blocks = (
        letters.groupBy("c", F.floor(F.col("before") / block).alias("block"))
        .agg(
            F.array_join(F.transform(in_order, lambda x: x["letters"]), "").alias("signature"),
            *[F.sum(n).alias(n) for n in ("n_blank", "n_duplicate", "n_truncated")],
            F.min("turn").alias("min_turn"),
            F.max("turn").alias("max_turn"),
            F.size(F.collect_set("turn")).cast("bigint").alias("n_turns"),
        )
        .withColumn("ended", F.lead("block").over(W.partitionBy("c").orderBy("block")).isNull())
    )
    return blocks.select("*", F.translate("signature", GONE, "xxxx").alias("code")).withColumn(
        "roles", F.translate("signature", CUT + GONE, SOUND + SOUND)
    ).drop("signature")


Node = list[tuple[int, str, int]]


def enter(letter: str, after: list[int]) -> Node:
    """The node before a row: per state the cost to go, the first edit of the best audit and the state it leads to.

    The edits of a state begin with different letters and each leads to one state, so equal costs are decided by the letter.
    """
    rows: Node = []
    stays = TRUNCATED if letter in CUT else 0
    for state in STATES:
        best = (DELETE + after[state], "D", state)
        if letter != "x":
            kept = KEEPS.get((state, letter.lower()))
            if kept is not None:
                best = min(best, (stays + after[kept], "K", kept))
            best = min(best, (REROLE + stays + after[NEXT[state]], "R", NEXT[state]))
        rows.append(best)
    user, assistant = rows[2], rows[3]
    rows[2] = min(user, (INSERT + assistant[0], "I", 3))
    rows[3] = min(assistant, (INSERT + user[0], "I", 2))
    for state in (0, 1):
        rows[state] = min(rows[state], (INSERT + rows[2][0], "I", 2))
    return rows


def read_off(path: list[Node], state: int) -> tuple[str, int]:
    """The best audit from the last node of ``path`` in ``state`` and the state in which the rows end."""
    audit, left = [], len(path)
    while left:
        _, edit, state = path[left - 1][state]
        audit.append(edit)
        left -= edit != "I"
    return "".join(audit), state


def walk(codes: Iterator[tuple[bool, str]]) -> Iterator[tuple[list[int], list[str], int]]:
    """For every code, ordered by its reverse: costs and audits per first state (and last state, if it does not end a
    conversation), and the number of nodes entered for it.  ``-1`` and an empty audit stand where there is no way."""
    was, previous, paths = None, "", []
    for ended, code in codes:
        back = code[::-1]
        if ended != was:
            was, previous = ended, ""
            goals = [list(END)] if ended else [[0 if s == goal else FAR for s in STATES] for goal in STATES]
            paths = [(goal, []) for goal in goals]
        shared = len(os.path.commonprefix([previous, back]))
        for goal, path in paths:
            del path[shared:]
            for letter in back[shared:]:
                path.append(enter(letter, [n[0] for n in path[-1]] if path else goal))
        previous = back
        costs, audits = [], []
        for state in STATES:
            for goal, path in paths:
                cost = path[-1][state][0] if path else goal[state]
                costs.append(cost if cost < FAR else -1)
                if cost < FAR:
                    audit, last = read_off(path, state)
                    audits.append(audit + TAIL[last] if ended else audit)
                else:
                    audits.append("")
        yield costs, audits, len(back) - shared


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []

    def codes():
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                waiting.append(row)
                yield row[:2]

    def sent(rows):
        columns = zip(*rows)
        types = [pa.bool_(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64()]
        names = ["ended", "code", "_n", "costs", "audits", "nodes"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    done, held = [], 0
    for costs, audits, nodes in walk(codes()):
        done.append((*waiting.pop(), costs, audits, nodes))
        held += sum(map(len, audits))
        if held > 1 << 22 or len(done) >= 4096:
            yield sent(done)
            done, held = [], 0
    if done:
        yield sent(done)


def solved(blocks: DataFrame) -> DataFrame:
    """The distinct codes of all conversations with costs, audits and the number of automaton nodes first met in them."""
    codes = blocks.groupBy("ended", "code").agg(F.count(F.lit(1)).alias("_n"))
    back = F.reverse("code")
    ranged = codes.repartitionByRange(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ended", back)
    answers = ranged.sortWithinPartitions("ended", back).mapInArrow(
        solve, "ended boolean, code string, _n bigint, costs array<bigint>, audits array<string>, nodes bigint"
    )
    return stored(answers, "audits")


def chain(blocks: list[dict]) -> tuple[int, str]:
    """Cost and audit of a conversation from those of its blocks in order."""
    to_go = blocks[-1]["costs"]
    choices = []
    for block in reversed(blocks[:-1]):
        costs, audits, choice = [], [], []
        for state in STATES:
            ways = [
                (block["costs"][4 * state + j] + to_go[j], block["audits"][4 * state + j], j)
                for j in STATES
                if block["costs"][4 * state + j] >= 0
            ]
            cost, audit, to = min(ways)
            costs.append(cost)
            audits.append(audit)
            choice.append(to)
        to_go = costs
        choices.append((audits, choice))
    state, parts = 0, []
    for audits, choice in reversed(choices):
        parts.append(audits[state])
        state = choice[state]
    return to_go[0], "".join([*parts, blocks[-1]["audits"][state]])


def report_of(blocks: list[dict]) -> dict:
    """Counts over the blocks of a conversation, what lies across their borders included."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    turns, low, high, last = 0, None, None, ""
    for block in blocks:
        for name in ("blank", "duplicate", "truncated"):
            out[name] += block[f"n_{name}"]
        roles = last + block["roles"]
        out["illegal"] += len(roles) - 1 - sum(roles.count(pair) for pair in ("su", "ua", "au"))
        last = roles[-1]
        if block["n_turns"]:
            turns += block["n_turns"] - (high is not None and high == block["min_turn"])
            low, high = block["min_turn"] if low is None else low, block["max_turn"]
    out["gaps"] = high - low + 1 - turns if turns else 0
    out["cost"], out["audit"] = chain(blocks) if blocks else (0, "")
    return out


def replay(batches: Iterator[pa.RecordBatch], wanted: str) -> Iterator[tuple]:
    """Walk the ordered rows of whole conversations: per conversation one row that names it, its blocks, its texts.

    Yields what ``wanted`` asks for: a report per conversation or the repaired rows.  Nothing but the blocks of one
    conversation is held.
    """
    report, blocks, name, plan, at, state, digest, count = None, [], None, "", 0, 0, None, 0

    def line(edit: str, role: str, text: str):
        nonlocal count
        if digest is not None:
            if count:
                digest.update(b"\n")
            digest.update(role.encode())
            digest.update(b":")
            digest.update(text.encode())
        count += 1
        return (name, count, edit, role, text)

    def planned():
        nonlocal report, plan
        if report is None:
            report = report_of(blocks)
            plan = report["audit"]

    def inserted():
        nonlocal at, state
        while at < len(plan) and plan[at] == "I":
            state = NEXT[state]
            at += 1
            yield line("I", ROLE[state], "")

    def finished():
        planned()
        added = list(inserted())
        if wanted == "rows":
            yield from added
        else:
            counts = (report[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
            yield (name, *counts, digest.hexdigest())

    open_one = False
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if open_one:
                    yield from finished()
                open_one, name, report, blocks, at, state, count = True, row["conv_id"], None, [], 0, 0, 0
                digest = hashlib.sha256() if wanted == "report" else None
            elif row["kind"] == 1:
                blocks.append(row)
            else:
                planned()
                for _ in range(row["times"]):
                    added = list(inserted())
                    if wanted == "rows":
                        yield from added
                    edit = plan[at]
                    at += 1
                    if edit == "D":
                        continue
                    state = NEXT[state] if edit == "R" else KEEPS[state, row["role"][0]]
                    kept = line(edit, ROLE[state] if edit == "R" else row["role"], row["text"])
                    if wanted == "rows":
                        yield kept
    if open_one:
        yield from finished()


def in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired(turns: DataFrame, times: str | None, block: int, wanted: str, columns: str) -> DataFrame:
    rows = keyed(turns, times)
    blocks = stored(cut_to_blocks(lettered(rows), block), "blocks")
    answers = solved(blocks)
    planned = spread_join(blocks, answers.drop("nodes"), ["ended", "code"], ["c", "block"]).drop("ended", "code")
    heads = rows.groupBy("c").agg(F.first("conv_id").alias("conv_id")).withColumn("kind", F.lit(0))
    texts = rows.where("times > 0").withColumn("kind", F.lit(2)).drop("conv_id")
    every = heads.unionByName(planned.withColumn("kind", F.lit(1)), True).unionByName(texts, True)
    ordered = every.repartition("c").sortWithinPartitions("c", "kind", "block", "turn", "role", "digest").drop("c", "digest")
    kind = rows.schema["conv_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(f"conv_id {kind}, {columns}"))
    return ordered.mapInArrow(lambda batches: in_batches(replay(batches, wanted), schema), f"conv_id {kind}, {columns}")


def repair(turns: DataFrame, times: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row per ``conv_id`` of ``turns`` (``conv_id, turn, role, text``): faults, cost, audit and hash of the repaired rows.

    Rows go by turn (nulls first); rows of one turn by role, then by the SHA-256 of their text.  A null role or text counts as
    one space; rows without ``conv_id`` are one conversation, named null.  The first fault of a row counts: ``blank`` (nothing
    but white space), ``duplicate`` (role and text stand earlier in the conversation; so do repeated rows), ``truncated`` (does
    not close with one of ``.!?``).  ``gaps`` are turn numbers missing between the smallest and the largest, ``illegal`` are
    neighbours whose initials are not su, ua or au.  ``audit`` has K, R, D, I for keeping, another role, deleting, inserting an
    empty row; of the cheapest audits the smallest in ASCII order.  A conversation none of whose rows stand (``times``, if
    given, is how often a row stands) has zeros, an empty audit and the hash of the empty string.  An empty table gives no
    rows; further columns are not looked at.  A conversation's texts pass through one task, row by row, as its hash asks.
    """
    return repaired(turns, times, block, "report", REPORT)


def repaired_turns(turns: DataFrame, times: str | None = None, block: int = BLOCK) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, place`` (from 1), ``edit`` (K, R or I), ``role, text``.

    Order, nulls and repeated rows are as in ``repair``; deleted rows are not there, inserted ones have an empty text.
    """
    return repaired(turns, times, block, "rows", "place bigint, edit string, role string, text string")
