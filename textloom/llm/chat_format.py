"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

Every line of a transcript is an observation: which speaker marker it starts with, whether it
opens a message and how long that message is, how long the line is, whether it asks, and so on. The
hidden state is the speaker. Start, transition and emission tables are learned from all lines whose
role is given (aggregations over a bounded number of codes), added to pseudo-counts; those of the
markers say that a speaker mostly uses their own marker or none. Roles are then decoded by Viterbi
and each line's turn is rendered as ``<|role|>`` and the text without its marker.

Viterbi is a product of small max-plus matrices, which may be grouped at will: lines go into
blocks of ``BLOCK`` by their order number, blocks into blocks of blocks, until a conversation is
one matrix; then best states are handed down again. So one conversation with a third of all rows
is many blocks, and no task holds more than a block.

Edge cases: a null text is one empty line; null or unknown roles teach nothing, but are decoded;
a null conversation id is a conversation of its own, a null turn comes first; rows that tie are
ordered by their text and then role; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.scans import blocked, running
from textloom.session import Scope, materialize

ROLES = ("system", "user", "assistant")
BLOCK = 64
SMOOTH = 1.0
#: Pseudo-counts of a line's marker: none, the speaker's own, another speaker's.
MARKER_PRIOR = (50.0, 10.0, 0.02)
#: Feature codes of opening lines, and of all lines.
OPENING, CODES = 28, 56
LEVELS = 12

#: Speaker markers at the start of a line, by role (fixed values).
MARKERS = {
    "system": r"system|sys|instructions?",
    "user": r"user|human|q|question|customer|prompt|you",
    "assistant": r"assistant|ai|bot|a|answer|agent|model|gpt",
}
_LEAD = r"(?i)^\s*(?:<\|?|\[|\*\*|#{1,3}\s*)?(?:%s)(?:\|?>|\]|\*\*)?\s*(?::|>|-(?=\s)|$)\s*"


def marker(line: Column) -> Column:
    """0: none; else 1 + the number of the role whose marker starts the line."""
    out = F.lit(0)
    for k in reversed(range(len(ROLES))):
        out = F.when(line.rlike(_LEAD % MARKERS[ROLES[k]]), F.lit(k + 1)).otherwise(out)
    return out


def strip_marker(line: Column) -> Column:
    return F.regexp_replace(line, _LEAD % "|".join(MARKERS[r] for r in ROLES), "")


def line_code(line: Column, opens: Column, size: Column) -> Column:
    """Feature code of a line without its marker.

    A line that opens a message: the message's length class and whether the line asks. Others: the line's length class,
    question, list or code.
    """
    classes = lambda n, unit, most: F.least(F.lit(most), F.floor(F.log2(n / unit + 1) * 2)).cast("int")
    asks = line.contains("?").cast("int")
    opening = classes(size, 32, 13) + 14 * asks
    inside = OPENING + classes(F.length(line), 32, 6) + 7 * asks + 14 * line.rlike(r"^\s*([-*•]|\d+\.|```|    )").cast("int")
    return F.when(opens, opening).otherwise(inside).cast("int")


def _lines(chats: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row a line with an order number that is dense inside a turn."""
    rows = chats.select(
        F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("given"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    # Equal rows have one hash and are told apart by their number; which is which cannot show.
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    lines = rows.select("conv", "turn", "given", F.xxhash64("text", "given").alias("row"), "copy", F.length("text").alias("size"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    state = F.lit(None).cast("int")
    for k, name in enumerate(ROLES):
        state = F.when(F.lower("given") == name, F.lit(k)).otherwise(state)
    lines = lines.withColumn("mark", marker(F.col("line"))).withColumn("body", strip_marker(F.col("line")))
    return lines.withColumn("code", line_code(F.col("body"), F.col("at") == 0, F.col("size"))).withColumn("state", state).drop("size")


@dataclass(frozen=True)
class Model:
    """Log probabilities: ``start[to]``, ``move[from, to]``, ``emit[state, code]``, ``said[opens, state, marker]``."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    said: np.ndarray


def learn(lines: DataFrame) -> Model:
    """The model from the numbered lines with a given role; counts of a bounded number of codes are collected."""
    known = lines.where("state IS NOT NULL")
    k = len(ROLES)
    emit = np.full((k, CODES), SMOOTH)
    none, own, other = MARKER_PRIOR
    said = np.full((2, k, k + 1), other)
    said[:, :, 0] = none
    said[:, np.arange(k), np.arange(k) + 1] = own
    for r in known.groupBy("state", F.expr("int(at = 0)").alias("opens"), "mark", "code").count().collect():
        emit[r.state, r.code] += r["count"]
        said[r.opens, r.state, r.mark] += r["count"]
    # A message's first line follows the line before it; lines are joined by number, not windowed.
    heads = known.where("at = 0").select("conv", "pos", F.col("state").alias("then"))
    before = known.select("conv", (F.col("pos") + 1).alias("pos"), "state")
    move = np.full((k, k), SMOOTH)
    for r in heads.join(before, ["conv", "pos"]).groupBy("state", "then").count().collect():
        move[r.state, r.then] += r["count"]
    start = np.full(k, SMOOTH)
    for r in known.where("pos = 0").groupBy("state").count().collect():
        start[r.state] += r["count"]
    norm = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return Model(norm(start), norm(move), norm(emit), norm(said))


def line_scores(model: Model, code: np.ndarray, mark: np.ndarray, opens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Max-plus step matrices ``[line, from, to]``; inside a message the speaker stays unless a marker says otherwise.

    The first line of a conversation has no line before it: its step is the start's, from any state.
    """
    k = len(ROLES)
    stay = np.where(np.eye(k, dtype=bool), 0.0, -50.0)
    step = np.where((opens | (mark > 0))[:, None, None], model.move[None], stay[None])
    step = np.where(first[:, None, None], np.broadcast_to(model.start, (k, k))[None], step)
    seen = model.emit[:, code].T + model.said[opens.astype(int), :, mark]
    return step + seen[:, None, :]


def _product(steps: np.ndarray) -> np.ndarray:
    out = steps[0]
    for m in steps[1:]:
        out = (out[:, :, None] + m[None]).max(1)
    return out


def _matrices(model: Model, group_cols: list[str]):
    """Step matrix of each line (flattened)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.to_pydict()
            m = line_scores(model, np.array(t["code"], int), np.array(t["mark"], int), np.array(t["at"], int) == 0, np.array(t["pos"], int) == 0) if t["code"] else np.empty((0, 3, 3))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in group_cols] + [pa.array(m.reshape(len(m), -1).tolist(), pa.list_(pa.float64()))], names=[*group_cols, "m"])

    return run


def _multiply(table: pa.Table) -> pa.Table:
    """One block: its product, in order."""
    table = table.sort_by("pos")
    m = np.array(table["m"].to_pylist()).reshape(-1, len(ROLES), len(ROLES))
    return pa.table({"conv": table["conv"][:1], "pos": pa.array([table["block"][0].as_py()], pa.int64()), "m": pa.array([_product(m).ravel().tolist()], pa.list_(pa.float64()))})


def _hand_down(table: pa.Table) -> pa.Table:
    """One block with known states before and after it: the state after each of its parts."""
    table = table.sort_by("pos")
    m = np.array(table["m"].to_pylist()).reshape(-1, len(ROLES), len(ROLES))
    first, last = table["first"][0].as_py(), table["last"][0].as_py()
    score, back = np.full(len(ROLES), -np.inf), []
    score[first] = 0.0
    for step in m:
        all_ = score[:, None] + step
        back.append(all_.argmax(0))
        score = all_.max(0)
    states, at = [], last
    for b in reversed(back):
        states.append(int(at))
        at = b[at]
    return pa.table({"conv": table["conv"], "pos": table["pos"], "state": pa.array(states[::-1], pa.int64())})


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """``conv, pos, state`` for every line of ``lines`` (conv, pos, at, mark, code)."""
    level = lines.select("conv", "pos", "at", "mark", "code").mapInArrow(_matrices(model, ["conv", "pos"]), "conv string, pos long, m array<double>")
    levels = [materialize(level, "chat-level")]
    for _ in range(LEVELS):
        if levels[-1].where("pos > 0").isEmpty():
            break
        up = levels[-1].withColumn("block", F.expr(f"pos div {BLOCK}"))
        levels.append(materialize(up.groupBy("conv", "block").applyInArrow(_multiply, "conv string, pos long, m array<double>"), "chat-level"))
    # The whole conversation: the best last state (the first line's step is the same from any state).
    k = len(ROLES)
    best = F.expr(f"transform(sequence(0, {k * k - 1}), i -> struct(m[i] AS s, -i AS i))")
    top = levels[-1].select("conv", "pos", F.array_max(best).alias("b"))
    known = top.select("conv", "pos", F.expr(f"int((-b.i) div {k})").alias("first"), F.expr(f"int((-b.i) % {k})").alias("last"))
    for level in reversed(levels[:-1]):
        parts = level.withColumn("block", F.expr(f"pos div {BLOCK}")).join(known.withColumnRenamed("pos", "block"), ["conv", "block"])
        after = parts.groupBy("conv", "block").applyInArrow(_hand_down, "conv string, pos long, state long")
        after = materialize(after, "chat-states")
        before = after.select("conv", (F.col("pos") + 1).alias("pos"), F.col("state").alias("first"))
        firsts = known.where("pos = 0").select("conv", F.lit(0).cast("long").alias("pos"), F.col("first").cast("long").alias("first"))
        known = after.join(before.unionByName(firsts), ["conv", "pos"]).select("conv", "pos", F.col("first").cast("int").alias("first"), F.col("state").cast("int").alias("last"))
    return known.select("conv", "pos", F.col("last").alias("state"))


def number_lines(lines: DataFrame, scope: Scope) -> DataFrame:
    """Adds ``pos``, dense from 0 inside a conversation.

    A scan over ranges of lines in order: neither a conversation nor a turn with very many lines is one task.
    """
    order = ["turn", "row", "copy", "at"]
    lines = lines.withColumn("conv", F.coalesce(F.concat(F.lit("c"), "conv"), F.lit("n")))
    ranges = blocked(lines, "conv", *order, keep=scope.keep)
    return running(ranges, "conv", order, F.lit(1).cast("long"), "n").withColumn("pos", F.col("n") - 1).drop("n", "_block")


def format_chats(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a message: ``conv_id, turn, given, role, rendered`` (decoded role of its first line; canonical text)."""
    with Scope(chats.sparkSession) as scope:
        numbered = materialize(number_lines(_lines(chats, conv_col, turn_col, role_col, text_col), scope), "chat-lines")
    decoded = decode(numbered, learn(numbered))
    names = F.array(*[F.lit(r) for r in ROLES])
    placed = numbered.join(decoded.withColumnRenamed("state", "found"), ["conv", "pos"]).withColumn("role", F.element_at(names, F.col("found") + 1))
    placed = placed.withColumn("head", F.col("pos") - F.col("at"))
    # A message's lines in order; a new speaker inside it opens a new turn.
    parts = F.array_sort(F.collect_list(F.struct("at", "role", "body")))
    message = placed.groupBy("conv", "turn", "row", "copy", "head").agg(F.first("given").alias("given"), parts.alias("parts"))
    turns = F.transform("parts", lambda p, i: F.concat(F.when((i == 0) | (F.get(F.col("parts"), i - 1)["role"] != p["role"]), F.concat(F.lit("<|"), p["role"], F.lit("|>\n"))).otherwise(F.lit("")), p["body"]))
    conv = F.when(F.col("conv") != "n", F.expr("substr(conv, 2)")).cast(chats.schema[conv_col].dataType)
    return message.select(conv.alias(conv_col), F.col("turn").alias(turn_col), "given", F.element_at("parts", 1)["role"].alias("role"), F.concat(F.array_join(turns, "\n"), F.lit("\n")).alias("rendered"))
