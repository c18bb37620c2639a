"""Roles of transcript lines by a hidden Markov model, and canonical rendering of the turns.

The states are the roles.  A turn shows a speaker marker ("User:", "Assistant:", ... or none),
its number of lines, its length and whether it asks; their chances given the role, and the
chances of one role after another, are counted on a bounded sample of turns with known roles.
Viterbi decoding finds the likeliest roles of a whole conversation.

A conversation is decoded in segments of consecutive turns, so that the longest one is no task
of its own.  The best score from any role before a segment to any role at its end is a small
matrix; scanning these matrices gives the roles at the segments' ends, and every segment is
then decoded between its two fixed ends.  The result is that of decoding in one piece.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import sorted_groups, stored

ROLES = ("system", "user", "assistant")
#: What speakers are called in transcripts, for each role.
MARKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|question|q|me",
    "assistant": "assistant|ai|bot|agent|answer|a|model",
}
#: Upper ends of the classes of characters and lines of a turn.
LENGTHS, LINES = (40, 120, 250, 450, 900, 1800), (1, 3, 6)
#: Turns to learn from, on average, and turns of one segment.
SAMPLE, SEGMENT, SEED = 20_000, 1024, 6

_MARKER = {role: rf"^\s*[\[<*#]*\s*(?:{names})\s*[\]>*]*\s*[:>\]]+\s*" for role, names in MARKERS.items()}


def signs(text: Column) -> Column:
    """A number for what a turn shows: marker, class of length, class of lines, whether it asks."""
    body = F.coalesce(text, F.lit(""))
    marker = F.lit(0)
    for i, role in enumerate(ROLES):
        marker = F.when(body.rlike("(?i)" + _MARKER[role]), i + 1).otherwise(marker)
    length = sum((F.length(body) > x).cast("int") for x in LENGTHS)
    lines = sum((F.regexp_count(body, F.lit("\n")) + 1 > x).cast("int") for x in LINES)
    asks = body.rlike(r"\?\s*$").cast("int")
    return ((marker * (len(LENGTHS) + 1) + length) * (len(LINES) + 1) + lines) * 2 + asks


SIGNS = (len(ROLES) + 1) * (len(LENGTHS) + 1) * (len(LINES) + 1) * 2


class Model:
    """Log chances: of the first role, of a role after another, of a sign given the role."""

    def __init__(self, first: np.ndarray, after: np.ndarray, shown: np.ndarray):
        self.first, self.after, self.shown = first, after, shown


def fit(turns: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from turns(conv_id, turn, role, text); conversations are taken by a hash of their id.

    Only counts reach the driver: of first roles, pairs of roles and signs by role.
    """
    named = turns.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", "role", signs(F.col("text")).alias("sign"))
    total = named.count()
    place = F.pmod(F.xxhash64("conv_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A turn's predecessor is found by its number: no window over a conversation.
    chosen = stored(named.where(place < min(1.0, sample / max(1, total))), "chosen")
    previous = chosen.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before")).distinct()
    pairs = chosen.join(previous, ["conv_id", "turn"], "left").groupBy("before", "role").count().collect()
    shown = chosen.groupBy("role", "sign").count().collect()
    first, after = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    for before, role, n in pairs:
        if before is None:
            first[ROLES.index(role)] += n
        else:
            after[ROLES.index(before), ROLES.index(role)] += n
    # A sign's chance is the product of the chances of its parts, so that rare mixtures count, too.
    sizes = (len(ROLES) + 1, len(LENGTHS) + 1, len(LINES) + 1, 2)
    grid = np.zeros((len(ROLES), *sizes))
    for role, sign, n in shown:
        grid[ROLES.index(role)][np.unravel_index(sign, sizes)] += n
    marker = grid.sum(axis=(2, 3, 4)) + 0.5
    for i in range(len(ROLES)):  # a marker speaks for its role even if none was seen
        marker[i, 1:] = 0.001 * marker[i].sum() / 3
        marker[i, i + 1] = max(marker[i].sum() * 0.5, 1)
    parts = [marker, *(grid.sum(axis=tuple(d for d in range(1, 5) if d != k)) + 0.5 for k in (2, 3, 4))]
    logs = [np.log(p / p.sum(axis=1, keepdims=True)) for p in parts]
    joint = (
        logs[0][:, :, None, None, None]
        + logs[1][:, None, :, None, None]
        + logs[2][:, None, None, :, None]
        + logs[3][:, None, None, None, :]
    )
    return Model(
        np.log(first / first.sum()), np.log(after / after.sum(axis=1, keepdims=True)), joint.reshape(len(ROLES), SIGNS)
    )


def viterbi(model: Model, sign: np.ndarray, enter: np.ndarray, leave: int | None = None) -> np.ndarray:
    """Likeliest roles of a run of turns, given the score of each role at its first turn and the role of its last."""
    score, back = enter + model.shown[:, sign[0]], []
    for x in sign[1:]:
        every = score[:, None] + model.after
        back.append(every.argmax(axis=0))
        score = every.max(axis=0) + model.shown[:, x]
    roles = [int(score.argmax()) if leave is None else leave]
    for step in reversed(back):
        roles.append(int(step[roles[-1]]))
    return np.array(roles[::-1])


def _through(model: Model, sign: np.ndarray) -> np.ndarray:
    """Best score of a segment from each role before it (or of its first turn, row 0) to each role at its end."""
    enter = np.vstack([model.first, model.after])
    out = enter + model.shown[:, sign[0]]
    for x in sign[1:]:
        out = (out[:, :, None] + model.after[None]).max(axis=1) + model.shown[:, x]
    return out


def recover(turns: DataFrame, model: Model, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, turn, text, role) for every row of turns(conv_id, turn, text).

    Turns of a conversation follow by number, ties by text; a null number counts as 0 and a null
    text as empty.  The marker that a text begins with is cut off.  Rows with a null conversation
    are one conversation.  Repeated rows stay repeated; no turns give no rows.
    """
    rows = stored(
        turns.select(
            F.col("conv_id").cast("long"),
            F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .withColumn("sign", signs(F.col("text")))
        .withColumn("segment", F.floor(F.col("turn") / segment).cast("long"))
        .withColumn("key", F.xxhash64(F.coalesce("conv_id", F.lit(-1)), "segment", F.col("conv_id").isNull())),
        "turns",
    )
    packed = pickle.dumps(model)

    def grouped(df: DataFrame, fields: list[str]) -> DataFrame:
        order = ["key", "conv_id", "segment", "turn", "text"]
        return df.select("key", *fields).repartition("key").sortWithinPartitions(*(c for c in order if c in fields + ["key"]))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(packed)
        for group in sorted_groups(batches, "key"):
            matrix = _through(model, group["sign"].to_numpy())
            columns = [group["conv_id"].combine_chunks()[:1], group["segment"].combine_chunks()[:1]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([matrix.ravel().tolist()], pa.list_(pa.float64()))],
                names=["conv_id", "segment", "through"],
            )

    fields = ["conv_id", "segment", "turn", "text", "sign"]
    summary = stored(
        grouped(rows, fields).mapInArrow(sizes, "conv_id long, segment long, through array<double>"), "through"
    )

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "key"):
            through = np.array(group["through"].to_pylist()).reshape(group.num_rows, len(ROLES) + 1, len(ROLES))
            score, back = through[0][0], []
            for matrix in through[1:]:
                every = score[:, None] + matrix[1:]
                back.append(every.argmax(axis=0))
                score = every.max(axis=0)
            last = [int(score.argmax())]
            for step in reversed(back):
                last.append(int(step[last[-1]]))
            last = last[::-1]
            yield pa.RecordBatch.from_arrays(
                [group["conv_id"].combine_chunks(), group["segment"].combine_chunks(), pa.array([-1, *last[:-1]]), pa.array(last)],
                names=["conv_id", "segment", "before", "leave"],
            )

    # One row per segment: a conversation of a billion turns has a million of them.
    conversation = F.xxhash64(F.coalesce("conv_id", F.lit(-1)), F.col("conv_id").isNull())
    fixed = (
        grouped(summary.withColumn("key", conversation), ["conv_id", "segment", "through"])
        .mapInArrow(ends, "conv_id long, segment long, before long, leave long")
        .select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), "before", "leave")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(packed)
        for group in sorted_groups(batches, "key"):
            before, leave = group["before"][0].as_py(), group["leave"][0].as_py()
            enter = model.first if before < 0 else model.after[before]
            roles = viterbi(model, group["sign"].to_numpy(), enter, leave)
            texts = [strip_marker(text) for text in group["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    group["conv_id"].combine_chunks(),
                    group["turn"].combine_chunks(),
                    pa.array(texts, pa.string()),
                    pa.array([ROLES[r] for r in roles], pa.string()),
                ],
                names=["conv_id", "turn", "text", "role"],
            )

    both = rows.join(fixed, rows["conv_id"].eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")))
    return grouped(both, [*fields, "before", "leave"]).mapInArrow(
        decode, "conv_id long, turn long, text string, role string"
    )


_ANY_MARKER = re.compile("|".join(f"(?:{pattern})" for pattern in _MARKER.values()), re.I)


def strip_marker(text: str) -> str:
    return _ANY_MARKER.sub("", text, count=1).strip()


def render(role: Column, text: Column) -> Column:
    """A turn in canonical form."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def transcripts(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) as raw transcripts have them: two turns of three lose their speaker marker."""
    names = F.create_map(*(F.lit(x) for role, name in zip(ROLES, ("System", "User", "Assistant")) for x in (role, name)))
    marked = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0
    text = F.coalesce(F.col("text"), F.lit(""))
    marker = F.concat(F.try_element_at(names, F.coalesce(F.col("role"), F.lit(""))), F.lit(": "))
    return turns.select("conv_id", "turn", F.when(marked, F.concat(F.coalesce(marker, F.lit("")), text)).otherwise(text).alias("text"))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, rendered) of every turn of conversations, roles recovered from their transcripts."""
    found = recover(transcripts(turns), fit(turns))
    return found.select("conv_id", "turn", "role", render(F.col("role"), F.col("text")).alias("rendered"))
