"""Transcript parsing: a hidden Markov model recovers the roles of raw transcript lines before turns are rendered.

A line's hidden state is its role together with whether it begins a turn. What is seen of a line is its speaker
marker (the word in front of a colon, or in a heading, or none) and coarse features of its text. Start, transition
and emission probabilities are counts over labelled lines, smoothed.

The most likely states are found by Viterbi in three steps, so that a conversation of any length is shared by many
tasks. Lines are numbered over the whole table by range partitioning, and a conversation is cut into blocks of at
most ``BLOCK`` lines.

1. Each block yields the best score from every state before it to every state at its end, a small matrix.
2. The matrices of a conversation, one row per block, are chained from the first to the last, and the best final
   state is traced back. That fixes the states at the blocks' ends.
3. Each block finds its best path between its fixed ends.

Defined results: lines with equal positions are ordered by their text; a null line is an empty one; a null
conversation id is one conversation; lines without a known role are left out of the fit; without labelled lines all
parameters are uniform and the first role is recovered throughout. Repeated rows are lines of their own. Lines of any
length are kept whole. Columns other than those named are ignored, whatever they are called.

No text is lost: a marker is taken off only where a turn begins, and is kept in ``speaker``; whatever looks like one
inside a turn stays. What looks like a canonical header inside a turn is escaped (:func:`escaped`), so ``speaker`` and
the unescaped body give the lines back as they were.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.operators.rank import global_rank
from tallyweir.session import materialize

ROLES = ["system", "user", "assistant"]
STATES = 2 * len(ROLES)  # role * 2 + (0: begins a turn, 1: continues one)
BLOCK = 256
SMOOTHING = 0.5

#: Words by which transcripts mark speakers. Which role each stands for is learned.
MARKERS = [
    "system", "instructions", "context", "user", "human", "q", "question", "customer", "assistant", "ai", "a", "answer",
    "agent", "bot",
]
_MARKER = r"^\s*(?:#+\s*(\w+)\s*$|\**(\w+)\**\s*[:>]\s)"
OTHER, NO_MARKER = len(MARKERS), len(MARKERS) + 1
FEATURES = 6  # length (3) times question mark or not
SYMBOLS = (len(MARKERS) + 2) * FEATURES

#: Marker styles of :func:`raw_transcripts`, as system, user and assistant are written.
STYLES = [
    ("System: ", "User: ", "Assistant: "),
    ("Instructions: ", "Human: ", "AI: "),
    ("**Context**: ", "**Q**: ", "**A**: "),
    ("SYSTEM> ", "CUSTOMER> ", "AGENT> "),
]


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """Plain transcripts as they are found in the wild: ``conv_id``, ``pos``, ``line``, and the true ``role`` and ``begins``.

    A conversation writes its speakers in one of ``STYLES``; about one turn in eight has lost its marker.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    names = F.array(*(F.array(*map(F.lit, s)) for s in STYLES))
    place = F.array_position(F.array(*map(F.lit, ROLES)), F.coalesce("role", F.lit("")))
    lost = (F.pmod(F.xxhash64("conv_id", "turn", F.lit("lost")), F.lit(8)) == 0) | (place == 0)
    marker = F.when(~lost, F.get(F.get(names, style.cast("int")), (place - 1).cast("int"))).otherwise("")
    lines = conversations.select(
        "conv_id", "turn", "role", marker.alias("_m"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
    )
    return lines.select(
        "conv_id",
        F.struct(F.col("turn"), F.col("pos").alias("row")).alias("pos"),
        F.when(F.col("pos") == 0, F.concat("_m", "col")).otherwise(F.col("col")).alias("line"),
        "role",
        (F.col("pos") == 0).alias("begins"),
    )


def numbered_lines(transcripts: DataFrame) -> DataFrame:
    """Stored lines with ``rank`` over the whole table, ``block``, ``symbol`` (what the model sees) and ``marked`` (has a marker)."""
    line = F.coalesce("line", F.lit(""))
    word = F.lower(F.concat(F.regexp_extract(line, _MARKER, 1), F.regexp_extract(line, _MARKER, 2)))
    at = F.array_position(F.array(*map(F.lit, MARKERS)), word)
    marker = F.when(word == "", NO_MARKER).when(at == 0, OTHER).otherwise(at - 1)
    marked = (word != "") & (at > 0)
    body = F.when(marked, F.regexp_replace(line, _MARKER, "")).otherwise(line)
    length = F.when(F.char_length(body) < 60, 0).when(F.char_length(body) < 240, 1).otherwise(2)
    symbol = marker * FEATURES + length * 2 + F.when(F.rtrim(body).endswith("?"), 1).otherwise(0)
    extra = [c for c in ("role", "begins") if c in transcripts.columns]
    seen = transcripts.select(
        "conv_id", "pos", *extra, line.alias("line"), marked.alias("marked"), symbol.cast("int").alias("symbol")
    )
    # the stored table keeps the numbers as they are, whoever reads them
    ranked = global_rank(seen, [F.col("conv_id"), F.col("pos"), F.col("line")])
    block = F.floor(F.col("rank") / BLOCK).cast("long").alias("block")
    return materialize(ranked.select("conv_id", *extra, "line", "marked", "symbol", "rank", block), "lines")


def escaped(text: Column) -> Column:
    """``text`` with a backslash behind the ``<`` of whatever reads as a canonical header, one more than is there already."""
    return F.regexp_replace(text, rf"<(\\*)\|({'|'.join(ROLES)})\|>", r"<\\$1|$2|>")


def unescaped(text: Column) -> Column:
    """Undoes :func:`escaped`."""
    return F.regexp_replace(text, rf"<\\(\\*)\|({'|'.join(ROLES)})\|>", "<$1|$2|>")


def held_out(conv_id: Column) -> Column:
    """Whether a conversation is in the half kept from the fit, by which roles are judged."""
    return F.pmod(F.xxhash64(conv_id, F.lit("held out")), F.lit(2)) == 1


def role_accuracy(turns: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Held-out conversations: ``n_turns`` that begin in ``transcripts``, and the share recovered there with the same role.

    ``turns`` are those of :func:`recovered_turns` over the same lines, whose ``role`` and ``begins`` are the truth.
    """
    order = Window.partitionBy("conv_id").orderBy("pos", F.coalesce("line", F.lit("")))
    placed = transcripts.filter(held_out(F.col("conv_id"))).withColumn("_at", F.row_number().over(order) - 1)
    truth = placed.filter("begins").select(F.col("conv_id").alias("_conv"), "_at", F.col("role").alias("_role"))
    on = F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_at") == F.col("line"))
    right = (F.col("role") == F.col("_role")).cast("int")
    return truth.join(turns.select("conv_id", "line", "role"), on, "left").agg(
        F.count(F.lit(1)).alias("n_turns"), F.avg(F.coalesce(right, F.lit(0))).alias("accuracy")
    )


def fit(lines: DataFrame) -> dict[str, np.ndarray]:
    """Log probabilities from the labelled rows of :func:`numbered_lines`; a few hundred counts reach the driver."""
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.coalesce("role", F.lit("")))
    labelled = lines.select(
        "conv_id", "rank", "symbol", F.when(role > 0, (role - 1) * 2 + F.when(F.col("begins"), 0).otherwise(1)).alias("state")
    )
    known = labelled.filter("state is not null")
    emission, transition = np.zeros((STATES, SYMBOLS)), np.zeros((STATES + 1, STATES))
    for row in known.groupBy("state", "symbol").count().collect():
        emission[row["state"], row["symbol"]] += row["count"]
    before = labelled.select((F.col("rank") + 1).alias("rank"), F.col("conv_id").alias("_conv"), F.col("state").alias("_state"))
    pairs = known.join(before, "rank", "left").select(
        "state",
        F.when(F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("rank").isNotNull(), F.col("_state"))
        .otherwise(STATES)
        .alias("before"),
    )
    for row in pairs.filter("before is not null").groupBy("before", "state").count().collect():
        transition[row["before"], row["state"]] += row["count"]

    def log_rows(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True))

    moves = log_rows(transition)
    # only a line that begins a turn can change the role, and a conversation starts with one
    for before_state in range(STATES + 1):
        for state in range(1, STATES, 2):
            if before_state == STATES or before_state // 2 != state // 2:
                moves[before_state, state] = -np.inf
    return {"emission": log_rows(emission), "moves": moves[:STATES], "start": moves[STATES]}


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of equal ``keys`` in sorted batches, one at a time."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        group = held.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        last = int(np.argmax(group == group[-1])) if len(group) else 0
        if last:
            done, held = held.iloc[:last], held.iloc[last:].reset_index(drop=True)
            for _, run in done.groupby(group[:last], sort=False):
                yield run
    if held is not None and len(held):
        yield held


def _forward(model: dict, symbols: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Best scores per state after ``symbols``, and for each the state before; ``scores`` may hold several rows."""
    back = []
    for symbol in symbols:
        step = scores[..., :, None] + model["moves"]
        back.append(step.argmax(axis=-2))
        scores = step.max(axis=-2) + model["emission"][:, symbol]
    return scores, back


def recover_states(lines: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``rank`` and the most likely ``state`` of every line of :func:`numbered_lines`."""
    unit = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["block", "conv_id"]):
            symbols = run["symbol"].to_numpy()
            first = model["start"] + model["emission"][:, symbols[0]]
            whole = _forward(model, symbols[1:], first)[0]
            inner = _forward(model, symbols, unit)[0]
            yield pd.DataFrame(
                {
                    "conv_id": run["conv_id"].iloc[:1],
                    "block": run["block"].iloc[:1],
                    "first": [whole.tolist()],
                    "inner": [inner.ravel().tolist()],
                }
            )

    def chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["conv_id"]):
            scores, back = np.array(run["first"].iloc[0]), []
            for inner in run["inner"].iloc[1:]:
                step = scores[:, None] + np.array(inner).reshape(STATES, STATES)
                back.append(step.argmax(axis=0))
                scores = step.max(axis=0)
            ends = [int(scores.argmax())]
            for best in reversed(back):
                ends.append(int(best[ends[-1]]))
            ends.reverse()
            yield pd.DataFrame(
                {"_conv": run["conv_id"], "_block": run["block"], "entry": [-1, *ends[:-1]], "leave": ends}
            )

    def paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["block", "conv_id"]):
            symbols, entry = run["symbol"].to_numpy(), int(run["entry"].iloc[0])
            if entry < 0:
                first = model["start"] + model["emission"][:, symbols[0]]
                back = _forward(model, symbols[1:], first)[1]
            else:
                back = _forward(model, symbols, unit[entry])[1][1:]
            states = [int(run["leave"].iloc[0])]
            for best in reversed(back):
                states.append(int(best[states[-1]]))
            yield pd.DataFrame({"rank": run["rank"], "state": states[::-1]})

    compact = lines.select("conv_id", "block", "rank", "symbol")
    id_type = dict(lines.dtypes)["conv_id"]
    blocks = compact.repartition("block").sortWithinPartitions("block", "rank")
    scored = blocks.mapInPandas(
        matrices, f"conv_id {id_type}, block long, first array<double>, inner array<double>"
    )
    chain = scored.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    ends = materialize(
        chain.mapInPandas(chained, f"_conv {id_type}, _block long, entry int, leave int"), "block-ends"
    )
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    placed = compact.join(ends, on).drop("_conv", "_block")
    return placed.repartition("block").sortWithinPartitions("block", "rank").mapInPandas(paths, "rank long, state int")


def recovered_turns(
    transcripts: DataFrame, model: dict[str, np.ndarray] | None = None, fit_on: Column | None = None
) -> DataFrame:
    """One row per recovered turn: ``conv_id``, ``line`` (of its beginning, from 0), ``role``, ``n_lines``, ``speaker``, ``rendered``.

    Without a ``model``, one is fitted to the ``role`` and ``begins`` of ``transcripts``, or of the conversations with
    ``fit_on``. ``rendered`` is the canonical form: the role between bars in angle brackets, then the turn's lines,
    :func:`escaped`, the first of them without the marker in ``speaker`` (empty if there was none).
    """
    lines = numbered_lines(transcripts)
    if model is None:
        model = fit(lines if fit_on is None else lines.filter(fit_on))
    states = materialize(recover_states(lines, model), "states")
    known = lines.join(states, "rank")
    begins = (F.col("state") % 2) == 0
    # the turn a block starts within is the last one begun in the conversation's blocks before
    per_block = known.groupBy("conv_id", "block").agg(
        F.max(F.when(begins, F.col("rank"))).alias("last"), F.min("rank").alias("low")
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.max("last").over(earlier).alias("carried"),
        F.min("low").over(Window.partitionBy("conv_id")).alias("origin"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("rank")
    started = known.withColumn("_own", F.max(F.when(begins, F.col("rank"))).over(within))
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    placed = started.join(carried, on).withColumn("_turn", F.coalesce("_own", "carried", "origin"))
    strip = begins & F.col("marked")
    placed = placed.select(
        "conv_id", "_turn", "origin", "rank", "state",
        F.when(strip, F.regexp_extract("line", _MARKER, 0)).otherwise("").alias("_speaker"),
        F.when(strip, F.regexp_replace("line", _MARKER, "")).otherwise(F.col("line")).alias("_text"),
    )
    turns = placed.groupBy("conv_id", "_turn").agg(
        F.min("origin").alias("origin"),
        F.min(F.struct("rank", "state")).alias("_first"),
        F.count(F.lit(1)).alias("n_lines"),
        F.min_by("_speaker", "rank").alias("speaker"),
        F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_lines"),
    )
    role = F.get(F.array(*map(F.lit, ROLES)), F.floor(F.col("_first.state") / 2).cast("int"))
    body = F.array_join(F.transform("_lines", lambda x: x["_text"]), "\n")
    return turns.select(
        "conv_id",
        (F.col("_turn") - F.col("origin")).alias("line"),
        role.alias("role"),
        "n_lines",
        "speaker",
        F.concat(F.lit("<|"), role, F.lit("|>\n"), escaped(body), F.lit("\n")).alias("rendered"),
    )
