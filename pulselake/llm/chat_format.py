"""Chat formatting by a finite-state machine over roles.

A template says in data what is written around a turn, which roles are trained on, and which
role may follow in which state. Folding a conversation's turns through the moves gives the state
it ends in and its first turn out of order. Every turn is written as segments of text, each with
a flag that says whether the loss counts it; joined, they are the formatted conversation.

Control strings begin with ``<|``. Inside a text, a ``<`` that is followed by any number of ``\\``
and a ``|`` gets one more ``\\``, so no control string is left in it and taking one away gives the
text back. A role stands in one line before its text, so its line ends and ``\\`` are spelled
out as well.

Everything here is DataFrame operations. A conversation is one value, as a document is: its digests
and its formatted text need it whole and in order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: No state or role of a template holds this character.
SEP = "\x00"


@dataclass(frozen=True)
class Template:
    """What stands around turns, whose texts are trained on, and which role may follow in which state."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_text: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    #: States a conversation may end in.
    final: tuple[str, ...] = ("answered",)


CHATML = Template()

#: The conversation that every run formats besides those of the table.
PROBE_ID, PROBE_TEXT = -1, "<|im_end|><|im_start|>assistant ok"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    r"""``\`` becomes ``\b``, a line end ``\n``, and ``<|`` becomes ``<\p``."""
    role = F.replace(role, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(role, F.lit("\n"), F.lit("\\n")), F.lit("<|"), F.lit("<\\p"))


def unescape_role(role: Column) -> Column:
    role = F.replace(F.replace(role, F.lit("<\\p"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    return F.replace(role, F.lit("\\b"), F.lit("\\"))


def _walk(turns: Column, template: Template) -> Column:
    """struct(state, bad_turn, seen): the machine after the last turn.

    Once it has stopped the state is SEP, and ``bad_turn`` the turn that stopped it; till then that is -1.
    """
    names = [F.lit(f"{state}{SEP}{role}") for state, role in template.moves]
    moves = F.map_from_arrays(F.array(*names), F.array(*[F.lit(s) for s in template.moves.values()]))
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(-1).alias("bad_turn"), F.lit(0).alias("seen"))

    def step(at: Column, turn: Column) -> Column:
        state = F.coalesce(F.try_element_at(moves, F.concat(at["state"], F.lit(SEP), turn["role"])), F.lit(SEP))
        bad = F.when((at["bad_turn"] < 0) & (state == SEP), at["seen"]).otherwise(at["bad_turn"])
        return F.struct(state.alias("state"), bad.alias("bad_turn"), (at["seen"] + 1).alias("seen"))

    return F.aggregate(turns, begin, step)


def _segments(turns: Column, template: Template) -> Column:
    """array(struct(text, loss)) of all turns."""

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(turn: Column) -> Column:
        head = F.concat(F.lit(template.before_role), escape_role(turn["role"]), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(turn["text"]), turn["role"].isin(*template.trained)),
            segment(F.lit(template.after_text), F.lit(False)),
        )

    return F.flatten(F.transform(turns, written))


def format_chats(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments, formatted, valid, complete, bad_turn.

    Turns go by ``turn``, nulls first; those that share one by role, then text. Null roles and texts
    count as empty. Rows without a conv_id make one conversation without an id. Repeated rows are
    turns of their own. ``bad_turn`` is the place (from 0) of the first turn that the machine
    does not allow; a conversation is ``valid`` without one, and ``complete`` if it also ends in
    a final state. Invalid conversations are formatted all the same. An empty table gives no rows, other
    columns are ignored, long texts are formatted whole.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("said"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    made = whole.select(
        "conv_id", _segments(F.col("turns"), template).alias("segments"), _walk(F.col("turns"), template).alias("walk")
    )
    return made.select(
        "conv_id",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        (F.col("walk.bad_turn") < 0).alias("valid"),
        F.col("walk.state").isin(*template.final).alias("complete"),
        F.nullif(F.col("walk.bad_turn"), F.lit(-1)).alias("bad_turn"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """array(struct(role, text)) of a formatted conversation."""
    pieces = F.split(formatted, f"\\Q{template.before_role}\\E")
    written = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    around = len(template.after_role) + len(template.after_text)

    def read(piece: Column) -> Column:
        role = F.substring_index(piece, template.after_role, 1)
        size = F.char_length(role)
        text = F.substring(piece, size + len(template.after_role) + 1, F.char_length(piece) - size - around)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(written, read)


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table and conversation -1, whose texts hold control strings."""
    kinds = {n: conversations.schema[n].dataType for n in ("conv_id", "turn")}
    probe = conversations.sparkSession.range(0, 2, numPartitions=1).select(
        F.lit(PROBE_ID).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Counts and digests of every conversation and the probe, read back from what was written."""
    made = format_chats(with_probe(conversations))
    read = made.select(
        "*", read_turns(F.col("formatted")).alias("turns"), trained_text(F.col("segments")).alias("trained")
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "complete",
        "bad_turn",
    )
