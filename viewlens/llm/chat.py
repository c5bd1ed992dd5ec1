"""Chat formatting in token-budgeted windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
TURN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"(<(?=/?s>)|\[(?=/?INST\]))"

BUDGET = 1024
#: Tokens of earlier turns that a window may repeat.
HISTORY = 256
#: Turns in a block of the prefix sums; only sums of blocks meet in one place.
BLOCK = 256
TARGET = "assistant"


def escape(text: Column) -> Column:
    r"""Doubles ``\`` and puts ``\.`` into control strings, which then occur nowhere."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|\.)", "$1")


def token_count(text: Column) -> Column:
    """Words and marks, about what a tokenizer would make of common words; one at least."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, role, text, tokens, pos (from 0) and before (tokens of earlier turns).

    Turns are ordered by (turn, role, text); a null turn comes first, null role and
    text count as empty. Numbers and sums are made within blocks of turn numbers,
    and only the sums of blocks within a conversation, so a long conversation is
    not ordered in one place.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns(
        {
            "tokens": token_count(F.col("text")).cast("long"),
            "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))),
        }
    )
    blocks = turns.groupBy("conv_id", "block").agg(
        F.count("*").alias("block_turns"), F.sum("tokens").alias("block_tokens")
    )
    earlier = (
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = blocks.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.coalesce(F.sum("block_turns").over(earlier), F.lit(0)).alias("first_pos"),
        F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("first_before"),
    )
    joined = turns.join(
        starts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    )
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(
        "conv_id",
        "role",
        "text",
        "tokens",
        (F.col("first_pos") + F.row_number().over(order) - 1).alias("pos"),
        (F.col("first_before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("before"),
    )


def window_turns(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """One row for each turn of each window: (conv_id, window, part, pos, role, text).

    New turns go to window ``before // span`` of the prefix sums, where span is
    half of what the budget leaves beside the history: a window's new turns have
    less than span tokens before its last turn, so they fit if no turn has more
    than span, and a larger turn ends its window. part is 0 for the system turn of a
    window that does not begin with it, 1 for history and 2 for new turns. History
    repeats those last turns of the window before that have ``history`` tokens at
    most. The leading system turn counts in no window but the first.
    """
    span = max(1, (budget - history) // 2)
    first_system = (F.col("pos") == 0) & (F.col("role") == "system")
    placed = turns.withColumn("window", F.floor(F.col("before") / span))
    ends = placed.groupBy("conv_id", "window").agg(
        F.max(F.col("before") + F.col("tokens")).alias("window_end")
    )
    # Windows without new turns do not exist, so they are numbered without gaps.
    order = Window.partitionBy("conv_id").orderBy("window")
    ends = ends.select(
        F.col("conv_id").alias("_conv"),
        F.col("window").alias("_window"),
        "window_end",
        (F.row_number().over(order) - 1).cast("int").alias("number"),
        F.lead("window").over(order).isNotNull().alias("followed"),
    )
    rows = placed.join(
        ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("window") == F.col("_window"))
    )
    repeated = (
        F.col("followed")
        & (F.col("window_end") - F.col("before") <= history)
        & ~first_system
    )
    new = F.struct(F.col("number").alias("window"), F.lit(2).alias("part"))
    again = F.struct((F.col("number") + 1).alias("window"), F.lit(1).alias("part"))
    spread = rows.select(
        "conv_id", "pos", "role", "text",
        F.explode(F.filter(F.array(new, F.when(repeated, again)), lambda x: x.isNotNull())).alias("at"),
    ).select("conv_id", "at.window", "at.part", "pos", "role", "text")
    system = placed.where(first_system).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text")
    )
    retained = (
        ends.where("number > 0")
        .select(F.col("_conv").alias("conv_id"), F.col("number").alias("window"))
        .join(system, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .select(
            "conv_id", "window", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"),
            F.col("_role").alias("role"), F.col("_text").alias("text"),
        )
    )
    return spread.unionByName(retained)


def format_windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, target: str = TARGET
) -> DataFrame:
    """Windows of formatted conversations: conv_id, window, text, first_pos, loss_spans.

    A turn is written as ``<s>[INST]role[/INST]text</s>`` with control strings inside
    roles and texts escaped. ``loss_spans`` are (start, length) in characters of
    the window's text, counted from 0, of the new turns of role ``target``; what
    a window repeats is never under the mask, so each target is under it once.
    Only the turns of one window are brought together, which the budget bounds;
    a single turn is never cut. ``n_repeated`` turns at the start are repeated.

    A null conv_id is one conversation like others. An empty table gives no
    windows. Equal rows are turns of their own. Extra columns are ignored.
    """
    turns = window_turns(numbered_turns(conversations), budget, history)
    head = F.concat(F.lit(TURN + OPEN), escape(F.col("role")), F.lit(CLOSE))
    written = turns.select(
        "conv_id", "window",
        F.struct(
            "part", "pos", head.alias("head"), escape(F.col("text")).alias("body"),
            ((F.col("part") == 2) & (F.col("role") == target)).alias("target"),
        ).alias("turn"),
    )
    gathered = written.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    size = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(END)
    nothing = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:long,length:long>>").alias("spans"),
    )

    def extend(state: Column, t: Column) -> Column:
        start = state["at"] + F.char_length(t["head"])
        span = F.struct(
            start.cast("long").alias("start"),
            F.char_length(t["body"]).cast("long").alias("length"),
        )
        return F.struct(
            (state["at"] + size(t)).cast("long").alias("at"),
            F.when(t["target"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    text = F.array_join(
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
    )
    return gathered.select(
        "conv_id",
        "window",
        text.alias("text"),
        F.size(F.filter("turns", lambda t: t["part"] < 2)).alias("n_repeated"),
        F.aggregate("turns", nothing, extend, lambda s: s["spans"]).alias("loss_spans"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """The turns of formatted windows: conv_id, window, at, role, text, loss.

    Only new turns are returned, so each turn of a conversation comes once; at
    orders them within a window, and loss is their text under the mask, or null.
    """
    pieces = F.split(F.col("text"), END, -1)
    turn = windows.select(
        "conv_id",
        "window",
        "n_repeated",
        "loss_spans",
        F.col("text").alias("window_text"),
        F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("at", "piece"),
        F.transform(
            F.sequence(F.lit(1), F.size(pieces)),
            lambda n: F.aggregate(
                F.slice(pieces, 1, n - 1),
                F.lit(0).cast("long"),
                lambda s, p: s + F.char_length(p) + len(END),
            ),
        ).alias("starts"),
    ).where(F.col("at") >= F.col("n_repeated"))
    border = F.instr(F.col("piece"), CLOSE)
    role = F.substring(
        F.col("piece"), F.lit(len(TURN + OPEN) + 1), border - 1 - len(TURN + OPEN)
    )
    body_start = F.element_at("starts", F.col("at") + 1) + border + len(CLOSE) - 1
    masked = F.filter("loss_spans", lambda s: s["start"] == body_start)
    span = F.element_at(masked, 1)
    return turn.select(
        "conv_id",
        "window",
        "at",
        unescape(role).alias("role"),
        unescape(F.substring(F.col("piece"), border + len(CLOSE), F.lit(1 << 30))).alias("text"),
        F.when(
            F.size(masked) > 0,
            unescape(
                F.substring(
                    F.col("window_text"),
                    (span["start"] + 1).cast("int"),
                    span["length"].cast("int"),
                )
            ),
        ).alias("loss"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Of each conversation, read back from its windows: counts, lengths and digests.

    Returns conv_id, n_turns, turns_sha256 (of role, line end, text, line end for
    each turn), loss_chars and loss_sha256 (of the texts under the mask), and
    formatted_chars. The digest of a whole conversation needs its text in one row.
    """
    turns = read_turns(windows)
    read = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "at", "role", "text", "loss"))).alias("turns")
    )
    sizes = windows.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.sum(F.char_length("text")).alias("formatted_chars")
    )
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(F.transform("turns", lambda t: t["loss"]), "")
    return read.join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
