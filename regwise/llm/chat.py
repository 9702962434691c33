"""Chat formatting: conversations are rebuilt from an event log, then rendered with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
HEAD, TAIL = "### ", "\n</turn>\n"
# control string -> its code after the escape sign; the sign itself is doubled
ESCAPE = "\\"
CODES = {"###": "h", "</turn>": "t"}
NEWLINE = "n"  # in role names only, which stand on one line
RESETS = ("message", "edit", "regenerate")


def escape(text: Column, line: bool = False) -> Column:
    """``text`` without any control string; ``unescape`` gives it back."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control, code in CODES.items():
        out = F.replace(out, F.lit(control), F.lit(ESCAPE + code))
    return F.replace(out, F.lit("\n"), F.lit(ESCAPE + NEWLINE)) if line else out


def unescape(text: Column) -> Column:
    """One pass from the left: doubled signs part the text, between them a sign always opens a code."""
    def codes(part: Column) -> Column:
        for control, code in (CODES | {"\n": NEWLINE}).items():
            part = F.replace(part, F.lit(ESCAPE + code), F.lit(control))
        return part
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), codes), ESCAPE)


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, message, turn, role, text``: the final messages of an event log.

    The log has ``conv_id, message, seq, turn, kind, role, text``. Events of a
    message are taken by ``seq`` (ties by kind, role and text). A ``message``,
    ``edit`` or ``regenerate`` event replaces what the message held, a
    ``delta`` adds to its end; other kinds change nothing. The last turn and
    role given count. Null texts add nothing; a null conversation or message
    is a group of its own; repeated events count as often as they stand there.
    """
    event = F.struct("seq", "kind", "role", "text", "turn")
    events = log.where(F.col("kind").isin(*RESETS, "delta")).groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("e"))
    last = F.array_position(F.transform(F.reverse("e"), lambda e: e["kind"].isin(*RESETS)), F.lit(True))
    since = F.when(last > 0, F.slice("e", F.size("e") - last.cast("int") + 1, last.cast("int"))).otherwise(F.col("e"))
    latest = lambda name: F.element_at(F.filter(F.transform("e", lambda e: e[name]), lambda x: x.isNotNull()), -1)
    some = lambda name: F.when(F.exists("e", lambda e: e[name].isNotNull()), latest(name))
    text = F.array_join(F.transform(since, lambda e: F.coalesce(e["text"], F.lit(""))), "")
    return events.select("conv_id", "message", some("turn").alias("turn"), some("role").alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: one text per conversation, and the spans (start, length in code points) that are trained on.

    Messages stand in order of turn (ties by role, text and message; null turns
    first); a null role or text is empty. ``loss`` covers the escaped texts of
    the assistant, each once. A conversation is one output value, so its turns
    meet in one row; turns of a hot conversation are combined from their
    events, escaped and measured before that.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    parts = messages.select("conv_id", "turn", role.alias("role"), text.alias("text"), "message",
                            F.concat(F.lit(HEAD), escape(role, line=True), F.lit(":\n")).alias("head"), escape(text).alias("body"))
    piece = F.concat("head", "body", F.lit(TAIL))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "message")
    ahead = F.sum(F.length(piece)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.select("conv_id", "turn", "role", "text", "message", piece.alias("piece"),
                          (F.coalesce(ahead, F.lit(0)) + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    rows = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "length", "role", "piece"))).alias("p"))
    said = F.filter("p", lambda p: p["role"] == ASSISTANT)
    return rows.select("conv_id", F.array_join(F.transform("p", lambda p: p["piece"]), "").alias("formatted"),
                       F.transform(said, lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))).alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered text: ``array<struct<role, text>>``."""
    pieces = F.split(formatted, TAIL, -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.substring(head, F.lit(len(HEAD) + 1), F.length(head) - (len(HEAD) + 1))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, F.length(head) + 2, F.length(piece))).alias("text"))
    return F.transform(turns, turn)


def under_mask(formatted: Column, loss: Column) -> Column:
    """The unescaped texts that the loss mask covers, in order."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def as_log(conversations: DataFrame) -> DataFrame:
    """An event log of finished conversations: a draft, its deltas, and the edit or regeneration that replaced it.

    Every row becomes one message, whatever its ids; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), text.alias("text")).withColumn("message", F.monotonically_increasing_id())
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))
    redo = F.when(F.col("role") == ASSISTANT, "regenerate").otherwise("edit")
    events = [("message", second), ("delta", F.lit("…")), (redo, F.lit("")), ("delta", first), ("delta", second)]
    return rows.select("conv_id", "message", "turn", "role", F.inline(F.array(*[
        F.struct(F.lit(i).cast("long").alias("seq"), (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), t.alias("event_text"))
        for i, (kind, t) in enumerate(events)]))).withColumnRenamed("event_text", "text")


def formatted(log: DataFrame) -> DataFrame:
    return render(fold(log))
