"""Chat formatting from an event log, in DataFrame functions only.

Input: events (conversation, sequence number, kind, message, role, text). Kinds:

* ``message``: starts a message with a role and a (possibly empty) text;
* ``delta``: a streamed piece, appended to the message's text;
* ``edit``: replaces the message's text;
* ``regenerate``: discards what was streamed for the message and starts again with its text;
* ``retract``: removes the message.

Fold: events are grouped by conversation and message and sorted by sequence number;
what counts is the last ``message``/``edit``/``regenerate`` and the deltas after it.
Messages then form a conversation in the order of their first event. Grouping by message
first keeps the sorted groups small; a conversation is gathered just as its own
messages, which is the row that comes out.

Template: user ``[INST]..[/INST]``, assistant ``[ASST]..</s>``, system ``[SYS]..[/SYS]``, any
other role ``[ROLE]role[SEP]..[/ROLE]``, all after ``<s>``. Control strings inside a text get one
backslash more (``[INST]`` becomes ``[\\INST]``, ``[\\INST]`` becomes ``[\\\\INST]``), so that
none is left, and reading back takes one away: reversible for every text.
The loss mask holds the code-point spans of the assistant texts.

Defined cases: null text or role is empty; events of equal sequence number are
ordered by kind (message first), then text; an event delivered again (same conversation,
message, sequence number, kind and text) counts once; events whose message never started make
one with an empty role; unknown kinds are ignored; a conversation without messages
gives no row; null conversation ids form one conversation; long texts and
conversations are rendered whole (a conversation is one row); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank of the kinds among events of the same sequence number (fixed values).
KINDS = {"message": 0, "edit": 1, "regenerate": 2, "delta": 3, "retract": 4}
_CONTROL = r"(/?INST\]|ASST\]|/?SYS\]|/?ROLE\]|SEP\]|/?s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)\\" + _CONTROL, r"$1$2$3")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, first_seq, message, role, text): one row for each final message."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in KINDS.items()])
    log = events.select(
        "conv_id", "seq", "message", rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).where("rank IS NOT NULL")
    step = F.struct("seq", "rank", "text")
    entries = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first_seq"),
        F.max(F.when(F.col("rank") == 0, F.struct("seq", "role"))).alias("start"),
        F.max(F.when(F.col("rank") < 3, F.struct("seq", "rank", "text"))).alias("reset"),
        F.max(F.when(F.col("rank") == 4, F.col("seq"))).alias("gone"),
        F.sort_array(F.collect_set(F.when(F.col("rank") == 3, step))).alias("deltas"))
    late = F.filter("deltas", lambda d: F.col("reset").isNull() | (d["seq"] > F.col("reset.seq"))
                    | ((d["seq"] == F.col("reset.seq")) & (d["rank"] > F.col("reset.rank"))))
    return (entries.where("gone IS NULL")
            .select("conv_id", "first_seq", "message", F.coalesce("start.role", F.lit("")).alias("role"),
                    F.concat(F.coalesce("reset.text", F.lit("")),
                             F.array_join(F.transform(late, lambda d: d["text"]), "")).alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): loss spans are (start, length) in code points, start from 0."""
    text = escape(F.col("text"))
    role = F.col("role")
    opens = (F.when(role == "user", "[INST]").when(role == "assistant", "[ASST]").when(role == "system", "[SYS]")
             .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[SEP]"))))
    closes = (F.when(role == "user", "[/INST]").when(role == "assistant", "</s>").when(role == "system", "[/SYS]")
              .otherwise("[/ROLE]"))
    turns = messages.select("conv_id", "first_seq", "message", opens.alias("o"), text.alias("x"), closes.alias("c"),
                            (role == "assistant").alias("scored"))
    # places by a running sum before the turns are gathered, so that no array grows step by step
    before = Window.partitionBy("conv_id").orderBy("first_seq", "message").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("o") + F.length("x") + F.length("c")
    placed = turns.withColumn("at", len("<s>") + F.coalesce(F.sum(size).over(before), F.lit(0)))
    conv = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("first_seq", "message", "o", "x", "c", "scored", "at"))).alias("turns"))
    whole = F.concat(F.lit("<s>"), F.array_join(F.transform("turns", lambda t: F.concat(t["o"], t["x"], t["c"])), ""))
    spans = F.transform(F.filter("turns", lambda t: t["scored"]), lambda t: F.struct(
        (t["at"] + F.length(t["o"])).cast("long").alias("start"), F.length(t["x"]).cast("long").alias("length")))
    return conv.select("conv_id", whole.alias("formatted"), spans.alias("loss_spans"))


_TURN = (r"(?s)\[INST\].*?\[/INST\]|\[ASST\].*?</s>|\[SYS\].*?\[/SYS\]|\[ROLE\].*?\[/ROLE\]")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) parsed from the output alone: turns as
    (role, text), and all text under the loss mask, unescaped."""
    parsed = formatted.select("conv_id", "loss_spans", F.length("formatted").cast("long").alias("formatted_chars"),
                              F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0)).alias("pieces"))

    def body(x, opens, closes):
        return F.substring(x, F.lit(len(opens) + 1), F.length(x) - len(opens) - len(closes))

    def turn(x):
        other = body(x, "[ROLE]", "[/ROLE]")
        mark = F.instr(other, "[SEP]")
        role = (F.when(x.startswith("[INST]"), "user").when(x.startswith("[ASST]"), "assistant")
                .when(x.startswith("[SYS]"), "system").otherwise(unescape(F.substring(other, F.lit(1), mark - 1))))
        text = (F.when(x.startswith("[INST]"), body(x, "[INST]", "[/INST]"))
                .when(x.startswith("[ASST]"), body(x, "[ASST]", "</s>"))
                .when(x.startswith("[SYS]"), body(x, "[SYS]", "[/SYS]"))
                .otherwise(F.substring(other, mark + 5, F.length(other))))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    # the k-th span lies in the k-th turn of an assistant; cut from that turn, not from the whole text again
    spoken = F.filter("pieces", lambda x: x.startswith("[ASST]"))
    loss = F.array_join(F.zip_with(spoken, "loss_spans", lambda x, s: unescape(
        F.substring(x, F.lit(len("[ASST]") + 1), s["length"].cast("int")))), "")
    return parsed.select("conv_id", F.transform("pieces", turn).alias("turns"), loss.alias("loss_text"), "formatted_chars")


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of an event log."""
    return render(fold(events))
