"""Chat transcripts from event logs, rendered for training and read back.

Rendered form: each turn is ``<|im_start|>role``, a line end, the text,
``<|im_end|>`` and a line end.  A control string inside a text gets one more
quoting mark after its first character, whether it has some already or not, so
no text can close a turn and unquoting takes exactly one mark away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template and of common instruction formats.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<unk>", "[INST]",
           "[/INST]", "<<SYS>>", "<</SYS>>"]
START, END = "<|im_start|>", "<|im_end|>"
MARK = "​"  # zero-width space
_TAILS = "|".join(
    c[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]")for c in CONTROL
)
QUOTE = rf"([<\[]{MARK}*)(?=(?:{_TAILS}))"
UNQUOTE = rf"([<\[]{MARK}*){MARK}(?=(?:{_TAILS}))"


def quote(text: Column) -> Column:
    return F.regexp_replace(text, QUOTE, f"$1{MARK}")


def unquote(text: Column) -> Column:
    return F.regexp_replace(text, UNQUOTE, "$1")


def quote_role(role: Column) -> Column:
    """A role ends at the first line end, so its own are written otherwise."""
    return quote(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;")))


def unquote_role(role: Column) -> Column:
    return F.replace(
        F.replace(unquote(role), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&")
    )


def message_events(rows: DataFrame) -> DataFrame:
    """Finished messages (conv_id, turn, role, text) as events, one ``message`` a row.

    Rows that share a turn are messages of their own, by role and text; rows that
    repeat altogether stay as many as they are.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    same = rows.groupBy(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        empty("role").alias("role"), empty("text").alias("text"),
    ).agg(F.count(F.lit(1)).alias("copies"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return same.withColumn("copy", copies).select(
        "conv_id",
        F.struct("turn", "role", "text", "copy").alias("message"),
        F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text",
    )


def reconstruct(events: DataFrame) -> DataFrame:
    """Fold (conv_id, message, seq, kind, role, text) events to one row per final message.

    Kinds: ``message`` opens a message with its first text, ``delta`` adds to it,
    ``edit`` replaces what there is, ``regenerate`` empties it for the deltas that
    follow, ``delete`` removes it until a later event opens it again; others are
    ignored.  Events count in the order of ``seq``, equal ones by kind, role and
    text; deltas before any opening build the message alone.  The role is that of
    the last event that names one.  ``message`` is any value that sorts messages.
    Nulls in role and text are empty, in seq first, in kind ignored.
    """
    known = events.where(F.col("kind").isin("message", "delta", "edit", "regenerate", "delete"))
    step = F.struct(
        F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), "kind",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    log = known.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(step)).alias("log"))
    # The last event that is no delta decides from where the texts count.
    places = F.transform("log", lambda e, i: F.when(e.kind != "delta", i + 1).otherwise(F.lit(0)))
    log = log.withColumn("since", F.array_max(places))
    live = F.slice("log", F.greatest("since", F.lit(1)), F.size("log"))
    texts = F.transform(
        live, lambda e: F.when(e.kind.isin("regenerate", "delete"), F.lit("")).otherwise(e.text)
    )
    named = F.filter("log", lambda e: e.role != "")
    gone = (F.col("since") > 0) & (F.get("log", F.col("since") - 1)["kind"] == "delete") & (
        F.col("since") == F.size("log")
    )
    return log.where(~gone).select(
        "conv_id", "message",
        F.coalesce(F.get(named, F.size(named) - 1)["role"], F.lit("")).alias("role"),
        F.array_join(texts, "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of final messages (conv_id, message, role, text).

    ``loss_spans`` are (start, length) in code points of the assistant's texts.
    """
    shown = messages.select(
        "conv_id", "message", (F.col("role") == "assistant").alias("learn"),
        F.concat(F.lit(START), quote_role(F.col("role")), F.lit("\n")).alias("head"),
        quote(F.col("text")).alias("body"),
    )
    turns = shown.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("message", "learn", "head", "body"))).alias("turns")
    )
    tail = END + "\n"
    formatted = F.array_join(
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), ""
    )
    sizes = F.transform(
        "turns", lambda t: F.struct(
            t["learn"].alias("learn"), F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body")
        )
    )
    walk = F.aggregate(
        F.col("sizes"),
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["body"] + len(tail)).alias("at"),
            F.when(
                t["learn"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return turns.select("conv_id", formatted.alias("formatted"), sizes.alias("sizes")).select(
        "conv_id", "formatted", walk.alias("loss_spans")
    )


def read_back(formatted: str = "formatted") -> Column:
    """The (role, text) turns of a rendered transcript."""
    pieces = F.filter(
        F.split(F.col(formatted), START.replace("|", r"\|"), -1), lambda p: p != ""
    )
    end = F.lit("\n")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unquote_role(F.substring_index(p, "\n", 1)).alias("role"),
            unquote(F.substring(
                p,
                F.instr(p, end) + 1,
                F.length(p) - F.instr(p, end) - len(END) - 1,
            )).alias("text"),
        ),
    )


def learned(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unquoted, nothing between."""
    return F.array_join(
        F.transform(
            F.col(spans), lambda s: unquote(F.substring(F.col(formatted), s["start"] + 1, s["length"]))
        ),
        "",
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of finished messages; see :func:`message_events`."""
    return render(reconstruct(message_events(rows)))
