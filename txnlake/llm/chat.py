"""Chat formatting with typed content parts, in DataFrame functions only.

A message is a row of (conversation, turn, role, parts). A visitor flattens the parts in order:
text is escaped, and an image, audio or document part becomes one placeholder, an attachment
record (turn, part, kind, reference, expanded tokens) and a count of the model tokens that the
placeholder stands for.

The template is ``<|turn|>role<|body|>text<|end|>`` for each turn. Control strings inside roles
and texts are broken by a backslash after their first character, after all backslashes were
doubled; ``unescape`` undoes both, so the output can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

#: Strings that may not stand in a formatted text: every ``<|``, and the marks of other
#: common templates, which tokenizers take for control tokens as well.
_AFTER_FIRST = r"\||/?s>"
_AFTER_BRACKET = r"/?INST\]"

PARTS = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,"
    "seconds:double,pages:int>>"
)


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    broken = F.regexp_replace(doubled, rf"<(?={_AFTER_FIRST})", r"<\\")
    return F.regexp_replace(broken, rf"\[(?={_AFTER_BRACKET})", r"[\\")


def unescape(text: Column) -> Column:
    joined = F.regexp_replace(text, rf"<\\(?={_AFTER_FIRST})", "<")
    joined = F.regexp_replace(joined, rf"\[\\(?={_AFTER_BRACKET})", "[")
    return F.replace(joined, F.lit("\\\\"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """One text part; NULL text is empty."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


def _ceil_div(value: Column, by: int) -> Column:
    return F.ceil(F.coalesce(value, F.lit(0)) / F.lit(by)).cast("long")


def part_tokens(part: Column, patch: int, tokens_per_second: int, tokens_per_page: int) -> Column:
    """Model tokens a placeholder expands to; at least one for each attachment, none for text."""
    tokens = (
        F.when(part["kind"] == "image", _ceil_div(part["width"], patch) * _ceil_div(part["height"], patch))
        .when(
            part["kind"] == "audio",
            F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * tokens_per_second).cast("long"),
        )
        .when(
            part["kind"] == "document",
            F.coalesce(part["pages"], F.lit(0)).cast("long") * tokens_per_page,
        )
    )
    return F.when(tokens.isNull(), F.lit(0).cast("long")).otherwise(F.greatest(tokens, F.lit(1)))


def _body(parts: Column) -> Column:
    """The visited parts as one string. Texts that stand next to each other are escaped as one, so
    a control string cannot come together from pieces."""
    empty = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))

    def visit(seen: Column, part: Column) -> Column:
        mark = F.lit(None).cast("string")
        for kind, placeholder in PLACEHOLDERS.items():
            mark = F.when(part["kind"] == kind, F.lit(placeholder)).otherwise(mark)
        done = F.when(mark.isNull(), seen["done"]).otherwise(F.concat(seen["done"], escape(seen["run"]), mark))
        run = F.when(mark.isNull(), F.concat(seen["run"], F.coalesce(part["text"], F.lit("")))).otherwise("")
        return F.struct(done.alias("done"), run.alias("run"))

    return F.aggregate(parts, empty, visit, lambda seen: F.concat(seen["done"], escape(seen["run"])))


def flatten_parts(
    messages: DataFrame, patch: int = 14, tokens_per_second: int = 25, tokens_per_page: int = 256
) -> DataFrame:
    """Messages (conv_id, turn, role, parts) with body, attachments and expanded_tokens.

    Parts keep their order. NULL parts or an empty list give an empty body; a part of an
    unknown kind counts as text; a NULL size counts as zero.
    """
    tokens = lambda p: part_tokens(p, patch, tokens_per_second, tokens_per_page)
    parts = F.filter(F.coalesce(F.col("parts"), F.expr(f"cast(array() as {PARTS})")), lambda p: p.isNotNull())
    attachments = F.filter(
        F.transform(
            parts,
            lambda p, i: F.struct(
                F.col("turn").alias("turn"),
                i.alias("part"),
                p["kind"].alias("kind"),
                p["ref"].alias("ref"),
                tokens(p).alias("tokens"),
            ),
        ),
        lambda a: a["kind"].isin(*PLACEHOLDERS),
    )
    return messages.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        _body(parts).alias("body"),
        attachments.alias("attachments"),
        F.aggregate(
            F.transform(parts, tokens), F.lit(0).cast("long"), lambda s, t: s + t
        ).alias("expanded_tokens"),
    )


def format_chats(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), **sizes: int) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_runs, attachments, expanded_tokens.

    Turns follow turn, then role, then body (NULL turns first), so equal turn numbers and
    repeated rows have one order and all are kept. ``loss_runs`` is the loss mask as runs of
    (chars, loss) in code points that cover the formatted text without gaps; only the escaped
    body of a turn of a loss role is under it. A NULL conv_id is a conversation of its own.
    """
    visited = flatten_parts(messages, **sizes)
    turns = F.array_sort(
        F.collect_list(F.struct("turn", "role", "body", "attachments", "expanded_tokens"))
    )
    chats = visited.groupBy("conv_id").agg(turns.alias("turns"))
    text = lambda t: F.concat(
        F.lit(TURN), escape(t["role"]), F.lit(BODY), t["body"], F.lit(END)
    )
    runs = lambda t: F.array(
        F.struct(
            (F.length(escape(t["role"])) + len(TURN) + len(BODY)).alias("chars"),
            F.lit(False).alias("loss"),
        ),
        F.struct(F.length(t["body"]).alias("chars"), t["role"].isin(*loss_roles).alias("loss")),
        F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")),
    )
    return chats.select(
        "conv_id",
        F.array_join(F.transform("turns", text), "").alias("formatted"),
        F.flatten(F.transform("turns", runs)).alias("loss_runs"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate(
            F.transform("turns", lambda t: t["expanded_tokens"]),
            F.lit(0).cast("long"),
            lambda s, t: s + t,
        ).alias("expanded_tokens"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Read formatted chats back: conv_id, turns (role, text), loss_text, and the given columns.

    Splits at the control strings, which no escaped text can hold. The third run of the mask
    is that of the end mark, so run 3i+1 belongs to the body of turn i. Placeholders of
    attachments stay in the text as they are.
    """
    split = F.filter(
        F.split(F.col("formatted"), r"<\|turn\|>|<\|end\|>"), lambda piece: piece != ""
    )
    turns = F.transform(
        split,
        lambda piece: F.struct(
            unescape(F.substring_index(piece, BODY, 1)).alias("role"),
            unescape(F.substring_index(piece, BODY, -1)).alias("text"),
        ),
    )
    with_turns = chats.withColumn("turns", turns)
    bodies = F.filter("loss_runs", lambda _, i: i % 3 == 1)
    under_mask = F.filter(
        F.arrays_zip(F.col("turns").alias("turn"), bodies.alias("run")), lambda z: z["run"]["loss"]
    )
    return with_turns.withColumn(
        "loss_text", F.array_join(F.transform(under_mask, lambda z: z["turn"]["text"]), "")
    )


def chat_digest(read: DataFrame) -> DataFrame:
    """The digest columns of chats that were read back."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
