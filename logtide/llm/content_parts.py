"""Chat formatting over typed content parts.

A turn's content is an array of parts with a ``type``. The visitor of the type
turns a part into text: text parts with control strings escaped, image, audio and
document parts into a placeholder, in order. Attachment references and the token
counts that placeholders expand to are recorded beside the text. A turn is

    <|turn|>role<|text|>parts<|end|>

Control strings start with ``<|``. In texts and roles every ``<`` becomes ``<~``, so no
``<|`` can arise there, also not where two parts or a part and a placeholder meet, and
the change can be undone in any stretch of text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART_TYPE = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<~"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<~"), F.lit("<"))


@dataclass(frozen=True)
class Visitor:
    """How parts of one type become text, and how many tokens they expand to."""

    render: Callable[[Column], Column]
    tokens: Callable[[Column], Column]
    attachment: bool = True


def _placeholder(name: str, default_tokens: int) -> Visitor:
    return Visitor(
        lambda part: F.lit(f"<|{name}|>"),
        lambda part: F.coalesce(part["tokens"], F.lit(default_tokens).cast("long")),
    )


#: Tokens count for a part that does not state its own.
VISITORS: dict[str, Visitor] = {
    "text": Visitor(
        lambda part: escaped(F.coalesce(part["text"], F.lit(""))),
        lambda part: F.lit(0).cast("long"),
        attachment=False,
    ),
    "image": _placeholder("image", 256),
    "audio": _placeholder("audio", 128),
    "document": _placeholder("document", 1024),
}
_OTHER = _placeholder("other", 0)


def _visited(part: Column, visitors: dict[str, Visitor], pick) -> Column:
    found = None
    for name, visitor in visitors.items():
        case = part["type"] == name
        found = F.when(case, pick(visitor)) if found is None else found.when(case, pick(visitor))
    return found.otherwise(pick(_OTHER))


def text_parts(text: Column) -> Column:
    """Content of one text part; null text is empty."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text.cast("string"), F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("long").alias("tokens"),
        )
    )


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts: Column | str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
    visitors: dict[str, Visitor] | None = None,
) -> DataFrame:
    """One row per conversation, from one row per turn.

    ``formatted`` is the text; ``loss_mask`` has one flag per turn for its part
    text; ``attachments`` lists turn number, type, reference and expanded tokens
    in order; ``placeholder_tokens`` is their sum. Turns go by turn number, ties by
    role and text, nulls first; repeated rows are turns of their own. Null content
    has no parts, a null role is empty, a part of an unknown type becomes
    ``<|other|>``. A row without a conversation is one of its own, so such rows spread
    over tasks. Whole texts of any length; other columns are left out, so no name
    clashes; no rows give no rows. Turns meet in one shuffle on the conversation, which
    becomes one text and so has to fit a row.
    """
    visitors = VISITORS if visitors is None else visitors
    content = F.col(parts) if isinstance(parts, str) else parts
    content = F.coalesce(content.cast(PART_TYPE), F.array().cast(PART_TYPE))
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.when(F.col(f"`{conv_col}`").isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            role.alias("role"),
            F.array_join(
                F.transform(content, lambda p: _visited(p, visitors, lambda v: v.render(p))), ""
            ).alias("body"),
            F.filter(
                F.transform(
                    content,
                    lambda p: F.struct(
                        _visited(p, visitors, lambda v: F.lit(v.attachment)).alias("keep"),
                        p["type"].alias("type"),
                        p["ref"].alias("ref"),
                        _visited(p, visitors, lambda v: v.tokens(p)).alias("tokens"),
                    ),
                ),
                lambda a: a["keep"],
            ).alias("attached"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    attachments = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                t["attached"],
                lambda a: F.struct(
                    i.alias("turn_no"), a["type"].alias("type"), a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return ordered.select(
        "conv_id",
        F.array_join(
            F.transform(
                "turns",
                lambda t: F.concat(
                    F.lit(TURN), escaped(t["role"]), F.lit(TEXT), t["body"], F.lit(END)
                ),
            ),
            "",
        ).alias("formatted"),
        F.transform("turns", lambda t: t["role"].isin(*loss_roles)).alias("loss_mask"),
        attachments.alias("attachments"),
    ).withColumn(
        "placeholder_tokens",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]),
    )


_PLACEHOLDER = r"<\|[a-z]+\|>"


def _bodies(formatted: Column) -> Column:
    pieces = F.split(formatted, r"<\|end\|>", -1)
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def read_turns(formatted: Column, placeholders: bool = True) -> Column:
    """Array of role and text per turn, read back from a formatted conversation.

    Placeholders stay in the text as they are, or are left out.
    """

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        body = F.substring_index(piece, TEXT, -1)
        if not placeholders:
            body = F.regexp_replace(body, _PLACEHOLDER, "")
        return F.struct(
            unescaped(F.substring(role, len(TURN) + 1, 1 << 30)).alias("role"),
            unescaped(body).alias("text"),
        )

    return F.transform(_bodies(formatted), turn)


def read_loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, without placeholders."""
    texts = F.zip_with(
        _bodies(formatted),
        loss_mask,
        lambda piece, loss: F.when(
            loss, unescaped(F.regexp_replace(F.substring_index(piece, TEXT, -1), _PLACEHOLDER, ""))
        ).otherwise(""),
    )
    return F.array_join(texts, "")
