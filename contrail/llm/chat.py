"""Chat formatting with typed content parts (native DataFrame functions only).

A turn's content is an array of typed parts. A visitor maps each part to the piece of
text that stands for it: a text part to its own text with control strings escaped, an
image, audio or document part to a placeholder. Placeholders stand in order: the k-th
placeholder of a conversation belongs to the k-th entry of its ``attachments``, which
holds the reference and the number of tokens that the placeholder expands to.

The formatted conversation is an ordered list of segments (text, loss), as trainers
read it; ``formatted`` is their concatenation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One typed part; fields that a type does not use are null.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Template:
    """Marks of a chat template. Every mark starts with a character that it holds nowhere else."""
    begin: str = "<s>"
    roles: Mapping[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[BOT]", "</s>")})
    #: any other role: opening mark, mark between its name and its content, closing mark
    other: tuple[str, str, str] = ("[ROLE]", "[:]", "[/ROLE]")
    placeholders: Mapping[str, str] = field(default_factory=lambda: {
        "image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"})
    #: a part of any other type
    unknown: str = "[PART]"
    #: the text parts of these roles are under the loss mask
    loss_roles: tuple[str, ...] = ("assistant",)
    escape: str = "\\"
    #: tokens of an image: one per patch of this many pixels a side; of unknown size: ``image_default``
    patch: int = 28
    image_default: int = 256
    audio_per_second: float = 12.5
    per_page: int = 768

    def __post_init__(self):
        for mark in self.marks():
            if len(mark) < 2 or self.escape in mark or any(other[0] in mark[1:] for other in self.marks()):
                raise ValueError(f"mark {mark!r}: marks have two characters or more, no escape, and start characters only at their start")

    def marks(self) -> list[str]:
        """Every control string."""
        return [self.begin, *[m for pair in self.roles.values() for m in pair], *self.other,
                *self.placeholders.values(), self.unknown]


INST = Template()


def escape(text: Column, t: Template = INST) -> Column:
    """``text`` without control strings: the escape character is doubled, and put after the first character
    of whatever would read as a mark. Null is empty; ``unescape`` gives the text back."""
    tails: dict[str, list[str]] = {}
    for mark in t.marks():
        tails.setdefault(mark[0], []).append(re.escape(mark[1:]))
    starts = "|".join(f"{re.escape(first)}(?={'|'.join(rest)})" for first, rest in tails.items())
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit(t.escape), F.lit(t.escape * 2))
    return F.regexp_replace(doubled, starts, "$0" + re.escape(t.escape))


def unescape(text: Column, t: Template = INST) -> Column:
    return F.regexp_replace(text, rf"(?s){re.escape(t.escape)}(.)", "$1")


def text_parts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, content: each text as one text part (null text: an empty one)."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                    *[F.lit(None).cast(kind).alias(name) for name, kind in
                      (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))])
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.array(part).alias("content"))


def _is_text(part: Column) -> Column:
    return part["type"].eqNullSafe("text")


def _visit(part: Column, t: Template) -> Column:
    """The piece of formatted text that stands for one part."""
    marks = reduce(lambda case, kv: case.when(part["type"] == kv[0], F.lit(kv[1])), t.placeholders.items(),
                   F.when(_is_text(part), escape(part["text"], t)))
    return marks.otherwise(F.lit(t.unknown))


def _tokens(part: Column, t: Template) -> Column:
    """How many tokens the placeholder of one part expands to: at least one; an audio part of unknown length
    and a part of unknown type count one, a document of unknown length one page."""
    side = lambda n: F.when(part[n].isNotNull(), F.ceil(F.greatest(part[n], F.lit(1)) / F.lit(t.patch)))
    count = (F.when(part["type"] == "image", F.coalesce(side("width") * side("height"), F.lit(t.image_default)))
             .when(part["type"] == "audio", F.greatest(F.ceil(part["seconds"] * F.lit(t.audio_per_second)), F.lit(1)))
             .when(part["type"] == "document", F.greatest(part["pages"], F.lit(1)) * F.lit(t.per_page)))
    return F.coalesce(count.cast("long"), F.lit(1).cast("long"))


def format_turns(turns: DataFrame, t: Template = INST) -> DataFrame:
    """conv_id, turn, role, segments, attachments of each turn row (no shuffle)."""
    role = F.coalesce(F.col("role"), F.lit(""))
    content = F.filter(F.coalesce("content", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    opened, closed = (reduce(lambda case, kv, i=i: case.when(role == kv[0], F.lit(kv[1][i])), list(t.roles.items())[1:],
                             F.when(role == next(iter(t.roles)), F.lit(t.roles[next(iter(t.roles))][i]))) for i in (0, 1))
    opened = opened.otherwise(F.concat(F.lit(t.other[0]), escape(role, t), F.lit(t.other[1])))
    closed = closed.otherwise(F.lit(t.other[2]))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    under_loss = role.isin(*t.loss_roles)
    body = F.transform("content", lambda p: segment(_visit(p, t), under_loss & _is_text(p)))
    attached = F.transform(F.filter("content", lambda p: ~_is_text(p)), lambda p: F.struct(
        F.coalesce(p["type"], F.lit("")).alias("type"), p["ref"].alias("ref"), _tokens(p, t).alias("tokens")))
    mark = lambda text: F.array(segment(text, F.lit(False)))
    return (turns.select("conv_id", "turn", "role", content.alias("content"))
            .select("conv_id", "turn", role.alias("role"), F.concat(mark(opened), body, mark(closed)).alias("segments"),
                    attached.alias("attachments")))


def format_chat(turns: DataFrame, t: Template = INST) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, segments, attachments, expanded_tokens.

    ``turns``: conv_id, turn, role, content (array of PART; ``text_parts`` makes it from a text column).

    - turns are ordered by turn (null first), equal numbers by role, then by content; repeated rows stay;
    - null or empty content is a turn without text; null parts are left out; a null role is the empty name;
    - a null conv_id is a conversation of its own;
    - an empty table gives an empty result; other columns are ignored;
    - the texts travel once, formatted; a conversation has to fit one row (Spark's 2 GB), as its digest does.
    """
    rows = format_turns(turns, t).select("conv_id", F.struct("turn", "role", "segments", "attachments").alias("row"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    begin = F.array(F.struct(F.lit(t.begin).alias("text"), F.lit(False).alias("loss")))
    out = listed.select("conv_id", F.size("rows").cast("long").alias("n_turns"),
                        F.concat(begin, F.flatten(F.transform("rows", lambda r: r["segments"]))).alias("segments"),
                        F.flatten(F.transform("rows", lambda r: r["attachments"])).alias("attachments"))
    return out.select("conv_id", "n_turns", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "attachments",
                      F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def _any(marks) -> str:
    return "(?:" + "|".join(re.escape(m) for m in marks) + ")"


def read_turns(formatted: Column, t: Template = INST) -> Column:
    """Array of (role, text) read from a formatted conversation; placeholders are left out of the text."""
    opens = [o for o, _ in t.roles.values()] + [t.other[0]]
    closes = [c for _, c in t.roles.values()] + [t.other[2]]
    found = F.regexp_extract_all(formatted, F.lit(f"(?s){_any(opens)}.*?{_any(closes)}"), F.lit(0))
    inside = lambda x: F.regexp_replace(x, _any(opens + closes + list(t.placeholders.values()) + [t.unknown]), "")

    def one(x: Column) -> Column:
        between = F.locate(t.other[1], x)  # 0: none, and no other text can hold the mark
        name, known = F.lit(""), list(t.roles.items())
        name = F.substring(x, F.lit(len(t.other[0]) + 1), between - F.lit(len(t.other[0]) + 1))
        role = reduce(lambda case, kv: case.when(F.startswith(x, F.lit(kv[1][0])), F.lit(kv[0])), known[1:],
                      F.when(F.startswith(x, F.lit(known[0][1][0])), F.lit(known[0][0])))
        body = F.when(F.startswith(x, F.lit(t.other[0])), F.substring(x, between + F.lit(len(t.other[1])), F.char_length(x))).otherwise(x)
        return F.struct(role.otherwise(unescape(name, t)).alias("role"), unescape(inside(body), t).alias("text"))

    return F.transform(found, one)


def read_loss(segments: Column, t: Template = INST) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""), t)


def digests(formatted: DataFrame, t: Template = INST) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted conversations."""
    read = formatted.select("conv_id", read_turns(F.col("formatted"), t).alias("turns"), read_loss(F.col("segments"), t).alias("loss"),
                            F.char_length("formatted").cast("long").alias("formatted_chars"))
    line = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
