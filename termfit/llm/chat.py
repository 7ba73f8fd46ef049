"""Chat formatting: a finite-state machine over roles and a declarative template. Built-in functions only.

A turn becomes three segments: header, escaped text, footer. Escaping puts a backslash
before every backslash and inside every control string, so that no control string is left in a
text and unescaping is one rule: drop a backslash, keep what follows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How conversations are written.

    ``header`` holds ``{role}`` and ends in ``role_end``. ``controls`` are the strings that texts must not
    contain. ``turns`` maps a state (the last role; "" at the start) to the roles that may follow,
    ``complete`` are the states in which a conversation may end. Texts of ``loss_roles`` are trained on.
    """

    opening: str = "### "
    role_end: str = ": "
    footer: str = "</turn>"
    gap: str = "\n"
    controls: tuple[str, ...] = ("###", "</turn>")
    loss_roles: tuple[str, ...] = ("assistant",)
    turns: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    complete: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("a control string needs two characters or more and no backslash")
        if self.footer not in self.controls or any(self.footer.startswith(self.footer[i:]) for i in range(1, len(self.footer))):
            raise ValueError("the footer must be a control string that doesn't overlap itself")


DEFAULT = Template()


def escape(text: Column, controls: tuple[str, ...]) -> Column:
    inside = [f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in controls]
    return F.regexp_replace(text, "|".join([r"(?=\\)", *inside]), r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _bad_turn(roles: Column, template: Template) -> Column:
    """The first turn (from 1) that the machine doesn't accept, the number of turns + 1 if the end is too early, else 0."""
    arcs = [f"{state}\n{role}" for state, following in template.turns.items() for role in following]
    arcs = F.array(*map(F.lit, arcs))
    step = F.aggregate(
        roles,
        F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(0).alias("bad")),
        lambda a, role: F.struct(
            role.alias("state"),
            (a["at"] + 1).alias("at"),
            F.when((a["bad"] == 0) & ~F.array_contains(arcs, F.concat(a["state"], F.lit("\n"), role)), a["at"] + 1)
            .otherwise(a["bad"])
            .alias("bad"),
        ),
    )
    ended = F.coalesce(F.element_at(roles, -1), F.lit("")).isin(*template.complete)
    return F.when(step["bad"] > 0, step["bad"]).when(~ended, F.size(roles) + 1).otherwise(0)


def format_conversations(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, text).

    Returns conv_id, bad_turn (0: the order of turns is valid), segments (text, loss) and formatted, their
    concatenation. Turns are ordered by turn, role and text, nulls first; null roles and texts are empty, and
    repeated rows are turns of their own. Conversations with invalid order are formatted all the same.
    Rows without conv_id form one conversation. A conversation is one row, so it must fit in a task's memory.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(
            F.lit(template.opening), escape(t["role"], (*template.controls, template.role_end)), F.lit(template.role_end)
        )
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template.controls).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.footer + template.gap).alias("text"), F.lit(False).alias("loss")),
        )

    return grouped.select(
        "conv_id",
        _bad_turn(F.col("turns.role"), template).alias("bad_turn"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    ).select("*", F.array_join("segments.text", "").alias("formatted"))


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, bad_turn, turns (role, text) parsed from ``formatted``, loss_text from the loss segments, and ``formatted``."""
    pattern = r"(?s)\G{}(.*?){}(.*?){}".format(
        re.escape(template.opening), re.escape(template.role_end), re.escape(template.footer + template.gap)
    )
    roles = F.transform(F.regexp_extract_all("formatted", F.lit(pattern), 1), unescape)
    texts = F.transform(F.regexp_extract_all("formatted", F.lit(pattern), 2), unescape)
    trained = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.select(
        "conv_id",
        "bad_turn",
        F.arrays_zip(roles.alias("role"), texts.alias("text")).alias("turns"),
        F.array_join(trained, "").alias("loss_text"),
        "formatted",
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        (F.col("bad_turn") == 0).alias("valid"),
    )
