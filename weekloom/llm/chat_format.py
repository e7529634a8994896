r"""Chat formatting with a checked round trip.

Grammar of a formatted conversation, turn after turn::

    ### <role>:⏎<body>⏎</turn>⏎

``### `` and ``</turn>`` are the control strings. In a body, one backslash before a control string (after
any others) makes it plain text; the parser removes exactly one. Role names have their special characters
written as ``~0`` to ``~5``, so a role is one line without a colon.

A body is written as it stands if the parser reads it back unchanged, and escaped otherwise; a turn that
neither form restores, and a conversation whose parse differs from its source, stop the job. The loss mask
is a list of spans (start and end, in code points) of the bodies of assistant turns.

Everything is DataFrame expressions. Defined results: null texts and roles count as empty; turns are in
order of (turn, role, text), so ties and repeated rows have one order and all stay; rows with a null
conversation id form one conversation; an empty table gives no conversations; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template, as one regular expression.
CONTROL = "(### |</turn>)"
ASSISTANT = "assistant"
#: Characters of role names and how they are written.
ROLE_CODES = (("~", "~0"), (":", "~1"), ("\n", "~2"), ("#", "~3"), ("<", "~4"), ("\\", "~5"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def _role(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_back(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _render(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), role, F.lit(":\n"), body, F.lit("\n</turn>\n"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation as an array of (role, text); null if it is not well formed."""
    pieces = F.split(formatted, r"(?<!\\)" + CONTROL, -1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ":\n", 1)
        body = F.substr(piece, F.length(head) + 3, F.length(piece) - F.length(head) - 3)
        return F.struct(_role_back(head).alias("role"), unescape(body).alias("text"))

    def turns(parts: Column) -> Column:
        inner = F.filter(parts, lambda _, i: i % 2 == 1)
        gaps = F.filter(parts, lambda _, i: (i % 2 == 0) & (i > 0))
        good = (
            (F.size(parts) % 2 == 1)
            & (F.get(parts, F.lit(0)) == "")
            & F.forall(gaps, lambda g: g == "\n")
            & F.forall(inner, lambda p: p.contains(":\n") & p.endswith("\n"))
        )
        return F.when(good, F.transform(inner, turn))

    return F.transform(F.array(pieces), turns)[0]


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, n_turns, formatted, loss_spans`` (array of start and end), one row per conversation."""
    source = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    want = F.array(F.struct("role", "text"))

    def if_restored(body: str) -> Column:
        return F.when(parse(_render(F.col("role_code"), F.col(body))) == want, F.col(body))

    bodies = source.withColumns(
        {"role_code": _role(F.col("role")), "raw": F.col("text"), "escaped": escape(F.col("text"))}
    ).withColumn(
        "body",
        F.coalesce(
            if_restored("raw"), if_restored("escaped"),
            F.raise_error(F.lit("a turn cannot be restored from its formatted text")).cast("string"),
        ),
    )
    rendered = bodies.select(
        "conv_id", "turn", "role", "text", _render(F.col("role_code"), F.col("body")).alias("block"),
        (F.length("role_code") + 6).alias("lead"), F.length("body").alias("n"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rendered.withColumns(
        {
            "k": F.row_number().over(order),
            "at": F.coalesce(
                F.sum(F.length("block")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )
    start = F.col("at") + F.col("lead")
    joined = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "k", "role", "text", "block",
                    F.when(F.col("role") == ASSISTANT,
                           F.struct(start.alias("start"), (start + F.col("n")).alias("end"))).alias("span"),
                )
            )
        ).alias("turns")
    )
    whole = joined.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), "turns",
        F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )
    source_turns = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    checked = F.when(parse(F.col("formatted")) == source_turns, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation cannot be restored from its formatted text")).cast("string")
    )
    return whole.select("conv_id", "n_turns", checked.alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text as the formatted text has them: ``conv_id, turns, loss_text, formatted``."""
    loss = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
    )
    return formatted.select(
        "conv_id", parse(F.col("formatted")).alias("turns"), F.array_join(loss, "").alias("loss_text"), "formatted"
    )
