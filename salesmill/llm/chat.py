"""Chat formatting whose output parses back to exactly the source turns.

One conversation becomes one string, each turn being

    <s>[INST] role [/INST]text</s>

Texts and roles may hold the four control strings themselves. Rendering is a
grammar round trip: a turn is rendered as it is, parsed again, and if role or
text do not come back identical it is rendered with its control strings
escaped. An escape puts one more backslash behind the first character of what
is a control string once its backslashes are taken away, so that texts that
already hold escapes survive too. The parser takes one backslash away and
accepts no bare control string inside a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import literal, with_starts

#: Control strings with any number of backslashes behind the first character.
ANGLE, SQUARE = r"<(\\*/?s>)", r"\[(\\*/?INST\])"
#: The same with one backslash to take away.
ANGLE_ESCAPED, SQUARE_ESCAPED = r"<\\(\\*/?s>)", r"\[\\(\\*/?INST\])"
BARE = r"</?s>|\[/?INST\]"
HEAD = r"^<s>\[INST\] ([\s\S]*?) \[/INST\]"


def escaped(text: str) -> str:
    inner = f"regexp_replace({text}, {literal(ANGLE)}, {literal(r'<\\$1')})"
    return f"regexp_replace({inner}, {literal(SQUARE)}, {literal(r'[\\$1')})"


def unescaped(text: str) -> str:
    inner = f"regexp_replace({text}, {literal(ANGLE_ESCAPED)}, '<$1')"
    return f"regexp_replace({inner}, {literal(SQUARE_ESCAPED)}, '[$1')"


def rendered(role: str, text: str) -> str:
    return f"concat('<s>[INST] ', {role}, ' [/INST]', {text}, '</s>')"


def piece(p: str) -> str:
    """(role, text, skip) of what stands before an end mark; nulls if that is no turn.

    ``skip`` is the number of code points before the text.
    """
    head = f"regexp_extract({p}, {literal(HEAD)}, 0)"
    role = f"regexp_extract({p}, {literal(HEAD)}, 1)"
    body = f"substring({p}, length({head}) + 1)"
    fine = f"{head} != '' and not ({role} rlike {literal(BARE)}) and not ({body} rlike {literal(BARE)})"
    return (
        f"if({fine}, named_struct('role', {unescaped(role)}, 'text', {unescaped(body)}, "
        f"'skip', length({head})), named_struct('role', cast(null as string), 'text', cast(null as string), 'skip', 0))"
    )


def parse(df: DataFrame, column: str) -> DataFrame:
    """``turns``: role, text, and start and length of the text in ``column`` as it stands there.

    The end marks cut the string; no accepted turn holds one inside.
    """
    out = df.withColumn("_pieces", F.expr(f"slice(split(`{column}`, '</s>'), 1, size(split(`{column}`, '</s>')) - 1)"))
    out = out.withColumn("_sizes", F.expr("transform(_pieces, p -> cast(length(p) + 4 as bigint))"))
    out = with_starts(out, "_sizes", "_starts").withColumn("_read", F.expr(f"transform(_pieces, p -> {piece('p')})"))
    return out.withColumn(
        "turns",
        F.expr(
            "transform(_read, (x, i) -> named_struct('role', x.role, 'text', x.text, "
            "'start', _starts[i] + x.skip, 'length', _sizes[i] - 4 - x.skip))"
        ),
    ).drop("_pieces", "_sizes", "_starts", "_read")


def formatted(
    rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its key, ``formatted``, and ``turns`` parsed back from it.

    Null roles and texts are empty; equal turn numbers are ordered by role, then
    text, null numbers come first; rows without a conversation form one of their
    own; repeated rows are repeated turns; an empty table gives no row; other
    columns are not read. Should a conversation not read back as it was, the job
    fails. A conversation is one string and so stands in one task.
    """
    source = rows.select(
        F.col(f"`{conversation}`").alias("_conv"),
        F.col(f"`{turn}`").alias("_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("_role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    plain = rendered("_role", "_text")
    alone = source.withColumn("_plain", F.expr(plain)).withColumn(
        "_back", F.expr(f"if(locate('</s>', _plain) = length(_plain) - 3, {piece('left(_plain, length(_plain) - 4)')}, null)")
    )
    shown = alone.withColumn(
        "_shown",
        F.expr(
            f"if(_back.role = _role and _back.text = _text, _plain, {rendered(escaped('_role'), escaped('_text'))})"
        ),
    ).withColumn("_shown", F.expr(f"coalesce(_shown, {rendered(escaped('_role'), escaped('_text'))})"))
    whole = (
        shown.groupBy("_conv")
        .agg(F.sort_array(F.collect_list(F.struct("_turn", "_role", "_text", "_shown"))).alias("_all"))
        .withColumn("formatted", F.expr("array_join(transform(_all, x -> x._shown), '')"))
    )
    same = (
        "transform(turns, x -> named_struct('r', x.role, 't', x.text))"
        " = transform(_all, x -> named_struct('r', x._role, 't', x._text))"
    )
    return parse(whole, "formatted").select(
        F.col("_conv").alias(conversation),
        "formatted",
        F.expr(f"if({same}, turns, raise_error('a conversation does not read back'))").alias("turns"),
    )


def trained(df: DataFrame) -> DataFrame:
    """``loss``: what stands under the loss mask, the assistant's texts, read from ``formatted`` and unescaped."""
    spans = df.withColumn("_spans", F.expr("filter(turns, x -> x.role = 'assistant')"))
    cut = unescaped("substring(formatted, cast(s.start as int) + 1, cast(s.length as int))")
    return spans.withColumn("loss", F.expr(f"array_join(transform(_spans, s -> {cut}), '')")).drop("_spans")
