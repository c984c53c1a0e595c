"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (email, ip, card, phone) are found by pattern and check alone and
always stay. Further kinds need more than a pattern: each candidate has a score
of its pattern, a confirmed checksum (mod-97 for bank accounts) and a word of
its context raise it, and those that reach ``ACCEPT`` become spans. All of it
is regular expressions and array functions; places are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import literal, with_places

#: Base kinds as: kind, pattern, condition without which nothing matches. The patterns find what
#:   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#:   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   card   [0-9]([\x20-]?[0-9])+           of 13 to 19 digits
#:   phone  \+[0-9][\x20().0-9-]+[0-9]
#: find, but start only where a run starts or the last match ended and give no character back, so
#: that long runs cost one pass. Runs of digits with other counts than a card's fail its check, and
#: are not proposed.
BASE = (
    (
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains({t}, '@')",
    ),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "contains({t}, '.')"),
    (
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
        "{t} rlike '[0-9]'",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains({t}, '+')"),
)
DIGITS = "regexp_replace({v}, '[^0-9]', '')"
#: Every second digit from the right counts double, less nine if that is over nine.
LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + if(i % 2 = 1,"
    " cast(substring({d}, length({d}) - i + 1, 1) as int),"
    " element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substring({d}, length({d}) - i + 1, 1) as int) + 1))) % 10 = 0"
)
#: The first four characters move to the end, letters count from ten, the number leaves one.
MOD97 = (
    "aggregate(filter(split(concat(substring({s}, 5), left({s}, 4)), ''), c -> c != ''), 0, (a, c) ->"
    " if(c between '0' and '9', a * 10 + cast(c as int), a * 100 + ascii(c) - 55) % 97) = 1"
)
CHECKS = {
    "email": "true",
    "ip": "not exists(split(x.value, '[.]'), p -> not (p rlike '^0*(?:[0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])$'))".replace("{{", "{").replace("}}", "}"),
    "card": LUHN.format(d=DIGITS.format(v="x.value")),
    "phone": f"length({DIGITS.format(v='x.value')}) between 9 and 15",
}


@dataclass(frozen=True)
class Scored:
    """A kind that needs confirmation; scores are tenths."""

    kind: str
    pattern: str
    only: str
    score: int
    words: str
    check: str = "false"


#: Code points before a span in which a context word counts.
NEAR = 48
CHECKED, WORDED, ACCEPT = 4, 3, 7
SCORED = (
    Scored(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "{t} rlike '[A-Z]{2}[0-9]{2}'",
        3,
        "iban|account|bank|konto|compte|cuenta",
        MOD97.format(s="regexp_replace(x.value, ' ', '')"),
    ),
    Scored(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "{t} rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'",
        4,
        "ssn|social security|sozialversicherung|seguridad social|sécurité sociale",
    ),
    Scored(
        "secret",
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,128}+(?![A-Za-z0-9+/_=-])",
        "{t} rlike '[A-Za-z0-9+/_-]{32}'",
        4,
        r"(?:token|secret|password|passwd|api[_ -]?key|private[_ -]?key)[\x20\t]*[:=][\x20\t]*.?$",
    ),
)
KINDS = (*[k for k, _, _ in BASE], *[s.kind for s in SCORED])


def found(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: structs (kind, start, end, score) by kind as listed, then start.

    Scores are tenths; base kinds have ten. A null or empty text has no spans.
    Columns of ``docs`` stay as they are; names used here begin with ``_pii``,
    and ``spans`` may not be a column of ``docs``.
    """
    if "spans" in {c.lower() for c in docs.columns}:
        raise ValueError("a column spans would be overwritten")
    out = docs.withColumn("_pii_text", F.expr(f"coalesce(`{text}`, '')"))
    parts = []
    for rank, (kind, pattern, only) in enumerate(BASE):
        out = with_places(out, "_pii_text", pattern, f"_pii_{kind}", only.format(t="_pii_text"))
        parts.append(
            f"transform(filter(_pii_{kind}, x -> {CHECKS[kind]}), x -> named_struct('rank', {rank}, 'kind', '{kind}',"
            " 'start', x.start, 'end', x.end, 'score', 10))"
        )
    for rank, s in enumerate(SCORED, len(BASE)):
        out = with_places(out, "_pii_text", s.pattern, f"_pii_{s.kind}", s.only.replace("{t}", "_pii_text"))
        before = f"substring(_pii_text, cast(greatest(x.start - {NEAR}, 0) as int) + 1, cast(least(x.start, {NEAR}) as int))"
        score = (
            f"{s.score} + if({s.check}, {CHECKED}, 0) + if(lower({before}) rlike {literal(s.words)}, {WORDED}, 0)"
        )
        parts.append(
            f"filter(transform(_pii_{s.kind}, x -> named_struct('rank', {rank}, 'kind', '{s.kind}', 'start', x.start,"
            f" 'end', x.end, 'score', {score})), x -> x.score >= {ACCEPT})"
        )
    out = out.withColumn("_pii_all", F.expr(f"sort_array(concat({', '.join(parts)}))"))
    spans = "transform(_pii_all, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'score', x.score))"
    return out.withColumn("spans", F.expr(spans)).select(*[F.col(f"`{c}`") for c in docs.columns], "spans")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets.

    Spans that overlap are replaced as one, under the kind of the first. Null
    texts stay null, texts without spans stay as they are.
    """
    out = found(docs, text).withColumn(
        "_pii_sorted", F.expr("sort_array(transform(spans, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind)))")
    )
    # Far end of what stands before each span; a span that starts before it joins the last one.
    out = out.withColumn(
        "_pii_merged",
        F.expr(
            "aggregate(_pii_sorted, cast(array() as array<struct<start: bigint, end: bigint, kind: string>>), (a, x) ->"
            " if(size(a) > 0 and x.start < element_at(a, -1).end,"
            " concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start,"
            " 'end', greatest(element_at(a, -1).end, x.end), 'kind', element_at(a, -1).kind))),"
            " concat(a, array(x))))"
        ),
    )
    cut = (
        "substring(`{t}`, cast(if(i = 0, 0, element_at(_pii_merged, i).end) as int) + 1,"
        " cast(x.start - if(i = 0, 0, element_at(_pii_merged, i).end) as int))"
    ).format(t=text)
    masked = (
        f"concat(array_join(transform(_pii_merged, (x, i) -> concat({cut}, '[', upper(x.kind), ']')), ''),"
        f" substring(`{text}`, cast(element_at(_pii_merged, -1).end as int) + 1))"
    )
    result = F.expr(f"if(size(_pii_merged) > 0, {masked}, `{text}`)")
    return out.select(*[(result if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
