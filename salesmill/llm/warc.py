"""Web archives: writing records, and reading only what a chain of lengths reaches.

Reading never trusts the record mark alone, since a payload may hold it. Every
mark in an archive is a candidate record; its header gives its length and so
the place of its successor. Starting at the first byte, only candidates that
the chain of successors reaches are records. The chain is followed in parallel:
tasks shorten it inside byte ranges of an archive to each candidate's way out
of the range, pointer jumping over these exits finds where the chain enters
each range in as many rounds as the logarithm of the number of ranges, and the
ranges are then walked from their entries.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmill.session import shared_dir

from .batches import shipped

MARK = "WARC/1.1\r\n"
BREAK = "\r\n\r\n"
#: Bytes of an archive whose candidates one task chains.
RANGE = 4 << 20


def written(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 1000,
    date: str = "2000-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write one record per row to archives below ``path``.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    largest key is a response, the others are revisits of it, whose block is
    the HTTP header alone; all other rows are responses. Null payloads are
    empty, rows without a URL have no target, a null key is below all others,
    repeated rows are repeated records. An empty table gives an empty archive.
    Payloads are shuffled by key and digest, never by digest, so that copies spread out.
    """
    rows = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    narrow = rows.select("key", "digest", F.octet_length("html").alias("n")).where(F.col("n") >= least)
    first = narrow.groupBy("digest").agg(F.max("key").alias("main"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    revisits = (
        narrow.join(first, "digest")
        .where(~F.col("key").eqNullSafe(F.col("main")))
        .select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "main")
        .distinct()
    )
    typed = rows.join(revisits, F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")), "left")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(BREAK),
    )
    block = F.concat(F.col("_http"), F.when(F.col("_digest").isNull(), F.col("html")).otherwise(""))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.url_encode(F.coalesce(F.col(c).cast("string"), F.lit("null"))), F.lit(">"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(f"{MARK}WARC-Type: "),
        F.when(F.col("_digest").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "),
        uri("key"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), target), F.lit("")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(
            F.col("_digest").isNotNull(),
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                uri("main"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("_block").cast("string"),
        F.lit(BREAK),
        F.col("_block"),
        F.lit("\r\n"),
    )
    lines = typed.withColumn("_http", http).withColumn("_block", block).select(record.alias("value"))
    # A record ends in two line breaks; the writer adds the second.
    lines.write.option("lineSep", "\r\n").option("compression", compression).text(path)


def _field(head: str, name: str) -> Column:
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields and payload digest of what follows a mark, for ``value`` (binary)."""
    out = pieces.withColumn("_head", F.substring_index(F.col("value").cast("string"), BREAK, 1))
    out = (
        out.withColumn("_headed", F.octet_length("_head") + 4)
        .withColumn("_declared", F.expr("try_cast(" + "regexp_extract(_head, '(?i)(?:^|\\r\\n)Content-Length:[ \\t]*([0-9]+)[ \\t]*(?:\\r\\n|$)', 1) as bigint)"))
        .withColumn("_block", F.expr("substring(value, cast(_headed as int) + 1, cast(least(_declared, octet_length(value)) as int))"))
        .withColumn("_http", F.substring_index(F.col("_block").cast("string"), BREAK, 1))
        .withColumn("_payload", F.expr("substring(_block, cast(octet_length(_http) as int) + 5)"))
    )
    return out.select(
        *pieces.drop("value").columns,
        F.octet_length("value").cast("long").alias("size"),
        F.unhex(F.sha1("value")).alias("sha1"),
        F.expr(f"if(_headed <= octet_length(value), {len(MARK)} + _headed + _declared + 4, null)").alias("total"),
        _field("_head", "WARC-Type").alias("type"),
        _field("_head", "WARC-Record-ID").alias("record_id"),
        _field("_head", "WARC-Target-URI").alias("url"),
        _field("_head", "WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_field("_head", "WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        F.expr("try_cast(regexp_extract(_http, '(?i)\\r\\nContent-Length:[ \\t]*([0-9]+)', 1) as bigint)").alias("http_bytes"),
        F.octet_length("_payload").cast("long").alias("payload_bytes"),
        F.sha1("_payload").alias("payload_digest"),
    )


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between marks, with archive, block and order inside the block.

    Blocks and order hold for one read only: how files are cut is planned anew for each.
    """
    return (
        spark.read.option("lineSep", MARK)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("order"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _placed(pieces: DataFrame) -> DataFrame:
    """``off``: byte of each piece's mark, from running sums inside blocks and over blocks."""
    step = F.col("size") + len(MARK)
    inside = Window.partitionBy("file", "block").orderBy("order")
    blocks = pieces.groupBy("file", "block").agg(F.sum(step).alias("_all"))
    before = blocks.select(
        F.col("file").alias("_f"),
        F.col("block").alias("_b"),
        (F.sum("_all").over(Window.partitionBy("file").orderBy("block")) - F.col("_all")).alias("_before"),
    )
    return (
        pieces.withColumn("_upto", F.sum(step).over(inside) - step)
        .join(before, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
        .withColumn("off", F.col("_before") + F.col("_upto") - len(MARK))
        .drop("_f", "_b", "_before", "_upto")
    )


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the candidates of a range: where the chain from each leaves the range."""
    rows = rows.sort_values("off", ascending=False)
    out: dict[int, int] = {}
    for off, nxt in zip(rows["off"].tolist(), rows["nxt"].tolist()):
        out[off] = out.get(nxt, nxt)
    offs = rows["off"].tolist()
    return pd.DataFrame({"file": rows["file"].astype(object).tolist(), "off": offs, "exit": [out[o] for o in offs]})


def _walked(entries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Of the candidates of a range: those on the chain from its entries."""
    after = dict(zip(rows["off"].tolist(), rows["nxt"].tolist()))
    reached = set()
    for at in entries["off"].tolist():
        while at in after and at not in reached:
            reached.add(at)
            at = after[at]
    file = [entries["file"].iloc[0]] * len(reached) if reached else []
    return pd.DataFrame({"file": pd.Series(file, dtype=object), "off": pd.Series(sorted(reached), dtype="int64")})


def chained(candidates: DataFrame, *, bytes_in_range: int = RANGE) -> DataFrame:
    """The candidates (file, off, nxt) that the chain from byte 0 of their file reaches."""
    shipped(candidates.sparkSession)
    candidates = candidates.select("file", "off", "nxt").where("nxt > off").checkpoint()
    span = F.expr(f"off div {bytes_in_range}L")
    exits = candidates.groupBy("file", span.alias("span")).applyInPandas(_exits, "file string, off long, exit long").checkpoint()
    farthest = exits.agg(F.max("off")).first()[0] or 0
    reached = candidates.select("file").distinct().withColumn("off", F.lit(0).cast("long"))
    for _ in range((farthest // bytes_in_range).bit_length()):
        jump = exits.select(F.col("file").alias("_f"), F.col("off").alias("_o"), F.col("exit").alias("_e"))
        on = lambda c: (F.col("file") == F.col("_f")) & (F.col(c) == F.col("_o"))
        further = reached.join(jump, on("off")).select("file", F.col("_e").alias("off"))
        reached = reached.union(further).distinct().checkpoint()
        # A successor that is no candidate ends its chain.
        exits = exits.join(jump, on("exit"), "left").select("file", "off", F.coalesce("_e", "exit").alias("exit")).checkpoint()
    entries = reached.groupBy("file", span.alias("span"))
    return entries.cogroup(candidates.groupBy("file", span.alias("span"))).applyInPandas(_walked, "file string, off long")


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``.

    file, off, type, record_id, url, refers_to, declared_digest, http_bytes,
    payload_bytes and payload_digest, the last two of the block's payload as it
    stands there. Marks inside payloads are no records and change no payload.
    What follows a broken link of an archive's chain is not reached. Payloads
    stay where they are read but for those that hold a mark, which are put
    together from their parts. Parts are read again and known by archive and
    content, not by place; one that is not found is an error.
    """
    shared_dir(spark)
    shipped(spark)
    pieces = _placed(_parsed(_marks(spark, path)).checkpoint()).checkpoint()
    candidates = pieces.where("off >= 0 and total is not null").withColumn("nxt", F.expr("off + total"))
    reached = chained(candidates).select(F.col("file").alias("_f"), F.col("off").alias("_o"))
    marked = pieces.join(reached, (F.col("file") == F.col("_f")) & (F.col("off") == F.col("_o")), "left").checkpoint()
    found = marked.where("_o is not null")
    fields = ["type", "record_id", "url", "refers_to", "declared_digest", "http_bytes", "payload_bytes", "payload_digest"]
    simple = found.where(f"size + {len(MARK)} = total").select("file", "off", *fields)
    parted = found.where(f"size + {len(MARK)} < total")
    if parted.isEmpty():
        return simple
    owner = F.last(F.when(F.col("_o").isNotNull(), F.struct(F.col("off"), F.col("total"), F.col("size"))), True)
    owned = marked.where("off >= 0").withColumn("_owner", owner.over(Window.partitionBy("file").orderBy("off")))
    parts = owned.where(f"_owner.size + {len(MARK)} < _owner.total and off < _owner.off + _owner.total").select(
        "file", F.col("_owner.off").alias("owner"), "off", "size", "sha1"
    )
    wanted = parts.select(F.col("file").alias("_f"), F.col("size").alias("_s"), F.col("sha1").alias("_h")).distinct()
    again = _marks(spark, path).select("file", F.octet_length("value").cast("long").alias("size"), F.unhex(F.sha1("value")).alias("sha1"), "value")
    on = (F.col("file") == F.col("_f")) & (F.col("size") == F.col("_s")) & (F.col("sha1") == F.col("_h"))
    texts = again.join(wanted, on, "left_semi").groupBy("file", "size", "sha1").agg(F.first("value").alias("value"))
    texts = texts.withColumnsRenamed({"file": "_f", "size": "_s", "sha1": "_h"})
    lost = F.raise_error(F.concat(F.lit("a part of a record was not found again: "), F.col("file"), F.lit(" "), F.col("off")))
    value = F.when(F.col("_h").isNull(), lost.cast("binary")).otherwise(F.col("value")).alias("value")
    placed = parts.join(texts, on, "left").select("file", "owner", "off", value)
    whole = placed.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("off", "value"))).alias("_parts"))
    joined = F.expr(
        f"aggregate(slice(_parts, 2, size(_parts)), _parts[0].value, (a, x) -> concat(a, cast('{MARK}' as binary), x.value))".replace(
            "\r\n", "\\r\\n"
        )
    )
    joint = _parsed(whole.select("file", F.col("owner").alias("off"), joined.alias("value")))
    return simple.unionByName(joint.select("file", "off", *fields))
