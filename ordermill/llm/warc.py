"""WARC archives written by Spark and read back in splits, records verified by their boundary chain.

Writing: one record per row; the text sink's line separator is the blank lines that end a record,
so every part file is a WARC file. Reading: files are cut at version lines, so each split yields
candidate records with their byte offset, and a candidate's header gives the offset of its
successor. A version line inside a payload makes false candidates; only those that the chain of
successors reaches from the start of the file are records. (A header has no such line: its lines
are fields.)

Null or empty payloads are empty; a null page_id is kept as such; line ends in a url are percent-
encoded and a null url has no header line. Of equal payloads the smallest page_id is the response
and repeated rows of it are responses too. An empty table gives no record.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored

#: Fixed values of the format: version line, end of a header block and of a record, base-32 digits.
VERSION = "WARC/1.1\r\n"
CUT = "\n" + VERSION
BLANK = "\r\n\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Repeated payload digests (about 50 bytes each) up to which their table is broadcast.
BROADCAST_DIGESTS = 100_000


def sha1_base32(data: Column) -> Column:
    """Upper-case base-32 SHA-1: 40 hex digits, ten at a time, are eight base-32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row. Equal payloads of at least ``min_bytes`` are kept once, others revisit it."""
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", text.alias("_body"), F.octet_length(text).cast("long").alias("_bytes"),
                        sha1_base32(text.cast("binary")).alias("_digest"))
    twice = stored(rows.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
                   .where("_n > 1").select("_digest", "_first"), "twice")
    few = twice.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS      # else payloads are shuffled by digest
    rows = rows.join(F.broadcast(twice) if few else twice, "_digest", "left")
    again = (F.col("_bytes") >= min_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("_digest")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("_first")))),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT}")),
        F.when(again, F.concat(F.lit("X-Payload-Length: "), F.col("_bytes"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(again, F.lit(0)).otherwise(F.col("_bytes"))),
    ]
    record = F.concat(F.lit(VERSION), F.concat_ws("\r\n", *lines), F.lit(BLANK),
                      F.when(again, F.lit("")).otherwise(F.col("_body")))
    rows.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """What follows each version line up to the next (the first of a file: with it): value, file, split, order in the split.

    The order is only meaningful inside one scan (splits follow the cluster); offsets are not.
    """
    return (spark.read.option("lineSep", CUT).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth")))


def with_offset(seg: DataFrame) -> DataFrame:
    """Add ``start``, the byte offset of each segment, and ``at``, that of its version line.

    Segments and separators cover the file, so sizes add up to offsets: over the splits of a file
    (a few rows), then inside each split.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = seg.groupBy("file", "split").agg(F.sum("size").alias("_sum"))
    sizes = sizes.select("file", "split", F.coalesce(F.sum("_sum").over(
        before(Window.partitionBy("file").orderBy("split"))), F.lit(0)).alias("_base"))
    inner = F.coalesce(F.sum("size").over(before(Window.partitionBy("file", "split").orderBy("nth"))), F.lit(0))
    return (seg.withColumn("_inner", inner).join(sizes, ["file", "split"])
            .withColumn("start", F.col("_base") + F.col("_inner"))
            .withColumn("at", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.col("start") - len(VERSION)).cast("long"))
            .drop("_base", "_inner"))


def chain(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates that successors reach from offset 0 of their file.

    Inside a split each candidate's chain is followed to its exit, the first offset beyond the
    split. Exits are pointers between splits: doubling them makes every round reach twice as far,
    so a file of n splits takes log n rounds. Last, each split walks its chain from where it is entered.
    """
    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, to = pdf["at"].to_numpy(), pdf["to"].to_numpy()
        place = np.searchsorted(at, to)
        out = to.copy()
        for i in range(len(at) - 1, -1, -1):               # successors lie ahead
            if place[i] < len(at) and at[place[i]] == to[i]:
                out[i] = out[place[i]]
        return pd.DataFrame({"file": pdf["file"], "at": at, "exit": out})

    jumps = stored(candidates.groupBy("file", "split").applyInPandas(leave, "file string, at long, exit long"), "exits")
    entered = stored(jumps.where("at = 0").select("file", "at"), "entered")
    while True:
        new = (entered.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at"))
               .join(jumps.select("file", "at"), ["file", "at"]).join(entered, ["file", "at"], "left_anti"))
        new = stored(new.distinct(), "entered")
        if new.isEmpty():
            break
        entered = entered.unionAll(new)
        further = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("_next"))
        jumps = stored(jumps.join(further, ["file", "exit"], "left")
                       .select("file", "at", F.coalesce("_next", "exit").alias("exit")), "exits")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, to, hit = pdf["at"].to_numpy(), pdf["to"].to_numpy(), pdf["hit"].to_numpy(bool).copy()
        place = np.searchsorted(at, to)
        for i in range(len(at)):
            if hit[i] and place[i] < len(at) and at[place[i]] == to[i]:
                hit[place[i]] = True
        return pdf.loc[hit, ["file", "at"]]

    marked = candidates.join(entered.withColumn("hit", F.lit(True)), ["file", "at"], "left").fillna(False, ["hit"])
    return marked.select("file", "split", "at", "to", "hit").groupBy("file", "split").applyInPandas(
        walk, "file string, at long")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: file, at, header fields, payload bytes and digest.

    A record whose payload holds version lines spans several segments; those records' files are
    read once more and their segments joined in offset order.
    """
    text = F.concat("value", F.lit("\n"))                    # the cut may have taken the header's last line feed
    head = F.substring_index(text, BLANK, 1)
    has_head = F.instr(text, BLANK) > 0
    field = lambda name: F.nullif(F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    begin = F.octet_length(head) + len(BLANK)
    length = F.expr("try_cast(_length as long)")
    scan = (segments(spark, path).withColumn("_length", F.when(has_head, field("Content-Length")))
            .withColumn("length", length).withColumn("begin", F.when(has_head, begin)))
    whole = F.expr("substring(cast(value as binary), cast(begin + 1 as int), cast(length as int))")
    complete = (F.octet_length("value") - F.col("begin")) >= F.col("length")
    light = stored(scan.select(
        "file", "split", "nth", (F.octet_length("value") + len(CUT)).cast("long").alias("size"), "begin", "length",
        F.startswith(F.col("value"), F.lit(VERSION)).alias("whole_line"),
        F.when(has_head, field("WARC-Type")).alias("type"), F.when(has_head, field("WARC-Record-ID")).alias("id"),
        F.when(has_head, field("WARC-Refers-To")).alias("refers"),
        F.when(has_head, field("WARC-Payload-Digest")).alias("stated_digest"),
        F.when(has_head, field("X-Payload-Length")).cast("long").alias("stated_bytes"),
        F.when(complete, sha1_base32(whole)).alias("digest"), F.coalesce(complete, F.lit(False)).alias("complete")),
        "segments")
    placed = stored(with_offset(light).withColumn("to", F.col("start") + F.col("begin") + F.col("length") + len(BLANK)), "placed")
    candidates = placed.where("length >= 0 and (start > 0 or whole_line)")
    found = candidates.join(chain(candidates.select("file", "split", "at", "to")), ["file", "at"])
    columns = ["file", "at", "type", "id", "refers", "stated_digest", "stated_bytes", "length", "digest"]
    found = stored(found.select(*columns, "split", "begin", "to", "complete"), "records")
    split = found.where("not complete")
    if split.isEmpty():
        return found.select(*columns)
    files = split.select("file").distinct()
    raw = segments(spark, path).join(files, "file", "left_semi").withColumn(
        "size", (F.octet_length("value") + len(CUT)).cast("long"))
    raw = with_offset(stored(raw, "raw")).select("file", "split", F.col("at").alias("piece_at"), "value")
    spans = split.select("file", "at", "to", "begin", "length")
    # a segment's owner is the record before or at it, in its split or else in the splits before;
    # records of a file don't overlap
    marks = (raw.withColumn("own", F.lit(None).cast("long"))
             .unionByName(split.select("file", "split", F.col("at").alias("piece_at"), F.lit(None).cast("string").alias("value"),
                                       F.col("at").alias("own"))))
    order = Window.partitionBy("file", "split").orderBy("piece_at", F.col("own").asc_nulls_last())
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = (split.select("file", "split", "at").unionByName(raw.select("file", "split").distinct(), allowMissingColumns=True)
               .groupBy("file", "split").agg(F.max("at").alias("at"))        # a row per split
               .select("file", "split", F.max("at").over(earlier).alias("_carried")))
    owned = (marks.withColumn("at", F.last("own", True).over(order)).where("value is not null").join(carried, ["file", "split"])
             .withColumn("at", F.coalesce("at", "_carried")).drop("_carried"))
    body = (owned.join(spans, ["file", "at"]).where("piece_at < `to`").groupBy("file", "at")
            .agg(F.sort_array(F.collect_list(F.struct("piece_at", "value"))).alias("p"), F.first("begin").alias("begin"),
                 F.first("length").alias("length"))
            .withColumn("value", F.array_join(F.col("p.value"), CUT)).select("file", "at", sha1_base32(whole).alias("_digest")))
    return (found.join(body, ["file", "at"], "left").withColumn("digest", F.coalesce("digest", "_digest"))
            .select(*columns))


def page_records(records: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of the response)."""
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as long)")
    again = F.col("type") == "revisit"
    return records.select(
        page("id").alias("page_id"), F.when(again, F.col("stated_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("stated_digest", "^sha1:", "")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers").alias("refers_to"))
