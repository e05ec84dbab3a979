"""Quotation linking: reply structure from quoted passages (operator 8).

A line's quote level is its number of leading ``>`` marks; a passage is a run
of lines of one level.  Passages are normalised (marks off, lower case, white
space collapsed) and hashed; the original of a passage is the latest earlier
message of its thread whose own text holds it as the whole text, a paragraph
or a line, else the first such message of any other thread.  A passage that
is found nowhere whole is tried line by line.  A message replies to the
original of its first passage of the lowest level.  ``On ... wrote:`` lines
before a passage go with it.

"Latest earlier" is decided within buckets of positions plus one row a
bucket, so a thread or passage of any size is spread over tasks and no pairs
are formed.  Positions in a thread come the same way.

Null texts count as empty; blank passages link nothing; rows without thread or
position keep their text and link nothing, with position null; rows that
repeat a position take positions in the order of their text.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit

SHARES = 16
BUCKET = 1024
_MARKS = re.compile(r"(?:[ \t]*>)+")
_WROTE = re.compile(r"On .*wrote:\s*")


def normalise(lines: list[str]) -> str:
    return " ".join(" ".join(lines).lower().split())


def parse(text: str) -> tuple[list[str], list[tuple[int, list[str]]]]:
    """(own lines, passages as (level, lines without marks))."""
    own, passages = [], []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks[0].count(">") if marks else 0
        if not level:
            own.append(line)
            continue
        if not passages or passages[-1][0] != level or passages[-1][2] != len(own):
            passages.append((level, [], len(own)))
        passages[-1][1].append(line[marks.end():].removeprefix(" "))
    before = {at for _, _, at in passages}
    kept = [x for i, x in enumerate(own) if not (i + 1 in before and _WROTE.fullmatch(x))]
    return kept, [(level, lines) for level, lines, _ in passages]


def _hash(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def _parsed(messages: DataFrame) -> DataFrame:
    """(thread, seq, role, body, n_quotes, max_level, pieces, quotes): quotes are (passage, level, try, hash)."""
    def run(batches):
        for batch in batches:
            for part in textkit.row_blocks(batch, "text"):
                out = ([], [], [], [], [])
                for text in part.column(3).to_pylist():
                    own, passages = parse(text or "")
                    body = "\n".join(own).strip("\n")
                    paragraphs = re.split(r"\n[ \t]*\n", body)
                    pieces = {_hash(p) for p in {normalise([body]), *map(lambda x: normalise([x]), paragraphs + body.split("\n"))} if p}
                    quotes = []
                    for i, (level, lines) in enumerate(passages):
                        tries = [t for t in dict.fromkeys([normalise(lines), *(normalise([x]) for x in lines)]) if t]
                        quotes += [{"passage": i, "level": level, "try": j, "hash": _hash(t)} for j, t in enumerate(tries)]
                    for col, v in zip(out, (body, len(passages), max([p[0] for p in passages], default=0), sorted(pieces), quotes)):
                        col.append(v)
                kind = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("try", pa.int32()), ("hash", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], pa.list_(pa.string())), pa.array(out[4], kind)],
                    names=["thread", "seq", "role", "body", "n_quotes", "max_level", "pieces", "quotes"])

    return messages.mapInArrow(run, "thread long, seq long, role string, body string, n_quotes int, max_level int, "
                                    "pieces array<string>, quotes array<struct<passage: int, level: int, try: int, hash: string>>")


def _latest_before(quotes: DataFrame, originals: DataFrame) -> DataFrame:
    """``quotes`` with ``of``: the greatest seq of an original of the same (thread, hash) below the quote's seq."""
    bucket = F.floor(F.col("seq") / BUCKET).alias("bucket")
    rows = quotes.select("*", bucket, F.lit(None).cast("long").alias("own")).unionByName(
        originals.select("thread", "hash", "seq", bucket, F.col("seq").alias("own")), allowMissingColumns=True)
    near = Window.partitionBy("thread", "hash", "bucket").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.max("own").over(near)).where("own is null").drop("own")
    tops = originals.select("thread", "hash", bucket, "seq").groupBy("thread", "hash", "bucket").agg(F.max("seq").alias("top"))
    asked = quotes.select("thread", "hash", bucket).distinct().withColumn("top", F.lit(None).cast("long"))
    far = Window.partitionBy("thread", "hash").orderBy("bucket").rangeBetween(Window.unboundedPreceding, -1)
    earlier = (tops.union(asked).withColumn("far", F.max("top").over(far))  # at most two rows a bucket
               .groupBy("thread", "hash", "bucket").agg(F.max("far").alias("far")))
    return rows.join(earlier, ["thread", "hash", "bucket"], "left").withColumn("of", F.coalesce("near", "far")).drop("near", "far", "bucket")


def _two_threads(originals: DataFrame) -> DataFrame:
    """(hash, any, other): the first original of each passage, and the first one of any other thread.

    A passage that very many threads hold is dealt over ``SHARES`` groups of threads."""
    share = F.pmod(F.xxhash64("thread"), F.lit(SHARES)).cast("int")
    tops = originals.withColumn("share", share).groupBy("hash", "thread", "share").agg(F.min("seq").alias("seq"))
    first = tops.groupBy("hash", "share").agg(F.min(F.struct("thread", "seq")).alias("any"))
    first = first.groupBy("hash").agg(F.min("any").alias("any"))
    spread = first.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    other = (tops.join(spread, ["hash", "share"]).where(F.col("thread") != F.col("any.thread"))
             .groupBy("hash", "share").agg(F.min(F.struct("thread", "seq")).alias("other")))
    return first.join(other.groupBy("hash").agg(F.min("other").alias("other")), "hash", "left")


def _positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position`` in their thread, from 1."""
    rows = rows.withColumn("bucket", F.floor(F.col("seq") / BUCKET))
    inside = Window.partitionBy("thread", "bucket").orderBy("seq", "body")
    counts = rows.groupBy("thread", "bucket").agg(F.count(F.lit(1)).alias("m"))
    before = counts.select("thread", "bucket", F.coalesce(F.sum("m").over(
        Window.partitionBy("thread").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return (rows.withColumn("in_bucket", F.row_number().over(inside)).join(before, ["thread", "bucket"], "left")
            .withColumn("position", (F.col("before") + F.col("in_bucket")).cast("long")).drop("bucket", "in_bucket", "before"))


def link_quotes(messages: DataFrame, folder: str, thread: str = "conv_id", seq: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Per message: conv_id, turn, role, body (own text), n_quotes, max_level, reply_conv, reply_turn, position."""
    rows = messages.select(F.col(thread).cast("long").alias("thread"), F.col(seq).cast("long").alias("seq"),
                           F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
    parsed = storage.stage(_parsed(rows), folder, "parsed")
    placed = parsed.where("thread is not null and seq is not null")
    quotes = placed.select("thread", "seq", F.explode("quotes").alias("q")).select("thread", "seq", "q.*").distinct()
    asked = quotes.select("hash").distinct()
    originals = storage.stage(placed.select("thread", "seq", F.explode("pieces").alias("hash")).distinct()
                              .join(asked, "hash", "left_semi"), folder, "originals")
    found = _latest_before(quotes, originals)
    found = found.join(_two_threads(originals), "hash", "left").withColumn("to", F.when(
        F.col("of").isNotNull(), F.struct("thread", F.col("of").alias("seq")))
        .when(F.col("any.thread") != F.col("thread"), F.col("any")).otherwise(F.col("other")))
    # within a passage the earliest try that is found; of a message the first passage of the lowest level
    replies = (found.where("to is not null").groupBy("thread", "seq")
               .agg(F.min_by("to", F.struct("level", "passage", "try")).alias("to")))
    out = parsed.select("thread", "seq", "role", "body", "n_quotes", "max_level").join(replies, ["thread", "seq"], "left")
    full = out.where("thread is not null and seq is not null")
    rest = out.where("thread is null or seq is null").withColumn("position", F.lit(None).cast("long"))
    return _positions(full).unionByName(rest).select(
        F.col("thread").alias("conv_id"), F.col("seq").alias("turn"), "role", "body", "n_quotes", "max_level",
        F.col("to.thread").alias("reply_conv"), F.col("to.seq").alias("reply_turn"), "position")


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the turn before it, and that one's quote of the turn before, over its own text."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    earlier = rows.groupBy("conv_id", "turn").agg(F.min("text").alias("t"), F.min("role").alias("r"))
    quoted = lambda mark, c: F.concat(F.lit(mark), F.regexp_replace(c, "\n", "\n" + mark))
    for back, t in ((1, "t1"), (2, "t2")):
        rows = rows.join(earlier.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("t").alias(t), F.col("r").alias(f"r{back}")),
                         ["conv_id", "turn"], "left")
    nested = F.when(F.col("t2").isNotNull(), F.concat(quoted("> > ", F.col("t2")), F.lit("\n"))).otherwise("")
    return rows.select("conv_id", "turn", "role", F.when(F.col("t1").isNull(), F.col("text")).otherwise(F.concat(
        F.lit("On turn "), F.col("turn") - 1, F.lit(", "), F.coalesce("r1", F.lit("someone")), F.lit(" wrote:\n"), nested,
        quoted("> ", F.col("t1")), F.lit("\n\n"), F.col("text"))).alias("text"))
