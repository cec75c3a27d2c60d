"""Line dedup: lines that many documents share stay in one document only
(operator 11).

Every text is exploded into lines; a line's key is the line without blanks at
its ends, A-Z lower-cased.  Keys long enough to count are hashed (two 64-bit
hashes with different seeds: 128 bits stand for a key), the distinct documents
of each hash are counted and their largest id is kept.  Lines of hashes at or
over the threshold are dropped by position, except in the document of that
id, and what is left is put together in order of position.

All of it is DataFrame functions.  Counting: a first exchange by (hash, document) removes
repeats, a second by hash moves counts that were summed before.  Dropping:
the places of lines travel, never their texts; a hash with more than 1/2000 of
all (hash, document) pairs is hot, there are fewer than 2000 such, and their
lines are dealt over as many salts as their share asks for.

Defined results: a null or empty text is one empty line; lines split at
``\\n`` alone (a ``\\r`` before it is a blank of the line's end and stays in the
lines kept); a document whose lines are all dropped keeps an empty text; null
ids get a number after all others (``common``), so that one of them is the
largest; rows with one ``doc_id`` are one document for the count, and each keeps
its lines if that id is the largest; rows given several times return as often;
empty table: empty result; other columns of any name are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

MIN_LENGTH = 40
MIN_DOCUMENTS = 5
#: Hashes with more than one in so many of all (hash, document) pairs are hot.
HOT_SHARE = 2000

# The blanks that the contract strips.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped, A-Z lower-cased (all other characters as they are)."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def key_lines(rows: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``id, h, pos, k1, k2`` of the lines whose key has ``min_length`` code points or more."""
    lines = rows.select("id", "h", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    bare = F.btrim("line", F.lit(BLANKS))
    lines = lines.where(F.char_length(bare) >= min_length).select("id", "h", "pos", line_key(F.col("line")).alias("key"))
    return lines.select("id", "h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def common_keys(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``k1, k2, last, n`` of the hashes that ``min_documents`` or more hold."""
    held = lines.select("k1", "k2", "id").distinct()
    return held.groupBy("k1", "k2").agg(F.max("id").alias("last"), F.count("*").alias("n")).where(F.col("n") >= min_documents)


def _salted(lines: DataFrame, over: DataFrame, hot_share: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``salt``: the lines of a hot hash are dealt over several,
    and its row in ``over`` is repeated for each."""
    total = over.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") * hot_share / F.lit(max(1, total))).cast("int")
    sized = over.select("k1", "k2", "last", parts.alias("parts"))
    hot = F.broadcast(sized.where("parts > 1").select("k1", "k2", "parts"))  # fewer than hot_share rows
    salt = F.pmod(F.xxhash64("id", "h"), F.coalesce("parts", F.lit(1))).cast("int")
    lines = lines.join(hot, ["k1", "k2"], "left").withColumn("salt", salt).drop("parts")
    return lines, sized.select("k1", "k2", "last", F.explode(F.expr("sequence(0, parts - 1)")).alias("salt"))


def dropped_places(rows: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS,
                   hot_share: int = HOT_SHARE) -> DataFrame:
    """``id, h, gone``: the positions of the lines that each document loses."""
    lines = key_lines(rows, min_length)
    over = C.staged(rows.sparkSession, common_keys(lines, min_documents), "common-lines")
    lines, over = _salted(lines, over, hot_share)
    lost = lines.join(over, ["k1", "k2", "salt"]).where("id <> last")
    return lost.groupBy("id", "h").agg(F.collect_set("pos").alias("gone"))


def without_common_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS,
                         hot_share: int = HOT_SHARE) -> DataFrame:
    """Per row ``doc_id, n_lines, n_dropped`` and the ``text`` that is left."""
    rows = C.keyed(docs)
    places = dropped_places(rows.select("id", "h", "text"), min_length, min_documents, hot_share)
    met = rows.join(places, ["id", "h"], "left")
    # A generator, so that the lines are split once and not once a position.
    split = F.struct(F.split("text", "\n").alias("lines"), F.col("gone").alias("gone"), F.col("text").alias("text"))
    met = met.select("doc_id", F.inline(F.array(split)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return met.select("doc_id", F.size("lines").cast("bigint").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
                      F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = without_common_lines(C.read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
