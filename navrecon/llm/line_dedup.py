"""Line dedup: drop lines that many documents share, except where they first occur.

Lines are exploded, normalised and hashed; each hash counts its distinct
documents; lines over the threshold go, and what stays is put together by position.
Only DataFrame functions run. Hashes are folded before the shuffle, so a line that
every document holds costs one row for each map task; the join of lines with the
shared hashes has one row on its right side for each hash, so Spark can split hot ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import LOWER, NO_ID, SPACE, UPPER, carried, staged, text_of

MADE = ("n_lines", "n_dropped")


def line_key(line):
    """The line stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased."""
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(SPACE))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                min_chars: int = 10) -> DataFrame:
    """docs with the kept lines as text, and n_lines (before), n_dropped (long).

    A key of at least min_chars code points that occurs in at least min_docs distinct
    ids loses all its lines but those of the smallest id. A null text is one empty
    line; a null id is larger than any other and all null ids are one document.
    Rows with one id are one document: a line repeated inside it is no reason to drop
    it. Repeated rows are all treated alike. Columns named n_lines or n_dropped are
    replaced; other columns pass through. An empty table gives an empty table.
    """
    base = docs.select(carried(docs, text_col, *MADE), text_of(text_col).alias("__text"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("__of"))
    base = base.withColumn("__own", F.xxhash64("__text"))
    lines = F.split("__text", "\n", -1)
    keyed = (base.select("__of", "__own", F.posexplode(lines).alias("__pos", "__line"))
                 .select("__of", "__own", "__pos", line_key(F.col("__line")).alias("__key"))
                 .where(F.char_length("__key") >= min_chars)
                 .select("__of", "__own", "__pos", F.xxhash64("__key").alias("__a"),
                         F.xxhash64(F.lit("second"), "__key").alias("__b")))
    seen = keyed if min_docs <= 2 else keyed.select("__of", "__a", "__b").distinct()
    # Staged: the join then has plain shuffles on both sides, whose hot partitions Spark can split.
    shared = staged(seen.groupBy("__a", "__b")
                  .agg(F.min("__of").alias("__first"), F.max("__of").alias("__last"), F.count("*").alias("__n"))
                  .where((F.col("__n") >= min_docs) & ((F.col("__first") != F.col("__last")) | F.lit(min_docs < 2)))
                  .select("__a", "__b", "__first"), "shared-lines")
    drops = (keyed.join(shared, ["__a", "__b"]).where("__of <> __first")
                  .groupBy("__of", "__own").agg(F.collect_set("__pos").alias("__drop")))
    joined = base.join(drops, ["__of", "__own"], "left").withColumn("__lines", lines)
    # array_except keeps order and is linear, as positions are distinct integers.
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1),
                          F.coalesce("__drop", F.array().cast("array<int>")))
    joined = joined.withColumn("__stay", stay)
    kept = F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n")
    return joined.select("__doc.*", kept.alias(text_col),
                         F.size("__lines").cast("long").alias("n_lines"),
                         (F.size("__lines") - F.size("__stay")).cast("long").alias("n_dropped"))
