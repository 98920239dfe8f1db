"""Secret scan with corpus-wide ownership of every value.

Patterns find candidate values in whole texts. Their hashes are counted over the
corpus by distinct repositories and owners: a value that many owners or many
repositories hold is a copied example, any other looks live. Every candidate gets this
verdict; live runs of key characters add spans of kind `owned` to the base kinds. Only
DataFrame functions run.

Positions come from the pieces between matches: a match starts after all pieces and
matches before it, summed by a window over the document's own matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navrecon.llm.common import staged, text_of

#: kind: pattern, group of the value, least length of the value. The order is that of listing.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    # Shorter runs would be dropped anyway, and a run cannot begin inside another.
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    # Whole runs; those without a digit are dropped afterwards, as a look ahead from each place would take quadratic time.
    "owned": (r"[A-Za-z0-9+/_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")


def as_match(kind: int):
    def made(x, i):
        return F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x["gap"].alias("gap"),
                        F.char_length(x["hit"]).alias("size"), x["value"].alias("value"))
    return made


def matches(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """A row for each match of each kind, and one without kind for each document that has none."""
    found = []
    for number, (kind, (pattern, group, _)) in enumerate(KINDS.items()):
        pieces = F.transform(F.split("__text", pattern, -1), F.char_length)
        hits = F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all("__text", F.lit(pattern), F.lit(group)) if group else hits
        zipped = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(hits)).alias("gap"), hits.alias("hit"),
                                          values.alias("value")), as_match(number))
        found.append(F.when(F.col("__text").rlike(pattern), zipped).otherwise(
            F.array().cast("array<struct<kind:int,pos:int,gap:int,size:int,value:string>>")))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("__text"),
                       F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(F.col(f"`{repo_col}`").cast("string"), F.lit("")).alias("repo"),
                       F.monotonically_increasing_id().alias("row"))
    return (base.withColumn("m", F.explode_outer(F.concat(*found)))
                .select("row", "id", "owner", "repo", "m.kind", "m.pos", "m.gap", "m.size",
                        F.md5(F.col("m.value").cast("binary")).alias("value"),
                        F.when((F.col("m.kind") == list(KINDS).index("owned")) & ~F.col("m.value").rlike("[0-9]"), 0)
                        .otherwise(F.char_length("m.value")).alias("chars")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id", max_owners: int = 1, max_repos: int = 10) -> DataFrame:
    """One row for each row of docs: id_col, n_<kind> for each kind, n_copied, n_live_all, n_copied_all, secrets (sorted spans).

    secrets is an array of (start, kind, kind_name, end, owners, repos, copied), code
    points, end exclusive, ordered by start, then kind as listed. A value is copied
    when more than max_owners distinct owners or more than max_repos distinct pairs
    of owner and repository hold it, else live. Base kinds are always listed. A run of
    20 or more key characters with a digit is listed as `owned` when it is live, else
    counted in n_copied. n_live_all and n_copied_all count the matches of all kinds by
    their verdict; a value that matches two kinds counts for both. Owners and repositories are counted over all rows; a null
    owner or repository is the empty one. Null text is empty. Repeated rows each give
    a row, and count once for owners. Columns of other names are ignored.
    """
    hits = staged(matches(docs, id_col, text_col, owner_col, repo_col), "secret-matches")
    least = F.element_at(F.array(*[F.lit(k[2]) for k in KINDS.values()]), F.col("kind") + 1)
    own = Window.partitionBy("row", "kind").orderBy("pos")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = (hits.withColumn("start", F.sum("gap").over(own.rowsBetween(Window.unboundedPreceding, 0))
                              + F.coalesce(F.sum("size").over(before), F.lit(0)))
                  .withColumn("valid", F.coalesce(F.col("chars") >= least, F.lit(False))))
    # A value with many holders folds to one row for each of them, then for each owner.
    held = staged(hits.where(F.col("chars") >= least).groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
                  .groupBy("value", "owner").agg(F.count("*").alias("repos"))
                  .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos")), "owned-values")
    judged = placed.join(held, "value", "left")
    owned = F.col("kind") == list(KINDS).index("owned")
    copied = (F.col("owners") > max_owners) | (F.col("repos") > max_repos)
    listed = F.col("valid") & (~owned | ~copied)
    names = F.array(*[F.lit(k) for k in KINDS])
    span = F.struct(F.col("start"), F.col("kind"), F.element_at(names, F.col("kind") + 1).alias("kind_name"),
                    (F.col("start") + F.col("size")).alias("end"), "owners", "repos", copied.alias("copied"))
    counts = [F.count(F.when(listed & (F.col("kind") == n), 1)).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return (judged.groupBy("row").agg(
                F.first("id").alias(id_col), *counts,
                F.count(F.when(F.col("valid") & owned & ~listed, 1)).alias("n_copied"),
                F.count(F.when(F.col("valid") & ~copied, 1)).alias("n_live_all"),
                F.count(F.when(F.col("valid") & copied, 1)).alias("n_copied_all"),
                F.sort_array(F.collect_list(F.when(listed, span))).alias("secrets"))
            .drop("row"))


def spans_text(secrets, kinds=tuple(KINDS)):
    """kind:start:end, comma-joined, of the given kinds."""
    return F.array_join(F.transform(
        F.filter(secrets, lambda s: s["kind_name"].isin(*kinds)),
        lambda s: F.concat_ws(":", s["kind_name"], s["start"].cast("string"), s["end"].cast("string"))), ",")
