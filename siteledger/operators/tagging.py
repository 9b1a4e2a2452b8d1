"""Category of a page by counting tag words in its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, text_list
from .sizing import fits_broadcast, staged

WORD = r"(?U)\A\w+\z"
PHRASE = r"(?U)\A\w+(?:[ -]\w+)+\z"
# A word, with the blank or hyphen that alone parts it from the next one.
PIECE = r"(?U)\w++(?:[ -](?=\w))?+"
# So few phrases are faster searched one by one.
FEW_PHRASES = 32


def _entries(tags: DataFrame) -> DataFrame:
    """(tag_id, tag, weight, words) of (id, "a, b, c") rows; ``words`` is 0 for what has to be searched as a pattern.

    Phrases that can overlap themselves are patterns, as a search does not count overlaps.
    """
    one = tags.select(F.col("id").alias("tag_id"), F.explode(F.split(F.coalesce("tag", F.lit("")), ",")).alias("tag"))
    one = one.withColumn("tag", F.regexp_replace("tag", r"(?U)\A\s+|\s+\z", ""))
    words = F.split("tag", "[ -]")
    shifts = F.expr("sequence(1, greatest(size(_w) - 1, 1))")
    overlaps = F.exists(shifts, lambda k: F.slice("_w", F.lit(1), k) == F.slice("_w", F.size("_w") - k + 1, k))
    kind = F.when(F.col("tag").rlike(WORD), 1).when(F.col("tag").rlike(PHRASE) & ~overlaps, F.size("_w")).otherwise(0)
    return one.withColumn("_w", words).groupBy("tag_id", "tag", kind.alias("words")).agg(F.count("*").alias("weight"))


def _phrases(pieces: Column, n: int) -> Column:
    """All phrases of ``n`` words, overlapping ones too: as many pieces, but for the last all with what parts them."""

    def at(i: Column) -> Column:
        return F.rtrim(F.concat(*[F.get(pieces, i + k) for k in range(n)]), F.lit(" -"))

    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(pieces) - n, F.lit(0))), lambda i: i + n <= F.size(pieces))
    return F.filter(F.transform(places, at), lambda whole: F.length(whole) - F.length(F.translate(whole, " -", "")) == n - 1)


def _grams(text: Column, lengths: list[int]) -> Column:
    """All words of a text, and the phrases of the given numbers of words."""
    found = [F.regexp_extract_all(text, F.lit(r"(?U)\w+"), F.lit(0))] if 1 in lengths else []
    if more := [n for n in lengths if n > 1]:
        found.append(let(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda pieces: F.concat(*[_phrases(pieces, n) for n in more])))
    return F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in found])


def category_votes(pages: DataFrame, tags: DataFrame, text: Column, key: str = "page_id", unique: bool = True) -> DataFrame:
    """Number of hits per page and tag row: (key, tag_id, votes); pages without a hit come out once with NULLs.

    A hit is the tag between word boundaries, case-sensitive; a tag listed twice
    counts twice. Tags of words and phrases (words with a blank or a hyphen
    between them) are an inverted table of their own, joined by equality: broadcast
    as long as it is small, else with words that are counted per page before they
    are shuffled. Tags with other characters, and phrases where there are few, are searched as
    patterns in every text; only these come to the driver. Votes of rows with one key are added up,
    whether keys are said to be unique or not.
    """
    entries = _entries(tags)
    small = fits_broadcast(entries)
    entries = entries if small else staged(entries)
    if small and entries.where("words > 1").limit(FEW_PHRASES + 1).count() <= FEW_PHRASES:
        entries = entries.withColumn("words", F.when(F.col("words") == 1, 1).otherwise(0))
    lengths = sorted(r["words"] for r in entries.select("words").distinct().collect())  # how many words tags have
    counts = []
    if any(lengths):
        # An outer explode, as Spark would build the words again to filter texts without any.
        grams = pages.select(key, F.explode_outer(_grams(text, [n for n in lengths if n])).alias("tag"))
        table = entries.where("words > 0").select("tag_id", "tag", "weight")
        if small:
            hits = grams.join(F.broadcast(table), "tag").select(key, "tag_id", F.col("weight").alias("votes"))
        else:
            counted = grams.groupBy(key, "tag").agg(F.count("*").alias("_n"))
            hits = counted.join(table, "tag").select(key, "tag_id", (F.col("weight") * F.col("_n")).alias("votes"))
        counts.append(hits)
    if 0 in lengths:
        patterns = [(r["tag_id"], r["tag"], r["weight"]) for r in entries.where("words = 0").orderBy("tag_id", "tag").collect()]
        ids, weights = (text_list([str(x[k]) for x in patterns]).cast("array<bigint>") for k in (0, 2))
        listed = text_list([rf"(?U)\b{p}\b" for _, p, _ in patterns])
        found = F.zip_with(F.arrays_zip(ids.alias("i"), weights.alias("w")), listed, lambda x, p: F.struct(x["i"].alias("tag_id"), (F.regexp_count(text, p) * x["w"]).alias("votes")))
        rows = pages.select(key, F.explode_outer(F.filter(found, lambda s: s["votes"] > 0)).alias("_v"))
        counts.append(rows.where("_v IS NOT NULL").select(key, F.col("_v.tag_id").cast(tags.schema["id"].dataType).alias("tag_id"), F.col("_v.votes").alias("votes")))
    every = pages.select(key).distinct() if not unique else pages.select(key)
    if not counts:
        return every.select(key, F.lit(None).cast("int").alias("tag_id"), F.lit(None).cast("bigint").alias("votes"))
    hits = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])
    votes = hits.groupBy(key, "tag_id").agg(F.sum("votes").alias("votes"))
    named = every.withColumnRenamed(key, "_k")
    return named.join(votes, F.col("_k").eqNullSafe(F.col(key)), "left").select(F.col("_k").alias(key), "tag_id", "votes")


def identify_category(pages: DataFrame, tags: DataFrame, text: Column, key: str = "page_id", unique: bool = True) -> DataFrame:
    """Best tag row per page (key, tag_id); ties go to the lowest id, no hit to 0."""
    votes = category_votes(pages, tags, text, key, unique)
    best = F.max(F.when(F.col("tag_id").isNotNull(), F.struct(F.col("votes"), (-F.col("tag_id")).alias("t"))))
    return votes.groupBy(key).agg(best.alias("_best")).select(key, F.coalesce(-F.col("_best.t"), F.lit(0)).alias("tag_id"))
