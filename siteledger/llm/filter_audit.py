"""What each filter of a chain removes in every order, and its exact Shapley share, from the removals of all coalitions."""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteledger.functions.binding import let
from siteledger.operators import staged

BLANKS = r"[\x20\x09-\x0D]+"


def shapley_weights(n: int) -> list[list[int]]:
    """For each of ``n`` players, the weight of every coalition's value in n! times the player's Shapley value.

    Least squares of coalition values against sums of shares, weighted by
    (n - 1) / (C(n, s) s (n - s)) for s of n players, where all shares add up to
    the value of the whole. The normal equations with that constraint are solved
    in rationals for a right-hand side that is linear in the 2^n values, so one
    solution serves all parts. Coalitions are numbered by their bits.
    """
    whole = 2**n - 1
    kernel = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, whole) if (k := s.bit_count())}
    rows = [[sum((w for s, w in kernel.items() if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    rows = [row + [kernel.get(s, Fraction(0)) * (s >> i & 1) for s in range(whole + 1)] for i, row in enumerate(rows)]
    rows.append([Fraction(1)] * n + [Fraction(0)] + [Fraction(s == whole) for s in range(whole + 1)])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and (by := rows[r][c]):
                rows[r] = [x - by * y for x, y in zip(rows[r], rows[c], strict=True)]
    scaled = [[x * factorial(n) for x in row[n + 1 :]] for row in rows[:n]]
    assert all(x.denominator == 1 for row in scaled for x in row)
    return [[int(x) for x in row] for row in scaled]


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: too few words, repeated words, capitals, symbols."""
    words = F.array_remove(F.split(text, BLANKS), "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    letters = let(text, lambda t: F.length(F.regexp_replace(t, "[^A-Z]+", "")) * 100 > F.length(t) * 5)
    return {
        "A": counts["n"] < 50,
        "B": counts["d"].cast("long") * 100 < counts["n"].cast("long") * 65,
        "C": letters,
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """(part, mask, good, toxic, n): rows counted by the filters that they fail, one bit each, and the filters' letters.

    The last filter, E, fails rows whose text another row with a smaller id has.
    Texts are known by their SHA-256, so no text is shuffled: all rows are counted
    as failing E, and then those that come first among their text's rows are
    counted back. A row without id comes after all rows with one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    conditions = text_filters(F.col("_text"))
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("_text"))
    # Words are split once: the conditions on them share one expression of the projection.
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(conditions.values())), F.lit(0))
    rows = read.select("_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("sha"), mask.cast("int").alias("mask"))
    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_l"))
    flags = flags.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    kinds = ["part", "mask", "good", "toxic"]
    joined = rows.join(flags, F.col("_id") == F.col("_l"), "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Repeated rows count as one with a number; keys hold the id, so none is hot.
    last = F.coalesce(F.col("_id"), F.lit((1 << 63) - 1)).alias("id")
    known = staged(joined.groupBy("sha", last, *kinds).agg(F.count("*").alias("n")))
    first = staged(known.groupBy("sha").agg(F.min("id").alias("id")))
    kept = known.join(first, ["sha", "id"], "left_semi")
    bit = 1 << len(conditions)
    all_ = known.groupBy(*kinds).agg(F.sum("n").alias("n")).withColumn("mask", F.col("mask") + bit)
    back = kept.groupBy(*kinds).agg(F.sum("n").alias("n"))
    again = back.withColumn("mask", F.col("mask") + bit).withColumn("n", -F.col("n"))
    counted = all_.unionByName(back).unionByName(again).groupBy(*kinds).agg(F.sum("n").alias("n"))
    return counted.where("n > 0"), [*conditions, "E"]


def filter_interactions(counted: DataFrame, letters: list[str]) -> DataFrame:
    """All orders of the filters, step by step, for every part.

    ``counted`` has (part, mask, good, toxic, n), as ``failures`` gives it. What a
    coalition of filters removes is tabulated for all coalitions; a step removes
    the difference between the coalition with and without its filter, and the
    Shapley share times n! is an integer sum over coalitions. Both need as many
    rows a part as there are coalitions, whatever the number of documents.

    Result: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. Parts are those of ``counted``; without rows
    there are none. Texts, ids, labels: see ``failures``. A null text is empty, so
    it fails A and, from the second on, E; a null part is the empty string; of
    several labels of a document one with the value is enough; repeated rows count
    each, and those with the first id of their text pass E together.
    """
    n, orders = len(letters), list(permutations(range(len(letters))))
    whole = 2**n - 1
    hit = F.col("mask").bitwiseAND(F.col("_s")) != 0
    lost = {"all": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    spread = counted.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(whole))))
    sums = spread.groupBy("part", "_s").agg(
        F.sum("n").alias("rows"), *[F.sum(F.when(hit & F.coalesce(flag, F.lit(False)), F.col("n")).otherwise(0)).alias(f"v_{name}") for name, flag in lost.items()]
    )
    # One row a part, with what each of the coalitions removes.
    table = F.sort_array(F.collect_list(F.struct("_s", *[f"v_{name}" for name in lost])))
    parts = sums.groupBy("part").agg(F.max("rows").alias("rows"), table.alias("v"))
    weights = shapley_weights(n)

    def share(i: int) -> Column:
        terms = [F.col("v")[s]["v_all"] * w for s, w in enumerate(weights[i]) if w]
        return sum(terms[1:], terms[0])

    steps = []
    for order in orders:
        name, before = "".join(letters[i] for i in order), 0
        for k, i in enumerate(order):
            steps.append(f"{name},{k + 1},{i},{before}")
            before |= 1 << i
    one = parts.withColumn("shares", F.array(*[share(i) for i in range(n)]))
    listed = one.withColumn("_x", F.explode(F.split(F.lit(" ".join(steps)), " "))).withColumn("_x", F.split("_x", ","))
    at = {name: F.get(F.col("_x"), F.lit(k)).cast("int") for k, name in enumerate(["", "step", "i", "before"]) if name}
    flat = listed.select("part", "rows", "v", "shares", F.get(F.col("_x"), F.lit(0)).alias("filter_order"), *[c.alias(name) for name, c in at.items()])
    own = F.expr("shiftleft(1, i)")

    def value(mask: Column, name: str = "all") -> Column:
        return F.get(F.col("v"), mask)[f"v_{name}"]

    after, before = F.col("before").bitwiseOR(own), F.col("before")
    removed = value(after) - value(before)
    return flat.select(
        "part", "filter_order", "step", (F.col("rows") - value(after)).alias("kept"), removed.alias("removed"), (value(own) - removed).alias("redundant"),
        (value(F.lit(whole)) - value(F.lit(whole).bitwiseXOR(own))).alias("unique_fails"),
        *[(value(after, name) - value(before, name)).alias(f"{name}_lost") for name in ("good", "toxic")],
        F.get(F.col("shares"), F.col("i")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``filter_interactions`` of the filters A to E on documents."""
    return filter_interactions(*failures(docs, labels, **columns))
