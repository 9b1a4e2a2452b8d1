"""Personal data: base patterns, and identifiers that only their context gives away. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

KINDS = ("email", "ip", "card", "phone")
# Each pattern finds what its plain form in the comment finds, but never reads a run of characters twice:
# a match that could begin inside a run could as well begin where the run does, or where the match before it ended.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
# Three to five groups of two to four digits parted by blanks, or a word with a digit or an at sign.
CANDIDATE = r"(?<!\S)(?:\(?[0-9]{2,4}\)?(?:\x20[0-9]{2,4}){2,4}(?=[\s.,;:!?]|$)|[^\s0-9@]*+[0-9@]\S*+)"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# What a word must look like to be an unseen identifier of a kind.
LOOKS = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^(?=.*[0-9])[0-9A-Fa-f]*:[0-9A-Fa-f:]*:[0-9A-Fa-f]*$",
    "card": r"^[0-9]{14,19}$",
    "phone": r"^\(?[0-9](?:[().-]?[0-9]){6,14}$|^(?=(?:[^0-9]*[0-9]){7,15}$)\(?[0-9]{2,4}\)?(?:\x20[0-9]{2,4}){2,4}$",
}
BLOCK = 256
ROUNDS = 2
CONFIDENCE = 0.8
SUPPORT = 5.0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _sizes(pieces: Column, matches: Column) -> Column:
    """Lengths of each match and of the text before it."""
    return F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(F.length(p).cast("long").alias("p"), F.length(m).cast("long").alias("m")))


def _starts(sizes: Column) -> Column:
    """Where each match starts, in code points.

    Running sums go block by block, so a text with a million matches is no square
    of work; ``sizes`` has to be a column of its own, as every block is cut from it.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, BLOCK))
    nothing = F.array().cast("array<bigint>")

    def totals(acc: Column, block: Column) -> Column:
        whole = F.aggregate(block, F.lit(0).cast("long"), lambda a, x: a + x["p"] + x["m"])
        return F.struct((acc["at"] + whole).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))

    def within(block: Column, offset: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x["p"] + x["m"]).alias("at"), F.array_append(acc["out"], acc["at"] + x["p"]).alias("out"))

        return F.aggregate(block, F.struct(offset.alias("at"), nothing.alias("out")), step, lambda acc: acc["out"])

    offsets = F.aggregate(blocks, F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out")), totals, lambda acc: acc["out"])
    return F.flatten(F.zip_with(blocks, offsets, within))


def _reach(spans: Column) -> Column:
    """(start, top) of each span in order of start; top is the greatest end so far. Goes block by block like ``_starts``."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), lambda b: F.slice(spans, b * BLOCK + 1, BLOCK))
    below = F.lit(0).cast("long")

    def tops(acc: Column, block: Column) -> Column:
        own = F.array_max(F.transform(block, lambda x: x["end"]))
        return F.struct(F.greatest(acc["top"], own).alias("top"), F.array_append(acc["out"], acc["top"]).alias("out"))

    def within(block: Column, top: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            higher = F.greatest(acc["top"], x["end"])
            return F.struct(higher.alias("top"), F.array_append(acc["out"], F.struct(x["start"].alias("start"), higher.alias("top"))).alias("out"))

        nothing = F.array().cast("array<struct<start:bigint,top:bigint>>")
        return F.aggregate(block, F.struct(top.alias("top"), nothing.alias("out")), step, lambda acc: acc["out"])

    before = F.aggregate(blocks, F.struct(below.alias("top"), F.array().cast("array<bigint>").alias("out")), tops, lambda acc: acc["out"])
    return F.flatten(F.zip_with(blocks, before, within))


def _is_free(x: Column, reach: Column) -> Column:
    """Whether no span overlaps x: the last one to start before its end, found by halving, reaches no farther than its start."""

    def half(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        before = F.get(reach, middle)["start"] < x["end"]
        more = acc["low"] < acc["high"]
        return F.struct(F.when(more & before, middle + 1).otherwise(acc["low"]).alias("low"), F.when(more & ~before, middle).otherwise(acc["high"]).alias("high"))

    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(reach).cast("double"))).cast("int"))
    count = F.aggregate(halvings, F.struct(F.lit(0).alias("low"), F.size(reach).alias("high")), half, lambda acc: acc["low"])
    return F.coalesce(F.get(reach, count - 1)["top"] <= x["start"], F.lit(True))


def _found(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Adds an array of (start, value, left, right) of all matches of a pattern; left and right are the words next to them."""
    text, there = F.col("_text"), F.col("_text").rlike(needs)
    # Regular expressions run in projections of their own, so nothing reads a text twice.
    df = df.withColumn("_m", F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, pattern, -1)))
    df = df.withColumn("_z", F.when(F.size("_m") > 0, _sizes(F.col("_p"), F.col("_m"))))
    df = df.withColumn("_s", F.when(F.size("_z") > 0, _starts(F.col("_z"))))

    def last(piece: Column) -> Column:
        return F.lower(F.regexp_extract(piece, r"(?<!\S)(\S++)\s*+$", 1))

    def first(piece: Column) -> Column:
        return F.lower(F.regexp_extract(piece, r"^\s*+(\S++)", 1))

    def entry(start: Column, i: Column) -> Column:
        return F.struct(
            start.alias("start"), F.get(F.col("_m"), i).alias("value"),
            last(F.get(F.col("_p"), i)).alias("left"), first(F.get(F.col("_p"), i + 1)).alias("right"),
        )

    none = F.array().cast("array<struct<start:bigint,value:string,left:string,right:string>>")
    return df.withColumn(name, F.coalesce(F.transform("_s", entry), none)).drop("_m", "_p", "_z", "_s")


def _kept(kind: str) -> Column:
    def span(x: Column) -> Column:
        end = x["start"] + F.length(x["value"])
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), x["value"], x["left"], x["right"])

    return F.transform(F.filter(f"_{kind}", lambda x: _valid(kind, x["value"])), span)


def _joined(spans: Column) -> Column:
    """kind:start:end of (start, kind, end), sorted and joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_row, _id, base, candidates) of every row, staged: texts are read once."""
    df = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    for kind in KINDS:
        df = _found(df, f"_{kind}", PATTERNS[kind], NEEDS[kind])
    df = _found(df, "_words", CANDIDATE, "[0-9@]")
    df = df.withColumn("base", F.sort_array(F.concat(*[_kept(kind) for kind in KINDS])))

    def bare(x: Column) -> Column:
        front = F.length(x["value"]) - F.length(F.ltrim(x["value"], F.lit("\"'([{<")))
        value = F.btrim(F.substr(x["value"], front + 1), F.lit("\"'([{<>}]).,;:!?"))
        return F.struct((x["start"] + front).alias("start"), (x["start"] + front + F.length(value)).alias("end"), value.alias("value"), x["left"], x["right"])

    # Spans that do not overlap are sought by halving, so a text with many spans and words is no square of work.
    df = df.select("_id", "base", F.transform("_words", bare).alias("_bare"), F.when(F.size("base") > 0, _reach(F.col("base"))).alias("_reach"))
    df = df.select("_id", "base", F.filter("_bare", lambda x: (F.length(x["value"]) > 0) & _is_free(x, F.col("_reach"))).alias("candidates"))
    return staged(df.withColumn("_row", F.monotonically_increasing_id()))


def _patterns(left: Column, right: Column) -> Column:
    """Lexical patterns of a place: the word before it, the one after it, and both."""
    before, after = F.concat(F.lit("< "), left), F.concat(F.lit("> "), right)
    return F.filter(F.array(F.when(left != "", before), F.when(right != "", after), F.concat(before, after)), lambda p: p.isNotNull())


def discovered(scan: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: float = SUPPORT) -> DataFrame:
    """(_row, start, end, kind) of words that patterns learnt from the base spans give away.

    Base spans are the seeds. A pattern's confidence in a kind is the weight of
    its seeds and believed words of that kind among all its identifier-like
    places, with ``support`` places of doubt added, so rare patterns prove
    nothing. A word that looks like a kind is believed as much as its best pattern:
    one side is enough, and neither a common word on the other side nor a rare pair
    takes from it. A few short groups of digits parted by blanks are one word. After ``rounds`` rounds over the graph of patterns and words,
    words believed by ``confidence`` or more are identifiers wherever they stand.
    """
    seeds = scan.select("_row", F.explode("base").alias("x")).select("_row", "x.start", "x.end", "x.value", "x.left", "x.right", "x.kind")
    words = scan.select("_row", F.explode("candidates").alias("x")).select("_row", "x.start", "x.end", "x.value", "x.left", "x.right", F.lit(None).cast("int").alias("kind"))
    places = staged(seeds.unionByName(words).withColumn("patterns", _patterns(F.col("left"), F.col("right"))))
    edges = places.select("value", "kind", F.explode("patterns").alias("pattern"))
    # Places of one pattern and word count together from here on, which also takes the weight off frequent ones.
    edges = staged(edges.groupBy("value", "kind", "pattern").agg(F.count("*").alias("n")))
    seen = [F.when(F.col("kind") == k, F.lit(1.0)).otherwise(0.0) for k in range(len(KINDS))]
    looks = [F.when(F.col("value").rlike(LOOKS[kind]), F.lit(1.0)).otherwise(0.0) for kind in KINDS]
    believed = None
    for _ in range(rounds):
        scored = edges.select("*", *[s.alias(f"s{k}") for k, s in enumerate(seen)])
        if believed is not None:
            mine = [F.when(F.col("kind").isNull(), F.coalesce(f"b{k}", F.lit(0.0))).otherwise(F.col(f"s{k}")).alias(f"s{k}") for k in range(len(KINDS))]
            scored = scored.join(believed, "value", "left").select("value", "kind", "pattern", "n", *mine)
        trust = scored.groupBy("pattern").agg(*[(F.sum(F.col(f"s{k}") * F.col("n")) / (F.sum("n") + support)).alias(f"r{k}") for k in range(len(KINDS))])
        trust = trust.where(" OR ".join(f"r{k} > 0" for k in range(len(KINDS))))
        open_ = edges.where("kind IS NULL").select("value", "pattern", "n", *[x.alias(f"l{k}") for k, x in enumerate(looks)])
        open_ = open_.where(" OR ".join(f"l{k} > 0" for k in range(len(KINDS)))).join(trust, "pattern", "left")
        belief = [(F.max(F.coalesce(f"r{k}", F.lit(0.0))) * F.max(f"l{k}")).alias(f"b{k}") for k in range(len(KINDS))]
        believed = staged(open_.groupBy("value").agg(*belief))
    top = F.greatest(*[F.col(f"b{k}") for k in range(len(KINDS))])
    kind = F.coalesce(*[F.when(F.col(f"b{k}") == top, F.lit(k)) for k in range(len(KINDS))])
    sure = believed.where(top >= confidence).select("value", kind.alias("kind"))
    return places.where("kind IS NULL").drop("kind").join(sure, "value").select("_row", "start", "end", "kind")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Personal data of every row: id, n_<kind> and base_sha256 of the base spans, spans (all), n_added.

    Spans are kind:start:end in code points, end exclusive, sorted by start and
    kind and joined by commas. Base spans are the leftmost matches of each
    kind's pattern that pass its check; ``discovered`` adds words in contexts
    where such spans stand. Null text is empty and has no spans; null ids and
    repeated rows are rows of their own; an empty table gives no rows. Only the
    two named columns are read.
    """
    scan = _scan(docs, id_col, text_col)
    spans = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    base = scan.select("_row", "_id", spans.alias("_base"))
    added = discovered(scan, **options).groupBy(F.col("_row").alias("_r")).agg(F.collect_list(F.struct("start", "kind", "end")).alias("_added"))  # of one text
    joined = base.join(added, F.col("_row") == F.col("_r"), "left")
    more = F.coalesce("_added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))

    def count(k: int) -> Column:
        return F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(len(KINDS))]
    return joined.select(
        F.col("_id").alias(id_col), *counts, F.sha2(_joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("_base", more))).alias("spans"), F.size(more).cast("long").alias("n_added"),
    )
