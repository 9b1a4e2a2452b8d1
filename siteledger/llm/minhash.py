"""Near-duplicates by an inverted join of MinHash signatures, confirmed on full sets of shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import bitmap, in_bitmap, release, shingle_hashes, text_bytes, token_hashes
from .components import components

COORDINATES = 48
DEVIATIONS = 4.4
SMALL = 32
HEADS = 32
TURNS = 3
SLICE_BYTES = 8 << 20
_SETS = "_doc long, n long, s1 long, s2 long, sig binary"


def least_matches(percent: int, coordinates: int = COORDINATES, deviations: float = DEVIATIONS) -> int:
    """Equal coordinates that a pair of the given similarity has, but for ``deviations`` standard deviations."""
    share = percent / 100
    return max(1, math.floor(coordinates * share - deviations * math.sqrt(coordinates * share * (1 - share))))


def _sets(part: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of a batch, in runs of bounded size."""
    data, ends = text_bytes(part.column(part.schema.get_field_index("_text")))
    begin = 0
    while begin < len(part):
        stop = max(int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, side="right")) - 1, begin + 1)
        stop = min(stop, len(part))
        hashes, texts = token_hashes(data[ends[begin] : ends[stop]], ends[begin : stop + 1] - ends[begin])
        cuts = np.searchsorted(texts, np.arange(stop - begin + 1))
        for k in range(stop - begin):
            yield begin + k, np.unique(shingle_hashes(hashes[cuts[k] : cuts[k + 1]], shingle))
        begin = stop


def _signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """32-bit MinHash values of non-empty sets, one row each."""
    factors = np.random.default_rng(4).integers(1, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1)
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), coordinates), np.uint32)
    for k, factor in enumerate(factors):
        mixed = flat * factor
        mixed ^= mixed >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(mixed * factor, starts) >> np.uint64(32)
    return out


def _set_rows(shingle: int, coordinates: int):
    schema = pa.schema([("_doc", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sig", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, rows, held, size = part.column(part.schema.get_field_index("_doc")).to_pylist(), [], [], 0

            def done(rows: list, held: list) -> pa.RecordBatch:
                full = [s for s in held if len(s)]
                signs = iter(_signatures(full, coordinates) if full else ())
                names = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist() if len(s) else (0, 0) for s in held]
                columns = [rows, [len(s) for s in held], [a for a, _ in names], [b for _, b in names], [next(signs).tobytes() if len(s) else b"" for s in held]]
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

            for row, found in _sets(part, shingle):
                rows.append(ids[row])
                held.append(found)
                size += len(found)
                if size > 1 << 20:
                    yield done(rows, held)
                    rows, held, size = [], [], 0
            if rows:
                yield done(rows, held)

    return run


def _full_rows(shingle: int, wanted: np.ndarray):
    """Sets of the documents whose hash may be a wanted one."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            part = part.filter(pa.array(in_bitmap(wanted, part.column(part.schema.get_field_index("_h")).to_numpy())))
            if len(part):
                ids = part.column(part.schema.get_field_index("_doc")).to_pylist()
                for row, found in _sets(part, shingle):
                    yield pa.RecordBatch.from_arrays([pa.array([ids[row]], pa.int64()), pa.array([found.tobytes()], pa.binary())], schema=schema)

    return run


def _posting_rows(coordinates: int):
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("at", pa.int32())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if len(part):
                place = part.schema.get_field_index
                signs = np.frombuffer(b"".join(part.column(place("sig")).to_pylist()), np.uint32).reshape(len(part), coordinates)
                keys = signs.astype(np.int64) | (np.arange(coordinates, dtype=np.int64) << 32)
                columns = [keys.ravel()] + [np.repeat(part.column(place(c)).to_numpy(), coordinates) for c in ("node", "n")]
                at = np.tile(np.arange(coordinates, dtype=np.int32), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in [*columns, at]], schema=schema)

    return run


def _match_rows(coordinates: int, least: int):
    """Pairs with at least ``least`` equal coordinates; those that cannot reach it after half of them are skipped."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not len(part):
                continue
            place, half = part.schema.get_field_index, coordinates // 2
            one, two = (np.frombuffer(b"".join(part.column(place(c)).to_pylist()), np.uint32).reshape(len(part), coordinates) for c in ("sig_a", "sig_b"))
            equal = (one[:, :half] == two[:, :half]).sum(axis=1)
            rest = np.flatnonzero(equal + coordinates - half >= least)
            equal[rest] += (one[rest, half:] == two[rest, half:]).sum(axis=1)
            keep = pa.array(equal >= least)
            yield pa.RecordBatch.from_arrays([part.column(place(c)).filter(keep) for c in ("a", "b")], schema=schema)

    return run


def _confirm_rows(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            place, keep = part.schema.get_field_index, []
            for one, two in zip(part.column(place("set_a")), part.column(place("set_b")), strict=True):
                one, two = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(one, two), len(one) - 1)
                both = int((one[at] == two).sum())
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(place(c)).filter(keep) for c in ("a", "b")], schema=schema)

    return run


def _sized(percent: int):
    """Sets of these sizes can be similar enough."""
    return (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    sets = full.select("node", "shingles")
    one = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "set_a"}), "a")
    two = one.join(sets.withColumnsRenamed({"node": "b", "shingles": "set_b"}), "b")
    return staged(two.select("a", "b", "set_a", "set_b").mapInArrow(_confirm_rows(percent), "a long, b long"))


def _matching(pairs: DataFrame, nodes: DataFrame, percent: int, coordinates: int, least: int) -> DataFrame:
    signs = nodes.select("node", "sig")
    one = pairs.join(signs.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
    two = one.join(signs.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
    return two.select("a", "b", "sig_a", "sig_b").mapInArrow(_match_rows(coordinates, least), "a long, b long")


def _shingle_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        place = part.schema.get_field_index
        for node, data in zip(part.column(place("node")).to_pylist(), part.column(place("shingles")).to_pylist(), strict=True):
            found = np.frombuffer(data, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(found)], names=["node", "shingle"])


def _starred(lists: DataFrame, key: str, near: DataFrame) -> DataFrame:
    """Pairs of the best-connected member of each list with its members of other components: as many as members."""
    weighed = lists.join(near.select("node", "weight"), "node")
    heads = staged(weighed.groupBy(key).agg(F.max_by(F.struct("node", "n", "label"), "weight").alias("h")).select(key, F.col("h.node").alias("_h"), F.col("h.n").alias("n_b"), F.col("h.label").alias("_l")))
    pairs = lists.withColumnRenamed("n", "n_a").join(heads, key).where((F.col("label") != F.col("_l")))
    return pairs.select(F.col("node"), F.col("_h"), "n_a", "n_b").distinct()


def _crossed(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs of members of a list that are in different components and may be similar.

    ``rest``, if there, is how many shingles a member can share with others from
    this list's shingle on, in the common order. A similar pair shares enough of
    them from its first common shingle on, and is found in that list.
    """
    more = ["rest"] if "rest" in rows.columns else []
    one = rows.select(key, F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("_la"), *[F.col(c).alias(f"{c}_a") for c in more])
    two = rows.select(key, F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("_lb"), *[F.col(c).alias(f"{c}_b") for c in more])
    fits = (F.col("_la") < F.col("_lb")) & _sized(percent)
    if more:
        fits &= _shareable(percent)
    return one.join(two, key).where(fits).select("a", "b").distinct()


def _headed(lists: DataFrame, key: str, percent: int, turn: int, heads: int = HEADS) -> DataFrame:
    """Pairs of some members of each list's largest component, others each turn, with its members of other components.

    Members that are near some of a large component, but not its centre, are likely
    to meet one; the pairs are as many as members times ``heads``.
    """
    parts = lists.groupBy(key, "label").agg(F.count("*").alias("_k"))
    largest = staged(parts.groupBy(key).agg(F.max(F.struct("_k", "label")).alias("_x")).select(key, F.col("_x.label").alias("_l"), F.col("_x._k").alias("_k")))
    known = lists.join(largest, key)
    # As many heads as asked for on average, drawn row by row.
    drawn = known.where(F.col("label") == F.col("_l")).where(F.pmod(F.xxhash64("node", F.lit(turn)), F.col("_k")) < heads)
    drawn = staged(drawn.select(key, F.col("node").alias("_h"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b")))
    minor = staged(known.where(F.col("label") != F.col("_l")).select(key, "node", F.col("n").alias("n_a"), F.col("rest").alias("rest_a")))
    pairs = minor.join(drawn, key).where(_sized(percent)).where(_shareable(percent))
    return pairs.select(F.least("node", "_h").alias("a"), F.greatest("node", "_h").alias("b")).distinct()


def _shareable(percent: int):
    """What both sets can share from a list's shingle on is enough."""
    return F.least("rest_a", "rest_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent


def _open(posts: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Members (key, node, n, label, m) of the lists that still hold several components."""
    known = staged(posts.join(labels, "node"))
    split = known.groupBy(key).agg(F.count("*").alias("m"), F.min("n").alias("n_min"), F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    return staged(known.join(staged(split.where("_lo < _hi").select(key, "m", "n_min")), key))


def _rare_lists(hot: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, n, rest) of the shingles under which similar sets among the hot ones (node, n, n_min) must meet.

    A set of n shingles and a similar one of k share at least t / (1 + t) (n + k)
    of them, and k is at least n_min. So a set with fewer shingles that occur in
    another one has no partner, and similar sets share one of the first
    n - overlap + 1 in the order of rarity.
    """
    words = staged(full.join(hot.select("node"), "node", "left_semi").select("node", "shingles").mapInArrow(_shingle_rows, "node long, shingle long"))
    common = staged(words.groupBy("shingle").agg(F.count("*").alias("_c")).where("_c > 1"))
    shared = words.join(common, "shingle")
    smallest = F.greatest(F.col("n_min"), F.ceil(F.col("n") * percent / 100))
    need = F.ceil((F.col("n") + smallest) * percent / (100 + percent)).cast("long")
    counted = staged(shared.groupBy("node").agg(F.count("*").alias("_s")))
    strong = staged(hot.join(counted, "node").withColumn("_need", need).where("_s >= _need"))
    left = shared.join(strong.select("node", "n", "_s", "_need"), "node")
    # What occurs in one set alone takes the first places of its order and links nothing.
    first = F.col("_s") - F.col("_need") + 1
    ranked = left.groupBy("node", "n", "_s", "_need").agg(F.sort_array(F.collect_list(F.struct("_c", "shingle"))).alias("_x"))  # of one set
    taken = ranked.select("node", "n", "_s", F.posexplode(F.slice("_x", F.lit(1), first.cast("int"))).alias("_i", "_x"))
    return staged(taken.select("_x.shingle", "node", "n", (F.col("_s") - F.col("_i")).alias("rest")))


def _joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after links between components."""
    if links.isEmpty():
        return labels
    ends = labels.select(F.col("node").alias("a"), F.col("label").alias("_a"))
    others = labels.select(F.col("node").alias("b"), F.col("label").alias("_b"))
    across = links.join(ends, "a").join(others, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
    above = components(labels.select(F.col("label").alias("node")).distinct(), across)
    above = above.select(F.col("node").alias("_of"), F.col("label").alias("_top"))
    return staged(labels.join(above, F.col("label") == F.col("_of")).select("node", F.col("_top").alias("label")))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    coordinates: int = COORDINATES, deviations: float = DEVIATIONS, small: int = SMALL,
) -> DataFrame:
    """Every document with its component of near-duplicates.

    A document's set has its distinct shingles of ``shingle`` words, A to Z in
    lower case; fewer words are one shingle. Documents are linked if their sets'
    Jaccard similarity is at least ``percent`` / 100, confirmed on full sets.

    Equal sets are one node. Nodes are posted under each coordinate-value pair of
    their signatures; a node that has a counterpart in too few coordinates has no
    link. Pairs with the least number of equal coordinates also agree in one of
    the first few, so only those are merged. In each posting all members are
    first compared with its best-connected one, which joins large groups with as
    many pairs as members; then only pairs of different components are left.

    Result, one row per input row: id, n_shingles, component_id (smallest id
    reachable), kept (the id is that). Null or blank texts have an empty set and
    link with nothing. Ids are integers; rows that repeat an id count as one
    document. A row without id links nothing and has the component of an equal
    set, or null. An empty table gives no rows.
    """
    spark, least = docs.sparkSession, least_matches(percent, coordinates, deviations)
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("_doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    sets = staged(read.mapInArrow(_set_rows(shingle, coordinates), _SETS))
    full_sets = sets.where("n > 0 AND _doc IS NOT NULL")
    classes = staged(full_sets.groupBy("s1", "s2").agg(F.min("_doc").alias("node")))
    same = (sets["_doc"] == classes["node"]) & (sets["s1"] == classes["s1"]) & (sets["s2"] == classes["s2"])
    nodes = staged(sets.join(classes, same).select("node", "n", "sig").dropDuplicates(["node"]))
    posts = nodes.mapInArrow(_posting_rows(coordinates), "key long, node long, n long, at int")
    twice = staged(posts.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
    release(spark)
    shared = posts.join(twice, "key")
    strong = staged(shared.groupBy("node").agg(F.count("*").alias("_c"), F.sum("m").alias("weight")).where(F.col("_c") >= least).select("node", "weight"))
    near = staged(nodes.join(strong, "node"))
    labels = _labelled(read, near, shingle, percent, coordinates, least, small)
    release(spark)
    of_class = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("label", "node").alias("_label"))
    of_class = staged(of_class)
    joined = sets.join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("_label")).otherwise(F.col("_doc"))
    return joined.select(F.col("_doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("_doc")).alias("kept"))


def _labelled(read: DataFrame, near: DataFrame, shingle: int, percent: int, coordinates: int, least: int, small: int) -> DataFrame:
    """(node, label) of nodes that may have a link."""
    prefix = coordinates - least + 1
    posts = near.mapInArrow(_posting_rows(coordinates), "key long, node long, n long, at int").where(F.col("at") < prefix).drop("at")
    sizes = posts.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    posts = staged(posts.join(staged(sizes), "key"))
    hashed = F.xxhash64("node").alias("_h")
    texts = read.where("_doc IS NOT NULL").withColumn("_h", F.xxhash64("_doc"))
    found = texts.mapInArrow(_full_rows(shingle, bitmap(near.select(hashed), "_h")), "node long, shingles binary")
    full = staged(found.join(near.select("node"), "node").dropDuplicates(["node"]))
    release(read.sparkSession)

    def linked(pairs: DataFrame) -> DataFrame:
        return _confirmed(_matching(pairs, near, percent, coordinates, least), full, percent)

    def starred(lists: DataFrame, key: str) -> DataFrame:
        pairs = _starred(lists, key, near).where(_sized(percent))
        return linked(pairs.select(F.least("node", "_h").alias("a"), F.greatest("node", "_h").alias("b")).distinct())

    # All members of a posting with its best-connected one.
    alone = near.select("node", F.col("node").alias("label"))
    labels = components(near.select("node"), starred(posts.join(alone, "node"), "key"))
    open_ = _open(posts, labels, "key")
    # Short postings are then compared member by member, as far as components differ.
    labels = _joined_labels(labels, linked(_crossed(open_.where(F.col("m") <= small), "key", percent)))
    hot = staged(open_.where(F.col("m") > small).groupBy("node", "n").agg(F.min("n_min").alias("n_min")))
    if hot.isEmpty():
        return labels
    # Members of long ones meet again on their rarest shingles: first with the best-connected, then with all of other components.
    lists = _rare_lists(hot, full, percent)
    release(read.sparkSession)
    labels = _joined_labels(labels, starred(_open(lists, labels, "shingle"), "shingle"))
    for turn in range(TURNS):
        open_ = _open(lists, labels, "shingle")
        labels = _joined_labels(labels, linked(_headed(open_, "shingle", percent, turn)))
    return _joined_labels(labels, linked(_crossed(_open(lists, labels, "shingle"), "shingle", percent)))


def drop_near(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, that with the smallest id, with its columns as they are."""
    kept = near_duplicates(docs, shingle, percent, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("_kept_id"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{id_col}`").cast("long").alias("_id"))
    return packed.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")), "left_semi").select("_doc.*")
