"""Language of a text by its nearest centroid among TF-IDF vectors of byte n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import batches, rows_of, texts_of, unstage, with_text

DIMS = 4096
SAMPLE_PER_LANGUAGE = 400
CENTROIDS = 4
ROUNDS = 10
ROWS = 256
SLACK = 0.7
QUANTILE = 0.01
SMALL_CLUSTER = 0.02
# Lengths in characters at which a language's radius is measured; longer texts have that of the last one.
LENGTHS = (16, 32, 64, 128, 256, 512)
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# Letters of ASCII in lower case, bytes of other characters as they are, anything else a blank.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def counts(text: str) -> np.ndarray:
    """Hashed counts of byte pairs and triples of the whole text, blanks at both ends included."""
    data = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    pairs = data[:-1] * np.uint32(2654435761) ^ data[1:] * np.uint32(2246822519)
    triples = (pairs[:-1] ^ data[2:] * np.uint32(3266489917)) * np.uint32(668265263)
    pairs *= np.uint32(374761393)
    places = np.concatenate((pairs >> np.uint32(20), triples >> np.uint32(20)))
    return np.bincount(places, minlength=DIMS).astype(np.float32)


def vectors(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as TF-IDF vectors of length 1."""
    weighed = np.log1p(matrix) * idf
    return weighed / np.maximum(np.linalg.norm(weighed, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray  # per centroid and length, the similarity below which a text is too far

    def too_far(self, near: np.ndarray, centroid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether similarities to the nearest centroids are below their radius for texts of that many characters."""
        at = np.interp(np.log2(np.maximum(sizes, 1)), np.log2(LENGTHS), np.arange(len(LENGTHS)))
        low = at.astype(int)
        high, share = np.minimum(low + 1, len(LENGTHS) - 1), at - low
        return near < (1 - share) * self.least[centroid, low] + share * self.least[centroid, high]


def _clusters(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids of spherical k-means, begun at even ranks of similarity to the mean.

    Clusters of less than ``SMALL_CLUSTER`` of the points are odd texts, whose
    centroid would be near to anything odd, so they are left out.
    """
    ranks = np.argsort(points @ points.mean(axis=0), kind="stable")
    k = min(k, len(points))
    centroids = points[ranks[[(2 * i + 1) * len(points) // (2 * k) for i in range(k)]]]
    for _ in range(ROUNDS):
        of = np.argmax(points @ centroids.T, axis=1)
        sums = np.stack([points[of == c].sum(axis=0) if (of == c).any() else centroids[c] for c in range(k)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.bincount(np.argmax(points @ centroids.T, axis=1), minlength=k)
    return centroids[sizes >= min(SMALL_CLUSTER * len(points), sizes.max())]


def pieces(text: str) -> np.ndarray:
    """Counts of the middle of a text at each of ``LENGTHS``; of the whole text where it is shorter."""
    middles = [max(0, (len(text) - n) // 2) for n in LENGTHS]
    return np.stack([counts(text[m : m + n]) for m, n in zip(middles, LENGTHS, strict=True)])


def _radius(idf: np.ndarray, own: np.ndarray, cut: list[np.ndarray], slack: float) -> list[float]:
    """Per length, ``slack`` times the low quantile of the similarities that the language's own pieces have."""
    near = np.stack([(vectors(c, idf) @ own.T).max(axis=1) for c in cut])
    return (slack * np.quantile(near, QUANTILE, axis=0)).tolist()


def _count_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of texts and of their pieces, compressed, as most are 0."""
    schema = pa.schema([("lang", pa.string()), ("counts", pa.binary()), ("pieces", pa.binary())])
    for part in parts:
        rows = [(lang, zlib.compress(counts(text).tobytes(), 1), zlib.compress(pieces(text).astype(np.uint16).tobytes(), 1)) for lang, text in rows_of(part, "lang", "text")]
        yield batches({name: [r[k] for r in rows] for k, name in enumerate(schema.names)}, schema)


def _seen_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts have each of the counts; at ``DIMS``, the number of texts."""
    seen = np.zeros(DIMS + 1, np.int64)
    for part in parts:
        for (packed,) in rows_of(part, "counts"):
            seen += np.append(np.frombuffer(zlib.decompress(packed), np.float32) > 0, True)
    places = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(seen[places])], names=["place", "n"])


def _fit_rows(idf: np.ndarray, centroids: int, slack: float):
    def run(table: pa.Table) -> pa.Table:
        """Centroids and radii of one language."""
        sample = sorted((zlib.decompress(c), zlib.decompress(p)) for c, p in zip(table["counts"].to_pylist(), table["pieces"].to_pylist(), strict=True))
        own = _clusters(vectors(np.stack([np.frombuffer(c, np.float32) for c, _ in sample]), idf), centroids)
        least = _radius(idf, own, [np.frombuffer(p, np.uint16).reshape(-1, DIMS) for _, p in sample], slack)
        kinds = (pa.string(), pa.binary(), pa.list_(pa.float64()))
        values = (table["lang"][0].as_py(), own.tobytes(), least)
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["lang", "centroids", "least"])

    return run


def train(sample: DataFrame, centroids: int = CENTROIDS, slack: float = SLACK) -> Model | None:
    """Model of texts by their language, counts and counts of pieces; None without any.

    A text is rejected if its similarity to the nearest centroid is below the
    radius of that centroid's language for its length. The radius is ``slack``
    times a low quantile of the similarities that pieces of that length, cut from the
    sample, have to their own language: a few words are far from every centroid and
    still clean, while a long text of the language never is.

    Each language is fitted in a task. Only the numbers of texts that have each of
    the counts, and the centroids and radii, reach the driver.
    """
    seen = np.zeros(DIMS + 1, np.int64)
    for place, n in sample.select("counts").mapInArrow(_seen_rows, "place long, n long").groupBy("place").agg(F.sum("n")).collect():
        seen[place] = n
    if not seen[DIMS]:
        return None
    idf = (np.log((1 + seen[DIMS]) / (1 + seen[:DIMS])) + 1).astype(np.float32)
    fitted = sample.groupBy("lang").applyInArrow(_fit_rows(idf, centroids, slack), "lang string, centroids binary, least array<double>")
    found, languages, least = [], [], []
    for lang, packed, radii in sorted(fitted.collect()):
        own = np.frombuffer(packed, np.float32).reshape(-1, DIMS)
        found.append(own)
        languages += [lang] * len(own)
        least += [radii] * len(own)
    return Model(idf, np.concatenate(found), languages, np.array(least))


def learn(docs: DataFrame, lang: Column, text: Column, order: Column, per_language: int = SAMPLE_PER_LANGUAGE, **options) -> Model | None:
    """Fit on at most ``per_language`` texts of each language, the first by a hash of ``order``; whole texts with a letter count.

    The sample is chosen from language and order alone. A share of each language
    that holds about twice the sample is taken by the hash, so one task ranks
    no more than that.
    """
    keyed = docs.select(lang.alias("lang"), text.alias("text"), order.alias("_order")).where("lang IS NOT NULL AND text IS NOT NULL")
    drawn = keyed.select("lang", F.coalesce("_order", F.lit("")).alias("_order")).withColumn("_draw", F.crc32(F.concat(F.lit("draw"), F.col("_order")).cast("binary")))
    counts = drawn.groupBy("lang").agg(F.count("*").alias("_n"))
    few = F.col("_draw") * F.col("_n") < F.lit((2.0 * per_language + 100) * (1 << 32))
    # One row a language, so that nothing is shuffled by language before the share is taken.
    drawn = drawn.join(F.broadcast(counts), "lang").where(few).select("lang", "_order", "_draw").distinct()
    first = Window.partitionBy("lang").orderBy("_draw", "_order")
    chosen = drawn.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= per_language)
    keyed = keyed.withColumn("_order", F.coalesce("_order", F.lit("")))
    ids = F.broadcast(chosen.select("lang", "_order").distinct())
    rows = keyed.where(text_has_letter("text")).join(ids, ["lang", "_order"]).dropDuplicates(["lang", "_order"])
    sample = staged(rows.select("lang", "text").mapInArrow(_count_rows, "lang string, counts binary, pieces binary"))
    model = train(sample, **options)
    unstage(sample)
    return model


def text_has_letter(name: str) -> Column:
    return F.col(name).rlike(r"\p{L}")


def _predictions(model: Model | None, keep: list[str], text_col: str):
    def answer(texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        if model is None:
            return out
        for begin in range(0, len(texts), ROWS):
            there = [i for i in range(begin, min(begin + ROWS, len(texts))) if texts[i] is not None and _LETTER.search(texts[i])]
            if not there:
                continue
            near = vectors(np.stack([counts(texts[i]) for i in there]), model.idf) @ model.centroids.T
            best, top = near.argmax(axis=1), near.max(axis=1)
            far = model.too_far(top, best, np.array([len(texts[i]) for i in there]))
            for i, c, score, out_of_reach in zip(there, best.tolist(), top.tolist(), far.tolist(), strict=True):
                out[i] = (model.languages[c], min(1.0, max(0.0, score)), out_of_reach)
        return out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            answers = answer(texts_of(part, keep, text_col))
            columns = [pa.array([a[k] for a in answers], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("_doc")), *columns], names=["_doc", "_lang", "_score", "_rejected"])

    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` as struct ``_doc``, with ``_lang``, ``_score`` and ``_rejected``.

    ``_lang`` is the language of the nearest centroid by cosine (ties: the first
    language by name), ``_score`` that cosine. Null text and text without a letter are ``und`` with score 0;
    these, and texts farther from the centroid than its language's radius for
    their length, are rejected.
    Without a model all are ``und``. Whole texts are read; nothing is shuffled.
    Repeated rows are judged alike; an empty table gives no rows.
    """
    packed = with_text(docs, keep, text_col)
    schema = f"_doc {packed.schema['_doc'].dataType.simpleString()}, _lang string, _score double, _rejected boolean"
    return packed.mapInArrow(_predictions(model, keep, text_col), schema)


def drop_unknown(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Documents whose language is not rejected, with their columns as they are."""
    return predict(docs, model, docs.columns, text_col).where("NOT _rejected").select("_doc.*")
