import zlib
from collections import Counter, defaultdict

from siteledger.llm.sharding import interleave


def check(rows, n_rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert sum(counts.values()) == n_rows
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_match_the_mixture(corpus, texts):
    rows = interleave(corpus).collect()
    check(rows, len(texts), 16)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    mix = Counter(r["source"] for r in rows)
    for source, n in mix.items():
        per = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(per[s] - n / 16) <= 1 for s in range(16))


def test_hot_source_nulls_repeats_and_few_rows(frame, spark):
    rows = interleave(frame([(i % 50, None if i % 7 == 0 else "t" * i) for i in range(500)]), shards=7).collect()
    check(rows, 500, 7)
    docs = spark.createDataFrame([(1, "a", None), (None, "b", None), (None, None, "x"), (1, "a", None)], "doc_id long, text string, source string")
    check(interleave(docs).collect(), 4, 16)
    assert interleave(docs.where("false")).count() == 0


def test_same_seed_same_deal(corpus):
    one, two = (sorted(map(tuple, interleave(corpus, seed="a").collect())) for _ in range(2))
    assert one == two != sorted(map(tuple, interleave(corpus, seed="b").collect()))
