import re
from collections import Counter

from cases import crc, documents, plain

from yearloom.llm import sharding


def test_law_slots_and_mixture(spark):
    docs = documents(spark)
    got = sharding.interleave(docs, 16).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    assert len(got) == len(texts)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    for r in got:
        text = texts[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, crc(text), "rows", None)
    mixture = Counter((texts[r.doc_id].source, r.shard) for r in got)
    for source, n in Counter(r.source for r in texts.values()).items():
        assert all(abs(mixture[source, s] - n / 16) < 2 for s in range(16))


def test_hot_source_keeps_its_share(spark):
    docs = spark.range(3_000).selectExpr(
        "id as doc_id", "'t' as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    got = sharding.interleave(docs, 8).join(docs, "doc_id").where("source = 'hot'").groupBy("shard").count().collect()
    assert {abs(r["count"] - 125) <= 1 for r in got} == {True}


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (2, "", "", 2), (None, "x", None, 3), (3, "é", "a", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    got = sharding.interleave(docs, 2)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    found = got.collect()
    assert sorted(Counter(r.shard for r in found).values()) == [2, 3]
    assert sorted((r.size, r.text_crc32) for r in found) == sorted(
        (len((t or "").encode()) + 1, crc(t or "")) for _, t, _, _ in rows)
    assert sharding.interleave(docs.limit(0), 4).collect() == []
    assert plain(got) == plain(sharding.interleave(docs.orderBy("size" if "size" in docs.columns else "text"), 2))


def test_plan_is_native(spark):
    plan = sharding.interleave(documents(spark), 16)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)
