"""The pipeline stage by stage on a small table."""

import random
import re
import zlib

import tokenizers

import corpus_pipeline
from wayfuse.llm import quality_classifier, queries, simhash_dedup
from wayfuse.llm.common import in_fold


def test_stages(spark, tmp_path):
    r = random.Random(1)
    say = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(2, 8))) for _ in range(n))
    texts = [say(80) + "." for _ in range(120)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(200 + i, t, "en", "s0", len(t)) for i, t in enumerate(texts[:20])]
    near = [t[:-12] + "zz." for t in texts[20:40]]
    rows += [(300 + i, t, "en", "s1", len(t)) for i, t in enumerate(near)]
    rows += [(400 + i, "SPAM!! " * 30, "en", None, 210) for i in range(60)] + [(500, None, None, None, None), (501, "", "en", "s2", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(not 400 <= i < 500), 0) for i, *_ in rows], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        now = spark.read.parquet(str(tmp_path / f"s{k}"))
        seen[name] = [x["doc_id"] for x in now.select("doc_id").collect()]
        if name != "encode":
            assert now.schema == docs.schema
    assert set(range(120)) <= set(seen["quality"]) and not set(range(400, 460)) & set(seen["quality"])
    assert not set(range(200, 220)) & set(seen["exact"]) and set(range(120)) <= set(seen["exact"])
    assert len(seen["exact"]) == len(set(seen["exact"]))
    assert set(seen["near"]) <= set(seen["exact"]) and set(range(120)) <= set(seen["near"]) and len(set(range(300, 320)) & set(seen["near"])) <= 2
    assert set(seen["mix"]) <= set(seen["near"]) and len(seen["encode"]) == len(seen["mix"])
    # Each stage against plain loops over what the one before kept.
    texts_of = lambda k: {x["doc_id"]: x["text"] or "" for x in spark.read.parquet(str(tmp_path / k)).collect()}
    taught = {x["doc_id"]: x["quality"] for x in labels.collect() if zlib.crc32(str(x["doc_id"]).encode()) % 5}
    model = quality_classifier.train(docs, labels.where(~in_fold(5)))
    scores = {x["doc_id"]: x["score"] for x in quality_classifier.with_score(docs, model).collect()}
    assert len(taught) < len(rows) and sorted(seen["quality"]) == sorted(i for i, x in scores.items() if x >= 0.3)
    first: dict = {}
    for i, t in texts_of("s0").items():
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        first[body] = min(first.get(body, (0, 1 << 60)), (-len(t), i))
    assert sorted(seen["exact"]) == sorted(i for _, i in first.values())
    prints = {i: simhash_dedup.set_prints(t.encode()) for i, t in texts_of("s1").items()}
    halves = lambda x, y: min(((x ^ y) & 0xFFFFFFFF).bit_count(), ((x ^ y) >> 32).bit_count())
    apart = lambda p, q: sum((x ^ y).bit_count() for x, y in zip(p, q, strict=True))
    linked = lambda p, q: apart(p[1], q[1]) <= 48 and any(halves(x, y) <= 1 and (x ^ y).bit_count() <= 12 for x, y in zip(p[0], q[0], strict=True))
    group = {i: i for i in prints}
    for i in sorted(prints):
        for j in sorted(prints):
            if j < i and linked(prints[i], prints[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert sorted(seen["near"]) == sorted({min(k for k, g in group.items() if g == own) for own in set(group.values())})
    library = tokenizers.Tokenizer.from_file(queries.vocabulary())
    mixed = texts_of("s3")
    for x in now.collect():
        assert x["ids"] == library.encode(mixed[x["doc_id"]], add_special_tokens=False).ids and x["n_tokens"] == len(x["ids"])
    sizes = {x["doc_id"]: (x["source"], len((x["text"] or "").split())) for x in spark.read.parquet(str(tmp_path / "s2")).collect()}
    total = {s: sum(n for t, n in sizes.values() if t == s) for s in {s for s, _ in sizes.values()}}
    taken = {s: sum(sizes[i][1] for i in seen["mix"] if sizes[i][0] == s) for s in total}
    share = {s: w * sum(total.values()) / 6 for s, w in (("s0", 1), ("s1", 2), ("s2", 3))}
    assert all(abs(taken[s] - share[s]) < 0.15 * share[s] for s in share if share[s] <= 3 * total[s])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(x["doc_id"] for x in whole.select("doc_id").collect()) == sorted(seen["encode"])


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op7_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right, total = found.selectExpr("count_if(predicted = quality)", "count(*)").first()
    assert right / total > 0.9
    assert quality_classifier.THRESHOLD == 0.3 and in_fold(5) is not None
