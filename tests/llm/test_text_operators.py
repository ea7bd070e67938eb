"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash

from wayfuse.llm import bpe, class_lm, exact_dedup, html_text, line_dedup, mixing, passage_dedup, quality_classifier, queries, simhash_dedup, weak_rules

WHITE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = [say(120) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        for _ in range(r.choice([0, 0, 1, 2, 30])):
            words[r.randrange(len(words))] = r.choice(vocab)
        rows.append((i, " ".join(words), r.choice(["a", "b", None]), i))
    rows += [(100, None, "a", 1), (101, "", None, 1), (102, " \t\n ", "z", 1), (103, "one", "z", 1), (103, "one", "z", 1), (None, "o ne", "z", 1), (104, "A-B c\n\nA-B c\nÄ é 中文 #$ !!", "b", 1), (105, "x" * 150_000, "b", 1), (106, say(20_000), "b", 1), (107, "a " * 300, "b", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id bigint, text string, source string, size int").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


def key(v):
    return (v is None, v or 0)


def test_exact_groups(docs, empty):
    rows = corpus()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(WHITE.sub("", t or ""), []).append((-len(t or ""), key(i), i))
    found = exact_dedup.exact_groups(docs, digest_all=True).collect()
    assert len(found) == len(rows)
    for t, members in groups.items():
        digest = hashlib.sha256(t.encode()).digest()
        own = [r for r in found if bytes(r["digest"]) == digest]
        assert {r["group_size"] for r in own} == {len(members)}
        assert sum(r["kept"] for r in own) == 1
        assert {r["keep_id"] for r in own} == {min(members)[2]}
    kept = exact_dedup.drop_exact_duplicates(docs).collect()
    assert len(kept) == len(groups) and kept[0].asDict().keys() == {"doc_id", "text", "source", "size"}
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(nodes))]


def test_near_groups(docs, empty):
    rows = corpus()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    want = sorted((key(i), fps[n], min((rows[m][0] for m in range(len(rows)) if roots[m] == roots[n]), key=key)) for n, (i, *_) in enumerate(rows))
    found = simhash_dedup.near_groups(docs).collect()
    assert sorted((key(r["doc_id"]), r["fp"] % (1 << 64), r["component_id"]) for r in found) == want
    assert simhash_dedup.near_groups(empty).count() == 0
    with pytest.raises(ValueError):
        simhash_dedup.near_groups(docs, threshold=4)


def test_similar_groups(docs, empty):
    """Groups by fingerprints as brute force finds them."""
    rows = corpus()
    prints = [simhash_dedup.set_prints((t or "").encode()) for _, t, *_ in rows]
    half = lambda x, y: min(((x ^ y) & 0xFFFFFFFF).bit_count(), ((x ^ y) >> 32).bit_count())
    apart = lambda p, q: sum((x ^ y).bit_count() for x, y in zip(p, q, strict=True))
    linked = lambda p, q: apart(p[1], q[1]) <= 48 and any(half(x, y) <= 1 and (x ^ y).bit_count() <= 12 for x, y in zip(p[0], q[0], strict=True))
    roots = brute_components(prints, linked)
    kept = simhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = [min((key(rows[m][0]), m) for m in range(len(rows)) if roots[m] == k)[0] for k in set(roots)]
    assert sorted(key(r["doc_id"]) for r in kept.collect()) == sorted(want)
    assert simhash_dedup.drop_near_duplicates(empty).count() == 0


def test_similar_texts_are_found(spark):
    """Copies with words replaced, of 0.8 of their five-word shingles or more, are one group; texts on their own stay."""
    r = random.Random(21)
    vocab = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 9))) for _ in range(4000)]
    shingles = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    rows, similar = [], []
    for i in range(150):
        words = r.choices(vocab, [1 / (k + 5) for k in range(len(vocab))], k=r.randint(60, 400))
        rows.append((2 * i, " ".join(words)))
        copy = list(words)
        for at in r.sample(range(len(words)), max(1, len(words) // r.choice([60, 80, 150]))):
            copy[at] = r.choice(vocab)
        rows.append((2 * i + 1, " ".join(copy)))
        a, b = shingles(words), shingles(copy)
        similar.append(len(a & b) >= 0.8 * len(a | b))
    kept = {x["doc_id"] for x in simhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert kept >= {2 * i for i in range(150)}
    assert sum(similar) > 80 and sum(2 * i + 1 not in kept for i in range(150) if similar[i]) > 0.95 * sum(similar)


def test_anchors_cover():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 32, 300, dtype=np.uint32)
    x = np.concatenate([x, np.zeros(1, np.uint32)])
    index, anchor, home = simhash_dedup.anchors_of(x)
    assert (np.bitwise_count(anchor ^ x[index]) <= 2).all()
    homes = {int(i): int(a) for i, a, h in zip(index, anchor, home, strict=True) if h}
    for i, v in enumerate(x.tolist()):
        for b in range(33):
            near = np.array([v ^ (1 << b if b < 32 else 0)], np.uint32)
            assert homes[i] in simhash_dedup.anchors_of(near)[1].tolist()


def test_forest_keeps_components():
    r = np.random.default_rng(2)
    a = np.unique(r.integers(0, 1 << 9, 120, dtype=np.uint64) << np.uint64(3))
    x, y = (a[i] for i in simhash_dedup.forest([a], [a], [3]))
    parent = {int(v): int(v) for v in a}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for p, q in zip(x.tolist(), y.tolist(), strict=True):
        parent[max(root(p), root(q))] = min(root(p), root(q))
    want = brute_components(a.tolist(), lambda p, q: (p ^ q).bit_count() <= 3)
    got = [root(v) for v in a.tolist()]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_bpe_matches_library_and_round_trips(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.vocabulary())
    coded = bpe.encode(docs, queries.vocabulary())
    assert coded.columns == ["doc_id", "text", "source", "size", "ids"]
    for r in bpe.decode(coded, queries.vocabulary()).collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    letters = [*"ab 'sd\n\t\r\x0b\x1c\x85\xa0é中1²😀!_", "<|endoftext|>", "'re", "aaaa", "   "]
    r = random.Random(5)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    vocab = bpe.Vocabulary(bpe.read_vocabulary(spark, queries.vocabulary()))
    for text, own in zip(texts, vocab.encode(texts, {}), strict=True):
        assert np.frombuffer(own, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def level(sizes, weights):
    target, rest, free = {}, float(sum(sizes.values())), dict(weights)
    while True:
        share = {s: rest * w / sum(free.values()) for s, w in free.items()} if free else {}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
            free.pop(s)


def test_mix(docs, empty):
    rows = corpus()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = level(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    placed, takes = mixing.mix(docs, block=64)
    found = mixing.taken_words(placed, takes).collect()
    assert len(found) == len(rows)
    assert sorted((key(r["doc_id"]), r["size"]) for r in found) == sorted((key(i), len(WORD.findall(t or ""))) for i, t, *_ in rows)
    taken = {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        taken.setdefault((r["source_size"], round(r["target"], 6)), 0)
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s in sizes:
        assert abs(taken[sizes[s], round(want[s], 6)] - want[s]) <= 1
    again = mixing.taken_words(*mixing.mix(docs.repartition(5), block=64)).collect()
    assert sorted((key(r["doc_id"]), r["taken"]) for r in found) == sorted((key(r["doc_id"]), r["taken"]) for r in again)
    slots = sorted({r["slot"] for r in takes.collect()})
    assert len(slots) > 100
    assert set(mixing.apply_mix(docs).columns) == set(docs.columns)
    assert mixing.taken_words(*mixing.mix(empty)).count() == 0


def test_quality_classifier(spark, docs, empty):
    r = random.Random(3)
    good = [(i, " ".join("".join(r.choice("abcde") for _ in range(5)) for _ in range(60)) + ".", "s", 0) for i in range(300)]
    bad = [(1000 + i, "BUY!! " * r.randint(5, 40), "s", 0) for i in range(300)]
    table = spark.createDataFrame(good + bad, docs.schema)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, *_ in good[:200] + bad[:200]] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    model = quality_classifier.train(table, labels)
    scored = {x["doc_id"]: x["score"] for x in quality_classifier.with_score(table, model).collect()}
    assert all((scored[i] >= 0.5) == (i < 1000) for i in scored)
    for x in quality_classifier.with_score(docs, model).collect():
        assert 0 <= x["score"] <= 1
    x = np.random.default_rng(0).random((400, 2))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    fitted = quality_classifier.fit(x, y, ["p", "q"])
    raw = fitted.intercept + sum(w * rule.holds(["p", "q"], x) for rule, w in fitted.weights)
    assert ((raw > 0) == (y == 1)).mean() > 0.97
    clash = table.withColumnsRenamed({"size": "__id", "source": "score__stats"}).withColumn("__y", quality_classifier.F.lit(1))
    assert quality_classifier.train(clash, labels) == model
    assert {x["doc_id"]: x["score"] for x in quality_classifier.with_score(clash, model).collect()} == scored
    stats = quality_classifier.statistics("text")
    names = list(stats)
    values = np.array([list(x) for x in table.select(*[c.cast("double").alias(n) for n, c in stats.items()], "doc_id").orderBy("doc_id").drop("doc_id").collect()])
    raw = model.intercept + sum(w * rule.holds(names, values) for rule, w in model.weights)
    assert np.allclose([scored[i] for i in sorted(scored)], 1 / (1 + np.exp(-raw)))
    none = quality_classifier.train(docs, labels.limit(0))
    assert {v["score"] for v in quality_classifier.with_score(docs, none).collect()} == {0.5}
    assert quality_classifier.with_score(empty, none).count() == 0


def brute_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    some = [x for x in lines if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(some) - len(set(some)), len(hit)


def test_weak_rules(docs, empty):
    names = weak_rules.COUNTS[:5]
    found = weak_rules.judge(docs).collect()
    assert sorted((key(r["doc_id"]), *[r[c] for c in names]) for r in found) == sorted((key(i), *brute_counts(t)) for i, t, *_ in corpus())
    for r in found:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert weak_rules.judge(empty).count() == 0


@pytest.mark.parametrize("share", [0.3, 0.7])
def test_weak_rules_find_accuracies(share):
    """As production calls it: planted accuracies come out, and the posterior is no all-must-pass filter."""
    r = np.random.default_rng(4)
    truth, on_good, on_bad = r.random(200_000) < share, np.array([0.95, 0.9, 0.9, 0.65, 0.8]), np.array([0.9, 0.95, 0.85, 0.6, 0.4])
    right = r.random((len(truth), 5)) < np.where(truth[:, None], on_good, on_bad)
    votes = np.where(right == truth[:, None], 1, -1)
    votes[r.random(votes.shape) < 0.4] = 0
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, found_good, found_bad = weak_rules.fit(patterns, counts.astype(float))
    assert abs(good - share) < 0.02 and np.abs(found_good - on_good).max() < 0.03 and np.abs(found_bad - on_bad).max() < 0.03
    kept = (np.log(good / (1 - good)) + weak_rules.log_odds(patterns, found_good, found_bad) >= 0)[place.ravel()]
    passes = (votes >= 0).all(axis=1)
    assert (kept & ~passes).sum() > 1000 and (kept == truth).mean() > (passes == truth).mean() + 0.03
    assert share > 0.5 or (~kept & passes).sum() > 1000


def test_weak_rules_keep_texts_that_one_poor_rule_is_against(spark):
    r = random.Random(13)
    say = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7))) for _ in range(n))
    rows = [(i, ".\n".join(say(8) for _ in range(6)) + ".") for i in range(300)] + [(1000 + i, "\n".join(say(8) for _ in range(6))) for i in range(12)]
    rows += [(2000 + i, " ".join(w + "$$$" for w in say(60).split())) for i in range(30)] + [(3000 + i, say(30).replace(" ", " | ")) for i in range(30)]
    found = {x["doc_id"]: x["kept"] for x in weak_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i for i, k in found.items() if k} == {i for i, _ in rows if i < 2000}  # lines without ends are a bad vote


@pytest.mark.parametrize("looked_up", [5, 100_000])
def test_class_model(docs, empty, looked_up):
    rows = corpus()
    half = docs.where("doc_id % 2 = 0 or doc_id is null")
    train = [t for i, t, *_ in rows if i is None or i % 2 == 0]
    counts = {}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: [*WORD.findall(lower(t)), None]
    for t in train:
        for w in tokens(t):
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    model, words = class_lm.train(half, clustered=50, classes=6, looked_up=looked_up)
    assert (model.size, model.distinct) == (n, v)
    found = class_lm.score(docs, model, words).collect()
    want = sorted((key(i), len(tokens(t)), sum(w in counts for w in tokens(t)), sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t, *_ in rows)
    got = sorted((key(r["doc_id"]), r["n_tokens"], r["n_known"], r["base_score"]) for r in found)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in found)
    for row in range(len(model.next)):
        assert abs((10 ** model.next[row]).sum() - 1) < 1e-9
    hashed = {x["hash"] % (1 << 64): x["class"] for x in words.collect()}
    place = lambda w: model.index.get(class_lm.END if w is None else class_lm.key_of(w.encode()), -1)
    class_of = lambda w: int(model.class_of[place(w)]) if place(w) >= 0 else hashed.get(xxhash.xxh64_intdigest(w.encode(), 42), model.classes)
    assert all(class_of(w) < model.classes for w in counts if w)
    between, mass = np.zeros((8, 8)), np.zeros(8)
    for t in train:
        own = [class_of(w) for w in [None, *tokens(t)]]
        np.add.at(between, (own[:-1], own[1:]), 1)
    for w, c in counts.items():
        mass[class_of(w)] += c + 0.1
    assert np.allclose(10**model.next, (between + 0.1) / (between.sum(axis=1, keepdims=True) + 0.8)) and np.allclose(model.mass, mass + 0.1)
    scores = {}
    for i, t, *_ in rows:
        own = [class_of(w) for w in [None, *tokens(t)]]
        s = sum(model.next[a, b] + np.log10((counts.get(w, 0) + 0.1) / model.mass[b]) for a, b, w in zip(own[:-1], own[1:], tokens(t), strict=True))
        scores.setdefault(i, []).append(s)
    for r in found:
        assert any(abs(r["score"] - s) < 1e-6 * abs(s) for s in scores[r["doc_id"]])
    again, both = class_lm.train_and_score(docs, ~class_lm.F.coalesce(class_lm.F.expr("doc_id % 2 = 0"), class_lm.F.lit(True)))
    assert again.size == n and sorted(key(r["doc_id"]) for r in both.collect()) == sorted(key(i) for i, *_ in rows)
    blank, none = class_lm.train(empty)
    assert all(np.isfinite(r["score"]) for r in class_lm.score(docs, blank, none).collect())
    assert class_lm.score(empty, model, words).count() == 0


def test_exchange_finds_planted_classes():
    r = np.random.default_rng(6)
    own = np.arange(40) % 4
    pairs = r.poisson(np.where((own[:, None] + 1) % 4 == own[None, :], 50, 1)).astype(float)
    found = class_lm.exchange(pairs, np.array([], np.int64), 4, sweeps=20)
    assert all(len(set(found[own == c])) == 1 for c in range(4))


@pytest.mark.parametrize("looked_up", [30, 100_000])
def test_all_words_have_planted_classes(spark, looked_up):
    """Words of one length in two kinds that take turns: only clustering of every word tells a right order from a wrong one."""
    r = random.Random(12)
    kinds = [[f"{k}{i:04d}" for i in range(150)] for k in "ab"]
    say = lambda first, n: " ".join(r.choices(kinds[(first + i) % 2], [40] * 10 + [1] * 140)[0] for i in range(n))
    frame = spark.createDataFrame([(i, say(0, 40)) for i in range(500)], "doc_id bigint, text string").repartition(3)
    model, others = class_lm.train(frame, clustered=20, classes=2, looked_up=looked_up)
    own = {w.decode(): int(model.class_of[i]) for w, i in model.index.items() if w != class_lm.END}
    hashed = {x["hash"]: x["class"] for x in others.collect()}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    own |= {w: hashed[signed(xxhash.xxh64_intdigest(w, 42))] for k in kinds for w in k if w not in own}
    assert len(own) == 300 and (looked_up > 300) == (not hashed)
    assert {len({own[w] for w in k}) for k in kinds} == {1} and own["a0000"] != own["b0000"]
    words = say(0, 30).split()
    tests = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(words[::2] + words[1::2]))], "doc_id bigint, text string")
    found = {x["doc_id"]: x for x in class_lm.score(tests, model, others).collect()}
    assert found[0]["score"] > found[1]["score"] + 10 and abs(found[0]["base_score"] - found[1]["base_score"]) < 1e-9


def brute_removed(rows):
    order = sorted(range(len(rows)), key=lambda n: (key(rows[n][0]), n))
    seen, out = set(), {}
    for n in order:
        t = (rows[n][1] or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            else:
                seen.add(t[p : p + 100])
        out[n] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(t, gone, strict=True) if not g))
    return [(key(rows[n][0]), *out[n]) for n in order]


@pytest.mark.parametrize("unique", [True, False])
def test_passages(docs, empty, unique):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 103] if unique else corpus()
    part = docs.where("doc_id is not null and doc_id <> 103") if unique else docs
    found = passage_dedup.remove_repeats(part, crowd=2 if unique else 1000).collect()
    assert sorted((key(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == sorted(brute_removed(rows))
    assert passage_dedup.remove_repeats(empty).count() == 0


def test_suffix_array_runs():
    r = random.Random(17)
    for width in (100, 20):
        data = bytes(r.choice(b"ab") for _ in range(300)) * 2 + bytes(r.choice(b"ab") for _ in range(500))
        at = np.arange(len(data) - width + 1)
        where, run = passage_dedup.suffix_array(np.frombuffer(data, np.uint8), at, width)
        found = [data[p : p + width] for p in where.tolist()]
        assert found == sorted(found) and [a == b for a, b in zip(run[1:], run, strict=False)] == [a == b for a, b in zip(found[1:], found, strict=False)]
        assert sorted(where.tolist()) == [p for p in at.tolist() if data.find(data[p : p + width], p + 1) >= 0 or data.find(data[p : p + width]) < p]


def test_passages_with_many_neighbours(spark):
    """A passage between different words, texts of one period, and texts that are parsed in pieces."""
    r = random.Random(18)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    common = [say(300), say(130), say(100)]
    rows = [(i, say(r.randint(0, 200)) + r.choice(common) + say(r.randint(0, 200)) + r.choice(common)[: r.randint(50, 300)] + say(40)) for i in range(80)]
    rows += [(100, "ab" * 300), (101, "b" + "ab" * 200), (102, "x" * 99), (103, "x" * 100), (104, "x" * 150)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for crowd, piece in ((1000, 1 << 20), (3, 1 << 20), (1000, 64)):
        found = passage_dedup.remove_repeats(table, crowd=crowd, piece=piece).collect()
        assert sorted((key(x["doc_id"]), x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in found) == sorted(brute_removed(rows))


def brute_edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


@pytest.mark.parametrize("block", [512, 3])
def test_line_links(spark, block):
    r = random.Random(8)
    base = ["".join(r.choice("abc d") for _ in range(r.randint(40, 60))).strip() for _ in range(8)]
    lines = set(base)
    for _ in range(80):
        x = list(r.choice(base))
        for _ in range(r.randint(0, 5)):
            at = r.randrange(len(x))
            r.choice([lambda: x.insert(at, "z"), lambda: x.pop(at), lambda: x.__setitem__(at, "y")])()  # noqa: B023
        lines.add("".join(x).strip())
    nodes = {xxhash.xxh64_intdigest(x, 42): x for x in lines}
    signed = {h - (1 << 64) if h >> 63 else h: x for h, x in nodes.items()}
    texts = sorted(lines) * 2
    r.shuffle(texts)
    table = spark.createDataFrame([("\n".join(texts[i : i + 7]),) for i in range(0, len(texts), 7)] + [(None,)], "text string").repartition(3)
    found = {(x["a"], x["b"]) for x in line_dedup.edit_links(table, block=block).collect()}
    keys = sorted(signed)
    assert found == {(a, b) for n, a in enumerate(keys) for b in keys[n + 1 :] if brute_edits(signed[a], signed[b]) <= line_dedup.MAX_EDITS}
    assert len(found) > 20


@pytest.mark.parametrize("block", [512, 3])
def test_short_line_links(spark, block):
    r = random.Random(10)
    lines = {"".join(r.choice("abcé") for _ in range(r.choice([1, 2, 3, 4, 5, 7, 12, 20, 39]))) for _ in range(120)} | {"Antion ered.", "Retion ered.", "x", "yz"}
    signed = {h - (1 << 64) if h >> 63 else h: x for x in lines for h in [xxhash.xxh64_intdigest(x, 42)]}
    table = spark.createDataFrame([(x,) for x in sorted(lines)], "text string").repartition(3)
    found = {(x["a"], x["b"]) for x in line_dedup.edit_links(table, block=block).collect()}
    keys = sorted(signed)
    want = {(a, b) for n, a in enumerate(keys) for b in keys[n + 1 :] if brute_edits(signed[a], signed[b]) <= line_dedup.MAX_EDITS}
    assert found == want
    roots = dict(zip(keys, brute_components(keys, lambda x, y: (min(x, y), max(x, y)) in want), strict=True))
    seen = line_dedup.dedup_lines(table.selectExpr("1 as doc_id", "text"), block=block).collect()
    many = Counter(x for pair in want for x in pair)
    assert {x["line_id"]: (x["class_id"], x["n_links"]) for x in seen} == {k: (keys[roots[k]], many[k]) for k in keys}
    assert sum(not x["duplicate"] for x in seen) == len(set(roots.values()))


def test_edit_distance():
    r = random.Random(9)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 14)))
        b = "".join(r.choice("ab") for _ in range(r.randint(0, 14)))
        assert line_dedup.edit_distance(a, b, 3) == min(4, brute_edits(a, b))


def test_line_fates(spark, empty):
    long = "the quick brown fox jumps over the lazy dog again"
    rows = [(2, f"{long}\nshort\n\n{long}!"), (1, f" {long[:-1]} \nshort"), (3, None), (4, "\n \n"), (None, "short\nother")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["line_no"]): (r["duplicate"], r["n_links"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1, 0] == (False, 2) and found[1, 1] == (False, 0)
    assert found[2, 0] == (True, 2) and found[2, 1] == (True, 0) and found[2, 2] == (False, 0) and found[2, 3] == (True, 2)
    assert found[None, 0] == (True, 0) and found[None, 1] == (False, 0)
    texts = {r["doc_id"]: r["text"] for r in line_dedup.drop_duplicate_lines(docs).collect()}
    assert texts == {1: rows[1][1], 2: "", 3: None, 4: "\n \n", None: "other"}
    per = {r["doc_id"]: (r["n_lines"], r["n_duplicates"]) for r in line_dedup.per_document(line_dedup.dedup_lines(docs)).collect()}
    assert per == {1: (2, 0), 2: (3, 3), 3: (0, 0), 4: (0, 0), None: (2, 1)}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_classes(spark, empty):
    a, b, c = "a line that others are near to", "a line that others are near 2", "a lone that ethers are near 2"
    rows = [(1, f"{a}\nquite another line"), (2, f"\n{b}\n{a}"), (3, c), (4, None), (None, "\n ")]
    found = line_dedup.per_document(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)))
    found = {r["doc_id"]: [tuple(x) for x in r["lines"]] for r in found.collect()}
    signed = lambda x: int(np.uint64(xxhash.xxh64_intdigest(x, 42)).astype(np.int64))
    assert brute_edits(a, b) == brute_edits(b, c) == 2 and brute_edits(a, c) == 4
    other, least = signed("quite another line"), min(map(signed, (a, b, c)))
    assert found[1] == [(0, signed(a), least, 1), (1, other, other, 0)]
    assert found[2] == [(1, signed(b), least, 2), (2, signed(a), least, 1)]
    assert found[3] == [(0, signed(c), least, 1)] and found[4] == found[None] == []
    assert line_dedup.per_document(line_dedup.dedup_lines(empty)).count() == 0


def test_html(spark):
    article = "<article><h1>Ti &amp; tle</h1><p><b>Body  text\n here<br><p>more</article>"
    menu = "<div class=x><ul><li><a href=/a>Go there</a></ul></div>"
    pages = [(i, "http://h.example/p", f"<html><nav>n</nav>{article}<footer>f</footer>") for i in range(3)]
    pages += [(10 + i, "http://plain.example/", f"<body>{menu}<div><p>only {i}</p></div>") for i in range(5)]
    pages += [(20, "http://one.example/", f"<body>{menu}<p>kept &lt;b&gt;"), (30, None, None), (31, "x", ""), (32, "x", "<p>a<script>var t='</p>'</script><!-- c <p>d"), (33, "x", "<main><p>m</p><div class='comments'><p>c</p></div><form>q</form></main>")]
    table = spark.createDataFrame([(*p, "clash") for p in pages], "page_id bigint, url string, html string, text string")
    found = {r["page_id"]: r["text"] for r in html_text.extract(table).collect()}
    assert {found[i] for i in range(3)} == {"Ti & tle\nBody text here\nmore"}
    assert [found[10 + i] for i in range(5)] == [f"only {i}" for i in range(5)]
    assert found[20] == "Go there\nkept <b>"
    assert found[30] == "" and found[31] == "" and found[32] == "a" and found[33] == "m"
    assert html_text.extract(table.limit(0)).count() == 0


def brute_pages(rows):
    """What read() finds, counted and removed by plain loops."""
    seen, sizes, out = {}, {}, {}
    reads = {i: (re.match(r"\w+://([^/?#]*)", u or "").group(1).lower() if re.match(r"\w+://([^/?#]*)", u or "") else "", html_text.read(h)) for i, u, h in rows}
    for host, (_, _, _, every) in reads.values():
        for value, content, shell in every or [(None, 0, False)]:
            seen.setdefault((host, value, shell), set()).add(content)
    for (host, value, _), contents in seen.items():
        if value is None:
            sizes[host] = len(contents)
    for i, (host, (blocks, around, inside, _)) in reads.items():
        n, many = sizes[host], lambda v, s: len(seen.get((host, v, s), ()))  # noqa: B023
        named = lambda v: many(v, True) and (not host or n < 3 or many(v, True) >= max(2, 0.01 * n) or sum(h != "" and w == v and s for h, w, s in seen) >= 3)  # noqa: B023
        kept = [k for k, a in enumerate(around) if not any(named(v) or (host and many(v, False) >= max(min(5, max(n, 3)), 0.01 * n)) for v in set(a))]
        out[i] = "\n".join(html_text.main_blocks([blocks[k] for k in kept], [inside[k] for k in kept]))
    return out


@pytest.mark.parametrize("marked", [True, False])
def test_html_against_brute_force(spark, marked):
    """The test pages as they are, and without the marks of their articles, where recurrence has to tell the template."""
    pages = spark.read.parquet(f"/root/testdata/{'sf0.01' if marked else 'sf0.1'}/pages.parquet")
    if not marked:
        html = html_text.F.regexp_replace(html_text.F.regexp_replace("html", "<(/?)(article|nav|footer)", "<$1div"), 'class="ad"', "")
        pages = pages.withColumn("html", html)
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    found = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert {i: r["text"] for i, r in found.items()} == brute_pages(rows)
    if marked:
        article = lambda h: re.search("<article>(.*)</article>", h, re.S)[1]
        plain = lambda h: re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", html_text.entities.unescape(re.sub(r"</?(b|a|i|em)\b[^>]*>", "", h)))).strip()
        assert sum(found[i]["text"].replace("\n", " ") == plain(article(h)) for i, _, h in rows if h and "</article>" in h) > 0.9 * len(rows)
    assert sum(r["n_template_blocks"] for r in found.values()) >= (len(rows) if marked else 2000)


def test_html_hints():
    for name in ("ad", "ad-slot", "main-nav", "related-posts", "comments_area", "x cookie-consent", "Sidebar2", "site-header"):
        assert html_text.hint(name)
    for name in ("share-price", "search-results", "menu-planning", "article-header", "gradient", "header-image", "notice-of-death"):
        assert not html_text.hint(name)
    assert not html_text.hint("header", in_article=True)


def test_html_hints_do_not_decide(spark):
    """Telling names count where the site repeats them; forms around a page, teasers and broken markup don't hide it."""
    article = '<article><p>Intro</p><div class="share-price"><p>The price rose.</p></div><section id="search-results"><p>Found.</p></section></article>'
    rows = [(0, "http://a.example/", article), (1, "http://b.example/", "<form><article><p>Main text.</p></article><button>x</button></form>")]
    rows += [(2, "http://c.example/", "<div><article><p>Teaser</p></article></div><div><p>" + "The main text of the page. " * 4 + "</p></div>")]
    rows += [(3, "http://d.example/", "<form><p>Sign up</p></form><p>A text that is longer</p>")]
    rows += [(10 + i, "http://e.example/", f"<main><p>Text {i}</p><div class='comments'><p>I say {i}</p></div>{'<div class=widget><p>Once</p></div>' if not i else ''}</main>") for i in range(6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[0] == "Intro\nThe price rose.\nFound." and found[1] == "Main text."
    assert found[2] == "Teaser\n" + ("The main text of the page. " * 4).strip() and found[3] == "A text that is longer"
    assert [found[10 + i] for i in range(6)] == ["Text 0\nOnce", *(f"Text {i}" for i in range(1, 6))]


@pytest.mark.parametrize("piece", ["<a '", '<a href="', "<a b='x", "<div>", "<h1>", "<li>", "<!--", "<", "<p class=ad>", "<script>"])
def test_html_time_grows_with_the_page(piece):
    began = time.process_time()
    html_text.read(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 10


def test_html_templates_in_articles(spark):
    note = "<div class=x><p>Read our terms of use before you go on.</p></div>"
    rows = [(i, "http://a.example/p", f"<main><h1>Title {i}</h1><div><p>Text number {i}</p></div>{note}</main>") for i in range(6)]
    rows += [(10 + i, "http://b.example/p", f"<nav>{i}</nav><article><p>One article</p><p>on many pages</p></article>") for i in range(6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    assert [found[i] for i in range(6)] == [f"Title {i}\nText number {i}" for i in range(6)]
    assert {found[10 + i] for i in range(6)} == {"One article\non many pages"}


def test_html_templates_are_a_share_of_different_pages(spark):
    menu = "<div><p>Go there or elsewhere</p></div>"
    rows = [(i, "http://copies.example/p", "<body><div><p>The whole text</p></div>") for i in range(6)]
    rows += [(10 + i, "http://small.example/p", f"<body>{menu}<p>Page {i}</p>") for i in range(4)]
    rows += [(20 + i, "http://syndicated.example/p", f"<nav>{i}</nav><main><section>Side {i}</section><article><div>One article</div></article></main>") for i in range(6)]
    quote = "<div>A quote</div>"
    rows += [(1000 + i, "http://large.example/p", f"<body>{menu}<p>Page {i}</p>{quote if i < 6 else ''}") for i in range(700)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    assert {found[i] for i in range(6)} == {"The whole text"}
    assert [found[10 + i] for i in range(4)] == [f"Page {i}" for i in range(4)]
    assert [found[20 + i] for i in range(6)] == [f"Side {i}\nOne article" for i in range(6)]
    assert [found[1000 + i] for i in range(700)] == [f"Page {i}" + "\nA quote" * (i < 6) for i in range(700)]
