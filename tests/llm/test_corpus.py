"""Operators 2, 4, 5, 6, 7 and 8 against brute force and on edge cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from promptwatt.llm import decontaminate, mixing, quality_classifier, simhash_dedup, suffix_tree, token_file
from promptwatt.llm.common import fresh_path

from .edge import TEXTS, edge_docs, empty_docs

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)


def with_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    return docs.unionByName(edge_docs(spark).filter("doc_id is not null").selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source"))


def test_lm_base_scores_match_brute_force(spark):
    docs = with_edges(spark)
    rows = [(r.doc_id, [*split(lower(r.text)), ""]) for r in docs.collect()]
    c = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(t)
    n, v = sum(c.values()), len(c)
    want = {i: (len(t), sum(c[w] > 0 for w in t), sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for i, t in rows}
    out = suffix_tree.score(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        tokens, known, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0


def test_lm_base_scores_do_not_depend_on_the_number_of_hot_words(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: r for r in suffix_tree.score(docs).collect()}
    monkeypatch.setattr(suffix_tree, "HOT_WORDS", 20)
    for r in suffix_tree.score(docs).collect():
        assert r.n_known == want[r.doc_id].n_known and r.base_score == pytest.approx(want[r.doc_id].base_score, abs=1e-6)


def test_suffix_tree_distributions_sum_to_one_and_match_a_plain_tree(spark):
    texts = ["abracadabra abra cadabra " * 30, "the cat sat on the mat " * 20, "x", ""]
    training = spark.createDataFrame([(t,) for t in texts], "text string")
    _, grams = suffix_tree.counts(training)
    model = suffix_tree.tree(grams)
    seqs = [b"\n" * suffix_tree.DEPTH + b" ".join(t.encode().split()) + b"\n" for t in texts]
    n = collections.Counter(s[k - d:k + 1] for s in seqs for k in range(suffix_tree.DEPTH, len(s)) for d in range(suffix_tree.DEPTH + 1))
    total = sum(c for g, c in n.items() if len(g) == 1)
    after = collections.defaultdict(dict)
    for g, c in n.items():
        after[g[:-1]][g[-1:]] = c

    def p(context, byte):
        if not context:
            return (n.get(byte, 0) + 0.5) / (total + 128)
        up = p(context[1:], byte)
        own = after.get(context)
        return up if own is None else (own.get(byte, 0) + len(own) * up) / (sum(own.values()) + len(own))

    kept = {b""}
    for context, own in after.items():
        if context:
            size = sum(own.values())
            gain = sum(c * math.log(c / size / p(context[1:], a)) for a, c in own.items())
            if gain > len(own) / 2 * math.log(total + 1):
                kept |= {context[k:] for k in range(len(context) + 1)}
    for context in (b"\n\n\n\n\n", b"n the", b"cadab", b"zzzzz", b"xx  a"):
        code = np.array([int.from_bytes(context, "big") << 8 | a for a in range(256)], np.uint64)
        got = 10 ** suffix_tree.log_probs(model, code)
        state = next(context[k:] for k in range(len(context) + 1) if context[k:] in kept)
        assert got.sum() == pytest.approx(1) and got == pytest.approx([p(state, bytes([a])) for a in range(256)])


def test_suffix_tree_keeps_every_context_that_diverges(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "MAX_STATES", 3, raising=False)  # a cap on contexts, if there is one
    texts = ["abracadabra abra cadabra " * 30, "the cat sat on the mat " * 20]
    model = suffix_tree.tree(suffix_tree.counts(spark.createDataFrame([(t,) for t in texts], "text string"))[1])
    n = collections.Counter(s[k - d:k + 1] for t in texts for s in [b"\n" * suffix_tree.DEPTH + b" ".join(t.encode().split()) + b"\n"]
                            for k in range(suffix_tree.DEPTH, len(s)) for d in range(suffix_tree.DEPTH + 1))
    total, after = sum(c for g, c in n.items() if len(g) == 1), collections.defaultdict(dict)
    for g, c in n.items():
        after[g[:-1]][g[-1:]] = c

    def p(context, byte):
        if not context:
            return (n[byte] + 0.5) / (total + 128)
        own = after[context]
        return (own.get(byte, 0) + len(own) * p(context[1:], byte)) / (sum(own.values()) + len(own))

    kept = set()
    for context, own in list(after.items()):
        if context and sum(c * math.log(c / sum(own.values()) / p(context[1:], a)) for a, c in own.items()) > len(own) / 2 * math.log(total + 1):
            kept |= {context[k:] for k in range(len(context))}
    got = {int(s).to_bytes(d, "big") for d, (states, _) in model["states"].items() for s in states}
    assert got == kept and len(kept) > 15


def test_lm_edge_cases(spark):
    assert suffix_tree.score(edge_docs(spark)).count() == len(TEXTS)
    assert suffix_tree.score(empty_docs(spark)).count() == 0


def test_kneser_ney_matches_a_plain_model(spark):
    text = "the cat sat on the mat. The dog sat on the log; a cat and a dog. " * 3 + "unseen ones too"
    symbols, table = quality_classifier.trained(spark.createDataFrame([("m", text)], "model string, text string"))["m"]
    a = quality_classifier.ALPHABET
    grams = [int(g) for g in quality_classifier.trigrams(quality_classifier.code_points(text), symbols)]
    three = collections.Counter(((g // a // a, g // a % a), g % a) for g in grams)
    two = collections.Counter(((u[1],), w) for u, w in three)
    one = collections.Counter(((), w) for _, w in two)

    def model(counts, low):
        c = [sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)]
        y = c[0] / (c[0] + 2 * c[1]) if c[0] else 0
        d = [min(max(k - (k + 1) * y * c[k] / c[k - 1], 0.1), k - 0.1) if c[0] and c[1] and c[k - 1] else k / 2 for k in (1, 2, 3)]
        total, cut = collections.Counter(), collections.Counter()
        for (u, _), n in counts.items():
            total[u] += n
            cut[u] += d[min(n, 3) - 1]
        return lambda u, w: (max(counts[u, w] - d[min(counts[u, w], 3) - 1] if counts[u, w] else 0, 0) + cut[u] * low(u[1:], w)) / total[u] if total[u] else low(u[1:], w)

    p = model(three, model(two, model(one, lambda u, w: 1 / a)))
    rng = random.Random(2)
    for g in set(grams) | {rng.randrange(a ** 3) for _ in range(300)}:
        assert 10 ** float(table[g]) == pytest.approx(p((g // a // a, g // a % a), g % a), rel=1e-4)


def test_quality_classifier_keeps_clean_and_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality_classifier.classify(docs, labels).join(labels, "doc_id").collect()
    good, junk = [r for r in out if r.quality == 1 and not r.toxic], [r for r in out if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(not r.kept for r in junk) >= 0.7 * len(junk)
    kept = quality_classifier.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality_classifier.classify(docs, labels).filter("kept").collect()}


def test_rare_language_has_its_own_model_and_quantile_at_every_sample_size(spark):
    rng = random.Random(4)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(40))
    rows = [(k, text("abcdefghij"), "big") for k in range(900)] + [(900 + k, text("stuvwxyz"), "rare") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    for limit in (100, 2000):  # of a sample over all languages together, about 6 of 100 would be rare
        models, ids = quality_classifier.prepared(docs, labels, limit)
        assert set(models.value) == {"big", "rare", quality_classifier.POOLED}
        scores = quality_classifier.scored(docs, models)
        bars = quality_classifier.thresholds(scores, ids)
        own = collections.defaultdict(list)
        for r in scores.collect():
            own[r.model].append(r.log_perplexity)
            own[quality_classifier.POOLED].append(r.pooled)
        assert {k: len(v) for k, v in own.items()} == {"big": 900, "rare": 60, quality_classifier.POOLED: 960}
        seen = {r.doc_id: r.seen for r in ids.collect()}
        assert len(seen) == 960 and 0 < sum(seen.values()) <= limit
        unseen = collections.defaultdict(list)
        for r in scores.collect():
            if not seen[r.doc_id]:
                unseen[r.model].append(r.log_perplexity)
                unseen[quality_classifier.POOLED].append(r.pooled)
        q = lambda v: float(np.quantile(v, quality_classifier.QUANTILE))
        assert bars == pytest.approx({k: max(q(v), q(unseen[k])) for k, v in own.items()})
    trusted = docs.select("doc_id", "lang")
    drawn = quality_classifier.training_sample(trusted, ["big", "rare"], 100).join(trusted, "doc_id").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in drawn} == {"big": 50, "rare": 50}


def test_classifier_moves_hardly_more_texts_than_train(spark):
    docs = spark.range(20_000).selectExpr("if(id = 7, null, id div 2) as doc_id", "concat('text ', id) as text", "'en' as lang")  # ids repeat, one is null
    ids = spark.range(0, 10_000, 20).toDF("doc_id")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were too many ids
    try:
        got = quality_classifier.texts_of(docs, ids)
        assert sorted(r.text for r in got.collect()) == sorted(f"text {i}" for i in range(20_000) if i != 7 and i // 2 % 20 == 0)
        plan = got._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("ShuffledHashJoin"):]
        assert "SortMergeJoin" not in plan and join.index("Exchange") < join.index("BroadcastHashJoin")  # the bitmap comes before the shuffle
        none = quality_classifier.texts_of(docs, ids.limit(0))
        assert none.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_threshold_is_the_quantile_and_the_length_term_alone(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    models, ids = quality_classifier.prepared(docs, labels)
    bars = quality_classifier.thresholds(quality_classifier.scored(docs, models), ids)
    for r in quality_classifier.classify(docs, labels).collect():
        assert math.log10(r.threshold) == pytest.approx(bars[r.model] + quality_classifier.SCATTER / math.sqrt(max(r.chars, 1)))


def test_quality_classifier_edge_cases(spark):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (10, 1, None)], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    out = quality_classifier.classify(docs, labels).collect()
    assert len(out) == len(TEXTS) and all(r.kept for r in out if r.doc_id in (1, 8, None))
    assert quality_classifier.classify(docs, labels.limit(0)).filter("kept").count() == len(TEXTS)
    assert quality_classifier.kept_documents(empty_docs(spark), labels).count() == 0


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 20))] for _ in range(2))
        assert decontaminate.common_length(a, decontaminate.masks_of(a), b) == brute_lcs(a, b)


def test_decontamination_finds_what_brute_force_finds(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    common = words[:30]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n))
    items = [(k, text(rng.randint(12, 60)) + ". " + text(6) + ".") for k in range(50)] + [(99, "tiny one"), (None, "no id at all but long enough"), (98, None)]
    docs, planted, paraphrased = [], set(), set()
    for d in range(400):
        body, k = text(rng.randint(20, 400)).split(), rng.randrange(50)
        own = items[k][1].split()
        if d % 4 == 0:
            planted.add((d, k))
        elif d % 4 == 1:
            cut = len(own) - 6  # the answer stays
            own = [w if j >= cut or rng.random() < 0.85 else rng.choice(words) for j, w in enumerate(own)]
            if brute_lcs(decontaminate.words_of(items[k][1]), decontaminate.words_of(" ".join(own))) / len(own) >= 0.75:
                paraphrased.add((d, k))
        else:
            own = own[:6]  # a fragment is no leak
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at] + [w.upper() for w in own] + body[at:])))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(df, it).collect()}
    assert planted <= got and len(paraphrased & got) >= 0.9 * len(paraphrased)
    assert all(d % 4 < 2 for d, _ in got)
    assert {r.doc_id for r in decontaminate.clean(df, it).collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_decontamination_finds_every_verbatim_item_of_a_large_benchmark(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(4000)]
    common = words[:200]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.6 else rng.choice(words) for _ in range(n))
    items = [(k, text(rng.choice((5, 8, rng.randint(15, 59))))) for k in range(1200)]
    assert sum(len(t) for _, t in items) < decontaminate.BLOCK_CHARS  # one block
    docs = []
    for d in range(300):
        body = [f"own{d}x{j}" if rng.random() < 0.5 else rng.choice(words) for j in range(rng.randint(150, 250))]
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at] + items[4 * d][1].split() + body[at:])))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(df, it).collect()}
    assert set(got) == {(d, 4 * d) for d in range(300)} and all(r.lcs_share == 1 for r in got.values())
    assert decontaminate.clean(df, it).count() == 0


def test_latent_space_is_smaller_than_the_passages_and_joins_words_that_occur_together(spark):
    rng = random.Random(3)
    topics = [[f"t{t}w{j}" for j in range(12)] for t in range(8)]
    twin = {f"t{t}w{j}": f"t{t}other{j}" for t in range(8) for j in range(4)}  # used where the item's word could stand
    text = lambda t, n, share: " ".join(twin.get(w, w) if rng.random() < share else w for w in (rng.choice(topics[t]) for _ in range(n)))
    items = [(k, text(k % 8, 30, 0.0)) for k in range(40)]
    docs = [(d, text(d % 8, 200, 0.5)) for d in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert decontaminate.prepared(items, df)["latent"].shape == (40, 20)
    model = decontaminate.prepared(items, df, rank=8)  # as many as topics
    number, idf = model["number"], model["idf"]
    assert all(w.encode() in number for w in twin.values())  # from the windows, not from the items

    def plain(words):
        x = np.zeros(len(idf))
        for w in words:
            x[number[w]] += idf[number[w]]
        return x / np.linalg.norm(x)

    ours, wrong, gain = [], [], []
    for k, t in items:
        words = [twin.get(w, w).encode() for w in t.split()]
        latent = decontaminate.cosines(model, np.array([number[w] for w in words]), [(0, len(words))])[0]
        ours.append(latent[k])
        wrong.append(max(latent[j] for j in range(40) if j % 8 != k % 8))
        gain.append(latent[k] - plain(words) @ plain([w.encode() for w in t.split()]))
    assert min(ours) > max(wrong) and min(ours) >= decontaminate.MIN_COSINE
    assert sum(gain) / len(gain) > 0.1 and sum(g > 0 for g in gain) >= 38


def test_decontamination_recall_of_paraphrases_against_brute_force(spark):
    rng = random.Random(23)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(2500)]
    common = words[:60]
    text = lambda n: [rng.choice(common) if rng.random() < 0.5 else rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(text(rng.randint(18, 50))) + ". " + " ".join(text(5)) + ".") for k in range(150)]
    docs = []
    for d in range(240):
        body, own = text(rng.randint(60, 200)), decontaminate.words_of(items[d % 150][1])
        # every fourth word, at least, is another one: no run of five words is left, the answer stays
        own = [rng.choice(words) if j % 4 == d % 4 and j < len(own) - 5 else w.decode() for j, w in enumerate(own)]
        own = [w if j < len(own) - 5 or j != len(own) - 3 else rng.choice(words) for j, w in enumerate(own)]
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at] + own + body[at:])))
    want = set()
    for d, t in docs:
        w = decontaminate.words_of(t)
        for k, it in items:
            own, answer = decontaminate.words_of(it), decontaminate.answer_of(it)
            for a in range(0, max(1, len(w) - len(own)), 4):
                part = w[a:a + 2 * len(own)]
                share = decontaminate.common_length(own, decontaminate.masks_of(own), part) / len(own)
                if share >= 0.8 or share >= 0.6 and decontaminate.common_length(answer, decontaminate.masks_of(answer), part) / len(answer) >= 0.8:
                    want.add((d, k))
                    break
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.matches(df, it).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert len(want) >= 150 and len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.02 * len(got)


def test_latent_space_is_fitted_on_the_windows_of_all_documents(spark):
    # 24,000 documents hold a run of the item's words, each beside a word of its own number
    docs = spark.range(24_000).selectExpr("id as doc_id", "concat('one two three four five n', id, if(id % 4000 = 11, ' seldom', if(id % 200 = 11, ' synonym', ''))) as text")
    idf = {w: 1.0 for w in (b"one", b"two", b"three", b"four", b"five")}
    windows = decontaminate.near_windows(docs, idf, 2.0)
    assert windows.count() == 24_000
    assert decontaminate.words_beside(windows, set(idf)) == [b"synonym"]  # in 3 of 4096 windows, or more
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat(if(id in (5, 6, 7), 'one two three four five synonym ', ''), 'n', id) as text")
    number = decontaminate.prepared([(1, "one two three four five")], docs)["number"]
    assert sorted(number) == sorted([*idf, b"synonym"])


def test_latent_vectors_are_singular_vectors(spark):
    rng = np.random.default_rng(1)
    a = rng.random((40, 25)) * (rng.random((40, 25)) < 0.3)
    rows = [(np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for r in a]
    v = decontaminate.latent_space(spark.createDataFrame(rows, "ids array<int>, weights array<double>").repartition(4), 25, rank=5)
    want = np.linalg.svd(a)[1][:5]
    assert np.linalg.norm(a @ v, axis=0) == pytest.approx(want, rel=1e-2)


def test_decontamination_edge_cases(spark):
    items = spark.createDataFrame([(1, "one two three four five"), (2, ""), (3, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(edge_docs(spark), items).collect()}
    assert got == {(4, 1), (9, 1)}
    assert decontaminate.matches(edge_docs(spark), items.limit(0)).count() == 0
    assert decontaminate.matches(empty_docs(spark), items).count() == 0
    kept = decontaminate.clean(edge_docs(spark), items)
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(TEXTS) - 3


def mixed_docs(spark):
    rows = [(k, "w " * (1 + k % 7), "hot" if k % 3 else f"s{k % 11}") for k in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_meets_entropy_repetition_and_budget(spark):
    docs = mixed_docs(spark)
    rows = mixing.counted(docs)
    w = {r.source: r for r in mixing.weights(mixing.source_tokens(rows), 0.95, 8.0).collect()}
    p = [r.weight for r in w.values()]
    assert sum(p) == pytest.approx(1) and -sum(x * math.log(x) for x in p) / math.log(len(p)) == pytest.approx(0.95, abs=1e-3)
    out = mixing.mix(docs, 0.95, 8.0).collect()
    seen, tokens = collections.Counter(r.doc_id for r in out), collections.Counter()
    for r in out:
        tokens[r.source] += r.tokens
    assert set(seen) == set(range(3000))
    for s, r in w.items():
        assert 0 <= r.epochs * r.tokens - tokens[s] <= 8 and 1 <= r.epochs <= 8
    limited = {r.source: r.epochs for r in mixing.weights(mixing.source_tokens(rows), 1.0, 1.5).collect()}
    assert max(limited.values()) == pytest.approx(1.5, abs=1e-3)
    part = mixing.mix(docs, 0.95, 8.0, budget=3000).collect()
    assert 2900 <= sum(r.tokens for r in part) <= 3000 and max(r.epoch for r in part) == 1
    with pytest.raises(ValueError):
        mixing.weights(mixing.source_tokens(rows), 0.95, 2.0, budget=10 ** 9)


def test_mixing_takes_blocks_in_order(spark):
    docs = mixed_docs(spark)
    out = mixing.mix(docs, 0.95, 8.0).collect()
    last = max(r.epoch for r in out if r.source == "s0")
    blocks = collections.Counter((r.source, r.block) for r in out if r.source == "s0" and r.epoch == last)
    whole = collections.Counter((r.source, r.block) for r in out if r.source == "s0" and r.epoch == 1)
    assert sum(blocks[b] < whole[b] for b in blocks) <= 1  # only the block on the border is cut
    same = mixing.mix(docs.repartition(7), 0.95, 8.0).collect()
    assert sorted(r.place for r in same) == sorted(r.place for r in out)


def test_mixing_edge_cases(spark):
    out = mixing.mixed_documents(edge_docs(spark))
    assert out.columns == edge_docs(spark).columns and out.count() >= len(TEXTS)
    assert mixing.mix(empty_docs(spark)).count() == 0 and mixing.mixed_documents(empty_docs(spark)).count() == 0
    counts = edge_docs(spark).select("doc_id", "text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(split(r.text or "")) for r in counts)


def expected_tokens(rows):
    from tokenizers import Tokenizer
    t, at, out = Tokenizer.from_file(TOKENIZER), 0, []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_round_trip(spark):
    odd = ["a  b", " lead", "trail ", "tab\t x", "  nb", "x <|endoftext|> y", "\n a\n\n b", "don't we'll  can't", "é\U0001F600 ", "1 23 4,5", "a  b"]
    docs = with_edges(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(200_000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    out = token_file.token_files(docs.repartition(5), TOKENIZER, sequence=64).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == expected_tokens(rows)


def test_token_files_give_sequences_without_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = fresh_path(spark, "token-files")
    manifest = token_file.write_token_files(docs, folder, open(TOKENIZER, encoding="utf-8").read(), sequence=128).collect()
    for m in manifest:
        path = f"{token_file.filesystem(folder)[1]}/shard-{m.shard:06d}"
        file = token_file.SequenceFile(path)
        n = sum(file.file.get_batch(k).num_rows for k in range(file.file.num_record_batches))
        assert n == -(-m.n_tokens // 128)
        ids, mask = zip(*(file[k] for k in range(n)))
        assert not ids[0].flags.owndata and all(len(x) == 128 for x in ids)
        mask = np.concatenate([x.to_numpy(zero_copy_only=False) for x in mask])
        assert mask[:m.n_tokens].all() and not mask[m.n_tokens:].any()


def test_token_files_edge_cases(spark):
    assert token_file.token_files(empty_docs(spark), TOKENIZER).count() == 0
    out = token_file.token_files(edge_docs(spark), TOKENIZER).collect()
    assert len(out) == len(TEXTS) and min(out, key=lambda r: r.start).doc_id is None


def brute_fingerprint(text):
    words = split(lower(text))
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=4):
    """Component of each (doc_id, fingerprint) by plain search over all pairs."""
    ids, best = [i for i, _ in fps], {}
    a = np.array([f for _, f in fps], np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= radius
    left = set(range(len(ids)))
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            k = todo.pop()
            group.add(k)
            more = [j for j in np.flatnonzero(near[k]).tolist() if j in left]
            left.difference_update(more)
            todo += more
        for k in group:
            best[ids[k]] = min(ids[j] for j in group)
    return best


def test_simhash_matches_brute_force(spark):
    docs = with_edges(spark).filter("length(text) < 100000 or text is null")
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = components(fps)
    out = simhash_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in out) == sorted((i, f, want[i]) for i, f in fps)
    first = simhash_dedup.representatives(docs)
    assert first.columns == docs.columns and sorted(r.doc_id for r in first.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("tile", (16, 4096))
def test_tiled_links_join_dense_and_chained_groups(spark, tile):
    rng = random.Random(7)
    fps, base = [], rng.getrandbits(64)
    for k in range(300):  # a large group within a few bits
        fps.append((k, base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))))
    chain = rng.getrandbits(64)
    for k in range(60):  # a chain whose ends are far apart
        chain ^= 0b1011 << (k % 60)
        fps.append((1000 + k, chain))
    fps += [(2000 + k, rng.getrandbits(64)) for k in range(200)]
    fps = list({f: i for i, f in reversed(fps)}.items())
    fps = sorted((i, f) for f, i in fps)
    nodes = spark.createDataFrame([((f + 2 ** 63) % 2 ** 64 - 2 ** 63, i) for i, f in fps], "fp long, rep long")
    got = {r.node: r.component for r in simhash_dedup.connected_components(simhash_dedup.links(nodes, tile=tile)).collect()}
    want = components(fps)
    assert {i: got.get(i, i) for i, _ in fps} == want


def test_simhash_edge_cases(spark):
    out = simhash_dedup.near_duplicates(edge_docs(spark)).collect()
    assert len(out) == len(TEXTS) and {r.component_id for r in out if r.doc_id in (1, 2, 8)} == {1}
    assert simhash_dedup.near_duplicates(empty_docs(spark)).count() == 0
    kept = simhash_dedup.representatives(edge_docs(spark))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None).count(4) == 1


def test_encoder_gives_the_librarys_ids_in_any_slices(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer
    rng = random.Random(9)
    pieces = ["one", "one.", "one...", "1,", "it's!", "\u00e9;", "\u0660?", "(x).", "?!", "Two,", "three.", "dos", "ñu", "\U0001F600", "<|endoftext|>", "<|", "a\nb", "\n", "x" * 40, "", "\t", " ", "12", "it's"]
    texts = ["", " ", "  ", "one", " one", "one ", "one  two"] + [" ".join(rng.choices(pieces, weights=[5, 5, 5, 3, 3, 3, 3, 3, 3, 9, 9, 9, 9, 5, .3, .3, 3, .5, 3, .7, .5, .5, 5, 5], k=rng.randint(0, 30))) for _ in range(400)]
    whole = Tokenizer.from_file(TOKENIZER)
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    for held in (token_file.HELD_BYTES, 2000, 0):
        monkeypatch.setattr(token_file, "HELD_BYTES", held)
        encoder = token_file.Encoder(whole.to_str())
        got = [x for at in range(0, len(texts), 37) for x in encoder.encode(pa.array(texts).slice(at, 37))]
        assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == want


def test_classifier_reads_scripts_above_the_basic_ones(spark):
    rng = random.Random(4)
    common, rare = [chr(0x4E00 + k) for k in range(300)], [chr(0x7000 + k) for k in range(4000)]
    phrase = ["".join(rng.choices(common, k=4)) for _ in range(120)]
    text = lambda: "".join(rng.choices(phrase, k=60))
    rows = [(k, text(), "zh") for k in range(80)] + [(100 + k, text(), "zh") for k in range(20)]
    rows += [(200 + k, "".join(rng.choices(rare, k=240)), "zh") for k in range(20)] + [(300 + k, "".join(rng.choices(common, k=240)), "zh") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(80)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_classifier.classify(docs, labels).collect()}
    assert sum(kept[k] for k in [*range(80), *range(100, 120)]) >= 98
    assert not any(kept[k] for k in range(200, 220)) and not any(kept[k] for k in range(300, 320))


def test_mix_holds_its_weights_up_to_any_place(spark):
    rows = spark.range(12_000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(5 + id % 13 as int))").alias("text"),
                                      F.expr("case when id % 3 > 0 then 'hot' when id % 2 = 0 then 'b' else concat('s', id % 5) end").alias("source"))
    for budget in (None, 70_000):
        out = mixing.mix(rows, 0.95, 8.0, budget).collect()
        weight = {r.source: r.weight for r in out}
        assert max(r.epoch for r in out) > 1 and max(weight.values()) < 0.5
        for tenth in range(1, 11):
            some = collections.Counter()
            for r in out:
                if r.place < tenth / 10:
                    some[r.source] += r.tokens
            for s, w in weight.items():
                assert abs(some[s] / sum(some.values()) - w) < 0.02
    # the blocks of a source's last epoch are a prefix of that epoch's permutation
    last = {s: max(r.epoch for r in out if r.source == s) for s in weight}
    for s, e in last.items():
        taken = {r.block for r in out if r.source == s and r.epoch == e}
        whole = spark.range(mixing.BLOCKS).select("id", mixing._order(F.lit(e - 1), F.col("id").cast("int")).alias("o")).orderBy("o", "id").collect()
        held = {r.block for r in mixing.counted(rows).filter(F.col("source") == s).select(F.col("_mix_block").alias("block")).distinct().collect()}
        assert taken <= held and {b.id for b in [w for w in whole if w.id in held][:len(taken) - 1]} <= taken
