"""Operators 11, 12 and 13 against brute force and on edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptwatt.llm import fill_middle, ranked_search, sharding
from promptwatt.llm.common import fresh_path

from .edge import edge_docs, empty_docs

SF = "/root/testdata/sf0.001"
ODD = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "é\n漢字\r\n\U0001F600", "<P>x\ny", "x <S", "P>\n<M\n>", "ab<M>cd", "\x8a\n\x0b\n".replace("\x8a", "\u008a"), "ʊ\n" * 5000,
       "line\n" * 40 + "end", "x" * 100_000 + "\n" + "ÿ" * 3]


def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = edge_docs(spark).select("doc_id", "text")
    odd = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    return base.unionByName(more).unionByName(odd)


def cut_plainly(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def key(t):
    return tuple((x is None, str(x)) for x in t)


def test_fill_in_middle_matches_a_plain_cut_and_restores_every_text(spark, monkeypatch):
    rows = docs(spark)
    texts = rows.collect()
    for size in (fill_middle.SLICE_BYTES, 1000):
        monkeypatch.setattr(fill_middle, "SLICE_BYTES", size)
        out = fill_middle.fill_in_middle(rows)
        got = [tuple(r) for r in out.collect()]
        assert sorted(got, key=key) == sorted(((r.doc_id, *cut_plainly(r.doc_id, r.text)) for r in texts), key=key)
        back = out.select(fill_middle.restored(F.col("output"), F.col("form"))).collect()
        assert sorted(r[0] for r in back) == sorted(r.text or "" for r in texts)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_fill_in_middle_shares_and_empty_table(spark):
    assert fill_middle.fill_in_middle(empty_docs(spark)).collect() == []
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    forms = collections.Counter(r.form for r in fill_middle.fill_in_middle(rows, rate=60, spm=25).collect())
    assert forms["plain"] == pytest.approx(800, abs=80) and forms["spm"] == pytest.approx(300, abs=60)


def test_word_marks_rank_and_select_like_a_byte_loop():
    rng = np.random.default_rng(5)
    for size in (8, 64, 800):
        data = rng.choice(np.array([0x0A, 0x0B, 0x09, 0x8A, 0x00, 0x80, 0xFF, 0x0A], np.uint8), size)
        words = data.view("<u8")
        where = np.flatnonzero(data == 0x0A)
        marks = fill_middle.Marks(fill_middle.byte_marks(words, 0x0A))
        assert marks.select(np.arange(len(where))).tolist() == where.tolist()
        assert marks.rank(np.arange(size + 1)).tolist() == [0, *np.cumsum(data == 0x0A).tolist()]
        starts = fill_middle.Marks(fill_middle.start_marks(words))
        assert starts.rank(np.arange(size + 1)).tolist() == [0, *np.cumsum((data & 0xC0) != 0x80).tolist()]


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 200])
def test_shards_follow_jump_consistent_hashing(spark, shards):
    rows = docs(spark).unionByName(spark.range(5000, 9000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")))
    for r in sharding.with_shards(rows, "doc_id", shards).collect():
        seed = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard) == (jump(seed, shards), jump(seed, shards + 1))


def test_rows_beyond_the_usual_number_of_jumps_go_on(spark, monkeypatch):
    want = {r.doc_id: r.shard for r in sharding.with_shards(spark.range(300).toDF("doc_id"), "doc_id", 60).collect()}
    monkeypatch.setattr(sharding.math, "log", lambda x: -3.5)  # two jumps in the first loop
    assert {r.doc_id: r.shard for r in sharding.with_shards(spark.range(300).toDF("doc_id"), "doc_id", 60).collect()} == want


def test_shards_are_near_equal_and_a_further_one_takes_its_fraction(spark):
    rows = sharding.with_shards(spark.range(60_000).toDF("doc_id"), "doc_id", 24).groupBy("shard", "grown_shard").count().collect()
    counts = collections.Counter()
    for r in rows:
        counts[r.shard] += r["count"]
        assert r.grown_shard in (r.shard, 24)
    assert set(counts) == set(range(24)) and max(counts.values()) < 1.1 * min(counts.values())
    assert sum(r["count"] for r in rows if r.grown_shard == 24) == pytest.approx(60_000 / 25, rel=0.1)


@pytest.mark.parametrize("bin_rows, chunk", [(8192, 4096), (3, 4)])
def test_slots_are_gapless_also_for_a_hot_key(spark, monkeypatch, bin_rows, chunk):
    monkeypatch.setattr(sharding, "BIN_ROWS", bin_rows)
    monkeypatch.setattr(sharding, "CHUNK", chunk)
    hot = spark.range(100).select(F.lit(3).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = docs(spark).unionByName(hot).unionByName(hot.select("doc_id", F.expr("concat(text, monotonically_increasing_id())").alias("text")))
    out = sharding.shard_rows(rows).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows.collect())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    held = collections.defaultdict(list)
    for r in out:
        held[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in held.values())
    assert sharding.shard_rows(empty_docs(spark)).collect() == []


def test_written_shards_hold_every_row(spark):
    rows = docs(spark)
    path = sharding.write_shards(rows, path=fresh_path(spark, "test-shards"))
    back = spark.read.parquet(path)
    assert back.count() == rows.count()
    assert back.exceptAll(sharding.with_shards(rows).select("doc_id", "text", "shard")).count() == 0


def rank_plainly(rows, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, collections.Counter(find(t))) for d, t in rows]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c, size in held:
            m = 100 - 75 + 75 * size * n // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, k in collections.Counter(find(text)).items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:10])]
    return sorted(out, key=key)


ITEMS = [(1, "one two three four five"), (2, "word other THIRD word word"), (3, ""), (4, None), (5, "unseen-term of none"), (6, "one two three word"),
         (6, "one two three word"), (None, "ünï cödé two"), (8, "third fourth fifth " * 200), (9, "\U0001F600")]


@pytest.mark.parametrize("block", [ranked_search.BLOCK_CHARS, 4000])
def test_ranks_match_brute_force(spark, monkeypatch, block):
    rows = docs(spark)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").unionByName(spark.createDataFrame(ITEMS, "item_id long, text string"))
    monkeypatch.setattr(ranked_search, "MATRIX_BYTES", 1 << 20)
    out = ranked_search.search(rows, items.withColumn("rank", F.lit(1)), block_chars=block)
    want = rank_plainly([tuple(r) for r in rows.collect()], [tuple(r) for r in items.collect()])
    assert sorted((tuple(r) for r in out.collect()), key=key) == want and len(want) > 50


def test_equal_scores_rank_by_doc_id_over_all_tasks(spark):
    rows = spark.range(300, numPartitions=7).select((F.lit(1000) - F.col("id")).alias("doc_id"), F.lit("same words here").alias("text")).unionByName(
        spark.createDataFrame([(1, "others only")], "doc_id long, text string"))
    out = ranked_search.search(rows, spark.createDataFrame([(1, "others same")], "item_id long, text string")).orderBy("rank").collect()
    assert [r.doc_id for r in out] == [1, *range(701, 710)]


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert ranked_search.search(empty_docs(spark), items).collect() == []
    assert ranked_search.search(docs(spark), items.limit(0)).collect() == []


def test_shared_nodes_rebuild_every_item_and_save_sums():
    rng = random.Random(3)
    items = [set(rng.sample(range(60), rng.randint(0, 25))) | {60, 61} for _ in range(80)]
    nodes, held = ranked_search.share(items, 62)

    def leaves(a):
        return {a} if a < 62 else leaves(nodes[a - 62][0]) | leaves(nodes[a - 62][1])

    for item, left in zip(items, held):
        parts = [leaves(a) for a in left]
        assert set().union(*parts) == item and sum(map(len, parts)) == len(item)
    assert len(nodes) + sum(len(x) - 1 for x in held) < 0.8 * sum(len(x) - 1 for x in items)
    shared = collections.Counter(a for x in held for a in x) + collections.Counter(a for pair in nodes for a in pair)
    assert all(shared[62 + k] for k in range(len(nodes)))
