"""Work done once: measurements kept for several passes, cheap text primitives and
the prefix search of duplicate removal against brute force."""

from __future__ import annotations

import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from promptwatt import constants as K
from promptwatt.functions import rewrite as R, text as T
from promptwatt.operators import complexity as CX
from promptwatt.operators.complexity import complexity
from promptwatt.operators.features import features
from promptwatt.plans.analyze import analyze
from promptwatt.plans.registry import REGISTRY

TEXTS = ["", " ", "#\n1. one\n# b) x\nb) y\n12. z", "a\u00a0b\u2003c\x1cd\u3000e", "x-y don't Stra\u00dfe \u0130I \u4e2d\u6587 42", "\x07bell, (a) [b] {c}? `q` \"r\" a:\u2022-b",
         "Why? And how, but 3.14 and 2.\n\n```x``` Abc ABc A1b", "tail\n", "\n", "a\x85b\x9fc", None]


@pytest.fixture(scope="module")
def rows(tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("scale"))
    data = [(k, t, "en", "web") for k, t in enumerate(TEXTS * 3)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["word_length_bins", "median_split", "energy_histogram", "anomaly_feature_stats", "describe_features", "calibration_fit", "training_set", "validation_metrics"])
def test_documents_are_read_once(spark, rows, name):
    assert not [f for f in REGISTRY[name][0](spark, rows).inputFiles() if "documents.parquet" in f]


def test_no_lookup_of_every_character(spark, rows):
    d = complexity(features(spark.read.parquet(f"{rows}/documents.parquet")))
    assert "translate(" not in d._jdf.queryExecution().optimizedPlan().toString()


def test_text_primitives(spark):
    d = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    marks = (T.count_regex(T.norm_ws("t"), r"#+\s") + T.count_regex(F.concat(F.lit("\n"), T.norm_ws("t")), r"\n(?:\p{Nd}+\.|[a-z]\))"))
    got = d.select("t", T.norm_ws("t").alias("n"), T.count_chars("t", ":\u2022-").alias("c"), T.count_sub("t", "\n\n").alias("s"), T.word_tokens("t").alias("w"), marks.alias("m")).collect()
    for r in got:
        assert r.n == "".join(" " if x in K.EXOTIC_WS else x for x in r.t)
        assert r.c == sum(r.t.count(x) for x in ":\u2022-") and r.s == r.t.count("\n\n")
        assert r.m == len(re.findall(r"(?m)(?:#+\s|^\d+\.|^[a-z]\))", r.n))
        runs = re.sub(r"[^\w\-]+|_", " ", r.t.lower().replace("i\u0307", "i\u0300"))
        if "\u0130" not in r.t:
            assert r.w == [x for x in runs.split(" ") if x and "-" not in x]


def test_counts_without_plain_words(spark):
    more = ["The a bb ccc Dd e-f Gg. x y", " a \n1. b c\na) d  e \u00e9a b,c ``` d ```` # e #f", "aA Bb \u00e9C \U00010400\U00010428 Dd\u3000Ee \u4e2d a b C\u00df", "\n\n\n a b \n\n"]
    d = spark.createDataFrame([(t,) for t in [t for t in TEXTS if t is not None] + more], "t string")
    patterns = [r"[.,!?;:\"'()\[\]{}\-]", "[:\u2022-]", r"\p{Nd}+\.", r"\p{Nd}+", "\n\n", "```", CX._HASHES]
    rest = T.without_plain_words("t")
    counts = [F.struct(T.count_regex("t", p).alias("whole"), T.count_regex(rest, p).alias("rest")) for p in patterns]
    caps = T.count_regex(T.norm_ws(rest), CX._CAPITALIZED)
    for r in d.select("t", F.array(*counts).alias("c"), caps.alias("caps")).collect():
        assert all(c.whole == c.rest for c in r.c)
        words = "".join(" " if x in K.EXOTIC_WS else x for x in r.t).split()
        kinds = [[unicodedata.category(x) for x in w] for w in words]
        assert r.caps == sum(k[0] == "Lu" and "Ll" in k and not {"Lu", "Lt"} & set(k[1:]) for k in kinds)


def test_contains_word(spark):
    words = (*K.REASONING_WORDS, *K.CONDITIONAL_MARKERS, "a", "ze")
    texts = ["", "xplain", "explain", "an xplain explai", "hypothesize ypothesize", "pothesize", "whyhow if", "if ", "unless while although ", "a" * 50 + "nalyze", *words]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in d.select("t", F.array(*[T.contains_word("t", w) for w in words]).alias("f")).collect():
        assert r.f == [w in r.t for w in words]


def test_marks_take_no_pass_over_the_text(spark, rows):
    d = analyze(spark.read.parquet(f"{rows}/documents.parquet"))
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?<![a-z_])replace\(_raw", plan)) <= 1
    assert len(re.findall(r"array_distinct\(_words", plan)) == 1


def test_long_word_is_gone_over_once(spark):
    d = spark.createDataFrame([("A" + "b" * 300_000 + "C d",)], "text string")
    began = time.monotonic()
    assert complexity(d).first().complexity_score > 0
    assert time.monotonic() - began < 60


def _shortest(n: str) -> int:
    for size in range(50, min(len(n) // 2, 499) + 1):
        if n.count(n[:size]) >= 2 and n.count(n[:size]) * size / len(n) >= 0.7:
            return size
    return 0


def test_prefix_search(spark):
    """Every length is found as by trying all, with a look at few of them."""
    draw = random.Random(5)
    texts = []
    for _ in range(60):
        unit = "".join(draw.choice("abcd ") for _ in range(draw.randint(40, 300))).strip() + "x"
        texts.append((unit * draw.randint(1, 9) + "".join(draw.choice("efgh") for _ in range(draw.choice([0, 30, 200])))) .replace("  ", " "))
    texts = [re.sub(r"\s+", " ", t) for t in texts]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    out = R.dedup_content(d, "t", "o")
    assert "next" in out._jdf.queryExecution().optimizedPlan().toString()
    found = 0
    for r in out.collect():
        size = _shortest(r.t) if len(r.t) >= 100 and r.t.find(r.t[:50], 50) >= 0 else 0
        want = r.t[:size].strip() if size and len(r.t[:size].strip()) < len(r.t) * 0.6 else r.t
        found += want != r.t
        assert r.o == want
    assert found > 10


def test_all_trusted_documents_train(spark):
    """No limit: of 26,000 trusted documents all but every fifth of a language train."""
    from promptwatt.llm import quality_classifier as Q

    trusted = spark.range(26_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, "rare").otherwise("big").alias("lang"))
    got = {(r.lang, r.held): r["count"] for r in Q.training_sample(trusted, ["big", "rare"]).join(trusted, "doc_id").groupBy("lang", "held").count().collect()}
    assert got == {("big", True): 5000, ("big", False): 20_000, ("rare", True): 200, ("rare", False): 800}


def test_rewrite_metrics_are_not_computed_inside_lambdas(spark):
    """an interpreted lambda computes shared parts anew, so it may only read columns."""
    from promptwatt.operators.rewrite import alternatives
    plan = alternatives(spark.createDataFrame([(1, "a b")], "id long, text string"), "id")._jdf.queryExecution().optimizedPlan().toString()
    inside = [line for line in plan.splitlines() if "lambdafunction" in line and "array_intersect" in line and "semantic_similarity" in line and "filter(array(" in line]
    assert not inside and "array_intersect" in plan


def test_only_rules_with_a_key_word_are_tried(spark):
    """each rule names a word that no rule brings in, and odd letters try all rules."""
    from promptwatt import constants as K
    from promptwatt.functions import rewrite as R
    brought = {w for ph, rep in K.VERBOSE_PHRASES for w in rep.split() if w not in ph.split()}
    assert all(set(k) <= set(ph.replace("'", " ").split()) - brought for ph, _, _, k in R.VERBOSE_RULES)
    texts = ["it is IN ORDER TO be in spite of it", "helloplease go", "Thankſ and thanks, x", "End result", "\U0001d400kindly now", "quicKly LiKely, Really so"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {f: [r.x for r in getattr(R, f)(d, "text", "x").select("x").collect()] for f in ("remove_verbose", "remove_politeness", "remove_redundancy", "remove_fillers")}
    assert got["remove_verbose"][0] == "It is to be despite it"
    assert got["remove_politeness"][1:3] == ["go", "and x"]
    assert got["remove_redundancy"][3] == "result"
    assert got["remove_fillers"][5] == "quicKly so"


def test_candidates_are_compared_before_they_become_rows(spark):
    """No row of a candidate carries the prompt's text to the comparison."""
    from promptwatt.operators.optimize import optimize
    plan = optimize(spark.createDataFrame([(1, "a b")], "id long, text string"), "id")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate posexplode")]
    assert "array_intersect" not in above
