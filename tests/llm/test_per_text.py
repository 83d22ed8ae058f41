"""Operators 1, 3, 9 and 10 against brute force and on edge cases."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from promptwatt.llm import chat_format, html_dom, html_extract, html_samples, pii, quality_rules
from promptwatt.llm.queries_text import PLANTED_TEXT

from .edge import TEXTS, edge_docs, empty_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trees(spark):
    return html_extract.fitted(spark, 600)


def article_blocks(html):
    import html as h
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inside)]
    return "\n".join(x for x in parts if x)


def test_html_extraction_finds_the_articles_of_the_table(spark, trees):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages, trees).collect()}
    assert got == {r.page_id: article_blocks(r.html) for r in pages.collect()}


def test_html_extraction_on_unseen_layouts(trees):
    samples, wrong = html_samples.Samples(777), 0
    for _ in range(200):
        html = samples.page()
        want = [t.replace(html_samples.MARK, "") for t in html_dom.Page(html).texts if html_samples.MARK in t]
        got = html_extract.extract_texts(trees, [html.replace(html_samples.MARK, "")])[0]
        wrong += got != "\n".join(want)
    assert wrong <= 8


def test_html_extraction_reads_pages_held_in_one_form(trees):
    samples, wrong = html_samples.Samples(778), 0
    for _ in range(40):
        html = samples.page().replace(html_samples.MARK, "")
        if "<body" not in html or not html_dom.LAYOUT.search(html):
            continue
        at = html.index(">", html.index("<body")) + 1
        inside = html[:at] + "<form action='/x'><input name=a>" + html[at:].replace("</body>", "</form></body>")
        wrong += html_extract.extract_texts(trees, [inside]) != html_extract.extract_texts(trees, [html])
    assert wrong <= 2
    small = "<body><article><h1>A</h1><p>" + "Some words of the text, in a row. " * 9 + "</p></article><form><p>Your name</p><button>Go</button></form></body>"
    assert "Your name" not in html_extract.extract_texts(trees, [small])[0]


def test_html_extraction_edge_cases(spark, trees):
    deep = "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000
    rows = [(1, "u", None, 5), (2, "u", "", 5), (3, None, "<script>var a='<p>no</p>'</script>", 5), (4, "u", "<article><p>a &amp; b\n  c<br>d</article>", 5),
            (4, "u", "<article><p>a &amp; b\n  c<br>d</article>", 5), (5, "u", deep, 5), (6, "u", "<p>unclosed <b>bold <li>", 5), (7, "u", "</div></p><<<&#0;&bogus;", 5),
            (None, "u", "<main><p>" + "long text. " * 30_000 + "</main>", 5)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text long"), trees).collect()
    text = {}
    for r in out:
        text.setdefault(r.page_id, []).append(r.text)
    assert len(out) == len(rows) and text[1] == text[2] == text[3] == [""] and text[4] == ["a & b c\nd"] * 2
    assert text[None][0] == ("long text. " * 30_000).strip()
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"), trees).count() == 0


def test_decoding_never_keeps_below_a_dropped_block(trees):
    samples = html_samples.Samples(5)
    for _ in range(50):
        page = html_dom.Page(samples.page())
        import numpy as np
        p = np.random.default_rng(1).random(len(page.tags))
        keep, drop = np.log(p), np.log(1 - p)
        kept = html_extract.decoded(page, p)
        assert all(t in page.texts for t in kept)


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, covered = {}, set()
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k:k + 3]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            covered.update(k + j for k in places for j in range(3))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_rules_base_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").unionByName(
        edge_docs(spark).filter("doc_id is not null").selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source"))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text)
    out = quality_rules.quality_rules(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        n_words, chars, symbols, dup, repeat = brute_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, chars, symbols, dup, repeat)
        assert r.base_failed == (n_words < 50 or 100 * repeat > 50 * n_words) and not (r.base_failed and r.kept)


def test_quality_rules_keep_clean_texts_and_reject_tables_of_symbols(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality_rules.quality_rules(docs).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = [r for r in out if r.quality == 1], [r for r in out if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) < len(bad) / 3


def test_quality_rules_edge_cases(spark):
    assert quality_rules.quality_rules(edge_docs(spark)).count() == len(TEXTS)
    assert quality_rules.quality_rules(empty_docs(spark)).count() == 0


def test_js_distance_is_a_bounded_symmetric_distance():
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(50):
        p, q = rng.integers(0, 9, 20).astype(float), rng.integers(0, 9, 20).astype(float)
        assert quality_rules.distance(p, q) == pytest.approx(quality_rules.distance(q, p))
        assert 0 <= quality_rules.distance(p, q) <= 1 and quality_rules.distance(p, p) == 0


def test_chat_format_reads_back_any_text(spark):
    nasty = ["", None, PLANTED_TEXT, "<turn user>\n</turn>\n", "\\b\\l\\g<>\\", "<|image:0|>", "a\nb", "\U0001F600<" * 5, "\\" * 7]
    rows = [(c, k, role, nasty[(c + k) % len(nasty)]) for c in range(9) for k, role in enumerate(("user", "assistant", "a>b", None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(df.withColumn("parts", chat_format.text_parts(F.col("text"))))
    out = out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in out:
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.t] == own and r.loss == [t for role, t in own if role == "assistant"]


def test_chat_format_parts_become_numbered_placeholders(spark):
    p = lambda kind, text=None, ref=None, size=None: (kind, text, ref, size)
    rows = [(1, 0, "user", [p("text", "see "), p("image", ref="a.png", size=3), None, p("audio", ref="b.wav", size=2)]),
            (1, 1, "assistant", [p("document", ref="c.pdf"), p("text", "ok"), p("strange", ref="d")]), (None, 0, "user", None), (2, None, "user", []), (2, None, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}").withColumn("formatted", F.lit(1))
    out = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    assert out[1].formatted == "<turn user>\nsee <|image:0|><|audio:1|></turn>\n<turn assistant>\n<|document:2|>ok<|document:3|></turn>\n"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in out[1].attachments] == [(0, "image", "a.png", 255), (1, "audio", "b.wav", 50), (2, "document", "c.pdf", 500), (3, "document", "d", 500)]
    assert out[1].attachment_tokens == 1305 and out[2].formatted == "<turn user>\n</turn>\n" * 2 and out[None].attachment_tokens == 0
    assert chat_format.format_conversations(df.limit(0)).count() == 0


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    total = 0
    for k, c in enumerate(reversed(s)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(RULES.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_rules_match_brute_force(spark):
    rng = random.Random(4)
    pieces = ["a@b.c", "_d@e.f", "x.y@", "@", "1.2.3.4", ".5.6.7.8", "256.1.1.1", "00012.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+", "+12", "é\U0001F600", " ", "-", "9", ".", "\n", "(", ")", "z%"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(600)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("s", pii.rule_spans(F.col("text"))).collect()
    for r in rows:
        assert [(s.start, s.kind, s.end) for s in r.s] == brute_spans(r.text), r.text


def test_pii_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(1)
    rows = [(k, f"write to user{k}@mail.example.com or customer number 4{rng.randrange(10**14):014d}x today") for k in range(40)]
    rows += [(100 + k, f"please write to QX{k:04d}-77Z9 today. Release 2024-0{k % 9 + 1}-11 is out") for k in range(20)]
    out = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    found = [texts[i][s.start:s.end] for i, r in out.items() for s in r.spans if s.kind == pii.KINDS.index("context")]
    assert sum(f.startswith("QX") for f in found) == 20 and not any(f.startswith("2024") for f in found)


def test_pii_edge_cases(spark):
    out = pii.personal_data(edge_docs(spark)).collect()
    assert len(out) == len(TEXTS) and all(not r.spans for r in out if r.doc_id in (1, 2, 8))
    assert pii.personal_data(empty_docs(spark)).count() == 0
    assert hashlib.sha256(b"").hexdigest() and json.dumps([r.doc_id for r in out])
