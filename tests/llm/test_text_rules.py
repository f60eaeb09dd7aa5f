import random
import re
from collections import Counter

import pandas as pd
from hypothesis import given, settings, strategies as st

from ledgerloom.llm.pages import extract, main_text
from ledgerloom.llm.quality import judge, log_ratios
from ledgerloom.llm.token_count import Automaton, count_tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def greedy(word, initial, inner):
    n, at = 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in (inner if at else initial)), 0)
        if not size:
            return 1, 1
        at, n = at + size, n + 1
    return n, 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=8), st.sets(st.text("abc", min_size=1, max_size=5), max_size=8), st.text("abc", max_size=12))
def test_automaton(initial, inner, word):
    got = Automaton(initial, inner).count(word)
    assert (got & ((1 << 40) - 1), got >> 40) == greedy(word, initial, inner)


def test_token_counts(spark):
    initial, inner = {"un", "a", "ab"}, {"b", "able", "bc"}
    rows = [(1, "unable abc  ab\nzzz", None, None, 0), (2, None, None, None, 0), (3, " ", None, None, 0), (None, "a", None, None, 0), (1, "a" * 5000, None, None, 0)]
    out = count_tokens(spark.createDataFrame(rows, SCHEMA), Automaton(initial, inner)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_tokens, r.n_unknown) for r in out) == sorted(
        (i or -1, len((t or "").split()), *(sum(x) for x in zip((0, 0), *(greedy(w, initial, inner) for w in (t or "").split())))) for i, t, *_ in rows)


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


def test_quality(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    odd = [(9000, None, None, None, 0), (9001, "", None, None, 0), (9002, "é ü\x0b# \n\n a b c a b c a b\n \n x\nx", None, None, 0), (None, "a b", None, None, None), (9002, "q", None, None, 0)]
    df = docs.unionByName(spark.createDataFrame(odd, SCHEMA)).selectExpr("*", "1 as raw", "2 as bucket")
    out = judge(df, log_ratios(df, labels)).toPandas()
    got = Counter(tuple(r) for r in out[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]].itertuples(index=False))
    assert got == Counter(base(r.text) for r in df.collect())
    assert not (out.base_failed & out.kept).any()
    both = out.merge(pd.read_parquet(f"{small}/labels.parquet"), on="doc_id")
    both = both[~both.base_failed]
    assert both[both.quality == 1].kept.mean() > 0.99 and both[both.quality == 0].kept.mean() < 0.2
    none = judge(df, log_ratios(df, labels.filter("quality = 7"))).toPandas()
    assert (none.kept == ~none.base_failed).all()
    assert judge(df.limit(0), log_ratios(df.limit(0), labels)).count() == 0


def test_pages(spark, small):
    prose = "This is the text of an article that has been written for the reader, and it goes on for more than a line or two so that it is long enough to be taken for text by the rules."
    page = f"""<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href=x>Home</a> of the</nav><div class="cookie-notice">{prose}</div>
    <article><header><h1>Title &amp; more</h1></header><p>{prose}<br>next&nbsp;line &copy;<p><b>short one<p>{prose}</article>
    <div class="comments"><p>{prose}</p></div><form>{prose}</form><aside>{prose}</aside><footer>{prose}</footer></body></html>"""
    assert main_text(page) == "\n".join(["Title & more", f"{prose} next line ©", "short one", prose])
    assert main_text(None) == main_text("") == main_text("<script>x</script><p") == "" and main_text("plain <b>text") == "plain text"
    rows = spark.read.parquet(f"{small}/pages.parquet")
    for r in extract(rows.withColumn("text", rows.url)).join(rows, "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = [x for x in (re.sub(r"[\s ]+", " ", __import__("html").unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)) if x]
        assert r.text.replace(" ", "") == "\n".join(want).replace(" ", "") and r.n_chars == len(r.text)


def test_wrapped_pages():
    prose = "This is the text of an article that has been written for the reader, and it goes on for more than a line or two so that it is long enough to be taken for text by the rules."
    prose = f"{prose} {prose}"
    for mark in ("layout has-sidebar", "hfeed no-sidebar", "page with-comments", "search-results", "legal-text"):
        assert main_text(f'<body><div class="{mark}"><div class="sidebar">{prose}</div><p>{prose} 1</p></div></body>') == f"{prose} 1", mark
    for mark in ("sidebar", "site-header", "has-sidebar", "nav"):
        page = f'<div class="{mark}"><h1>Title</h1><article><p>{prose} 1</p></article><p>{prose} 2</p><div class="comments"><article>{prose} 3</article></div></div><div class="site-footer">{prose}</div>'
        assert main_text(page) == f"Title\n{prose} 1\n{prose} 2", mark
    assert main_text(f'<form id="f"><div class="ads"><main>{prose} 1</main></div></form>') == f"{prose} 1"
    for name in ("svg", "math", "canvas", "object"):
        assert main_text(f'<p>{prose} 1</p><{name} class="a>b"/><p>{prose} 2</p><{name} x="1">{prose} 3</{name}><{name}-list>{prose} 4</{name}-list>') == "\n".join(f"{prose} {i}" for i in (1, 2, 4))
