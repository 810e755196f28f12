"""Quality rules, URL filters, HTML extraction and WARC archives."""

import os
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrion.llm import html_extract, quality_rules, url_filter, warc

FOLDER = "/root/testdata/sf0.01"
PROSE = "The house stands by the river and the people of the town go there often. " * 6


def base_counts(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules_against_brute_force(spark):
    texts = [None, "", " \n\t", "a b c a b c", PROSE, PROSE + "\nx | y | z\n" * 3, "Ü#*\n\nÜ#*\n", "one two\n" * 40, "w" * 100_000, " ".join(f"w{i}" for i in range(20_000)), "\x0b\x0cq\u00a0r"]
    rows = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in quality_rules.judge_documents(rows).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base_counts(t), t
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    assert quality_rules.judge_documents(rows.limit(0)).count() == 0


def test_lines_decide(spark):
    prose = " ".join(f"Word{i} stands for thing{i}." for i in range(40))
    menu = "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(60))
    rows = spark.createDataFrame([(1, prose), (2, menu), (3, prose + "\n" + "Home | News | Sport"), (4, "\n".join(f"NEW{i}!! SALE{i}!! NOW{i}!!" for i in range(40)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge_documents(rows).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[3]["clean_text"] == prose
    kept = quality_rules.keep_clean_documents(rows.withColumn("n_chars", F.length("text").cast("long"))).collect()
    assert {(r["doc_id"], r["n_chars"]) for r in kept} == {(1, len(prose)), (3, len(prose))}


def test_filters_stay_above_the_splits(spark):
    docs = spark.createDataFrame([(1, PROSE)], "doc_id long, text string")
    plan = quality_rules.keep_clean_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    filters = plan[plan.index("Filter") : plan.index("Generate")]
    assert "split(" not in filters and "transform(" not in filters


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_filtering_costs_no_more_than_judging(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    began = time.time()
    quality_rules.keep_clean_documents(docs).write.format("noop").mode("overwrite").save()
    assert time.time() - began < 30


URLS = ["http://a.example.com/en/7x?q", "https://EXAMPLE.com/en/8", "http://x.net/de/", "http://example.net/de/8#t", "http://example.net/de", "ftp://h.org/es/1", "no scheme", None, "http://?q", "http://com/en/", "http://notcom/en/", "x://y://z.com/en/"]
RULES = ["example.com/en/7", "com/en/", "net/de/", "example.net/de/8", None, "org/es/", None, None, None, "com/en/", None, None]


@pytest.mark.parametrize("most", [64 << 20, 0])
def test_urls(spark, most):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(rows, max_table_bytes=most).collect()}
    assert [got[i]["rule"] for i in range(len(URLS))] == RULES
    block = {"com/en/", "net/de/", "example.net/de/8", "org/es/"}
    assert all(got[i]["verdict"] == ("block" if RULES[i] in block else "allow") for i in got)
    assert (got[0]["host"], got[0]["path"]) == ("a.example.com", "/en/7x") and got[7]["host"] == ""


def test_digests_agree_and_collisions_are_confirmed(spark, tmp_path):
    keys = ["", "a", "example.com/en/7", "ü/ß"]
    assert [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k")).collect()] == [url_filter.digest(k) for k in keys]
    (tmp_path / "rules").write_bytes(url_filter.DigestTable.to_bytes([url_filter.UrlRule("block", "a", "/")]))
    table = url_filter.DigestTable(str(tmp_path / "rules"))
    assert (table.key(0), table.verdict(0)) == ("a/", "block")
    d = np.array([url_filter.digest("a/"), url_filter.digest("a/"), 5])
    assert table.find(d, lambda i: ["a/", "other", "x"][int(i)]).tolist() == [0, -1, -1]


def test_html(spark):
    page = "<head><title>T</title><script>var a='<p>no</p>';</script></head><nav>Menu</nav><div class='ad'>Buy</div><article><h1>One&amp;two</h1><p><b>bold<br><p>Three\n four&nbsp;five</p><aside>x</aside></article><footer>&copy; me</footer>"
    rows = [(1, "http://h/a", page), (2, None, None), (3, "http://h/b", "plain &lt;text"), (4, "http://h/c", "<article>cut <p>off here<foo")]
    got = {r["page_id"]: r for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "One&two bold Three four five"
    assert (got[2]["text"], got[2]["n_chars"], got[3]["text"], got[4]["text"]) == ("", 0, "plain <text", "cut off here")


def test_neighbours_share_their_template(spark):
    frame = "<div>Site name</div><div>{}</div><p>Contact us</p>"
    rows = [(i, f"http://h{i % 2}.org/p/{i:03d}", frame.format(f"Own text {i}")) for i in range(40)] + [(100, "http://alone.org/x", frame.format("kept"))]
    got = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()}
    assert all(got[i] == f"Own text {i}" for i in range(40))
    assert got[100] == "Site name kept Contact us"


def test_pages_with_articles_are_neighbours(spark):
    frame = "<div>Site name</div>{}<p>Contact us</p>"
    rows = [
        (1, "http://h.org/a", frame.format("<article>Story</article>")),
        (2, "http://h.org/b", frame.format("<!-- <article> --><div>Own words</div>")),
        (3, "http://i.org/a", frame.format("<main>News</main>")),
        (4, "http://i.org/b", frame.format("<aside><article>Card</article></aside><div>Plain page</div>")),
    ]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {1: ("Story", 5), 2: ("Own words", 9), 3: ("News", 4), 4: ("Plain page", 10)}


def test_common_subsequence():
    a, b = list("xabcdefy"), list("qacbdfz")
    i = sorted(html_extract.shared_lines(a, b))
    assert [a[k] for k in i] in (["a", "b", "d", "f"], ["a", "c", "d", "f"])
    assert html_extract.shared_lines(["a", "b"], ["a", "b"]) == {0, 1}
    assert html_extract.shared_lines([], ["a"]) == set()


def test_archives_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", "ü" * 1000, None, "", "<p>b</p>\r\nWARC/1.1\r\n"]
    rows = spark.createDataFrame([(i, f"http://h/{i}\nx", h) for i, h in enumerate(html)], "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in warc.archive_round_trip(rows).collect()}
    assert [got[i]["record_type"] for i in range(6)] == ["response", "revisit", "response", "response", "revisit", "response"]
    assert [got[i]["refers_to"] for i in range(6)] == [None, 0, None, None, 3, None]
    for i, h in enumerate(html):
        data = (h or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), warc.base32_sha1(data))
    assert warc.archive_round_trip(rows.limit(0)).count() == 0


def test_damage_inside_a_member_costs_one_record():
    import random

    rng = random.Random(8)
    records = [warc.record("resource", {"WARC-Record-ID": f"<r{i}>"}, rng.randbytes(40_000)) for i in range(5)]
    names = lambda found: [r.fields["warc-record-id"] for r in found if isinstance(r, warc.Record)]
    plain = bytearray(b"".join(records))
    plain[100_500] ^= 1  # in the third record, before compression
    found = list(warc.read_records(warc.member(bytes(plain), 1) + warc.member(records[0], 1)))
    assert names(found) == ["<r0>", "<r1>", "<r3>", "<r4>", "<r0>"] and sum(isinstance(g, warc.Gap) for g in found) == 1
    whole = warc.member(b"".join(records), 1)
    cut = list(warc.read_records(whole[: len(whole) // 2]))
    assert names(cut) == ["<r0>", "<r1>"] and isinstance(cut[-1], warc.Gap)
    stored = bytearray(warc.member(b"".join(records), 0))
    stored[100_500] ^= 1
    found = list(warc.read_records(bytes(stored)))
    assert names(found) == ["<r0>", "<r1>", "<r3>", "<r4>"] and isinstance(found[-1], warc.Gap)


@pytest.mark.parametrize("compress", [True, False])
def test_damage_costs_one_record(compress):
    records = [warc.record("resource", {"WARC-Record-ID": f"<r{i}>"}, f"body {i} ".encode() * 50) for i in range(5)]
    parts = [warc.member(r, 6) if compress else r for r in records]
    whole = b"".join(parts)
    assert [r.fields["warc-record-id"] for r in warc.read_records(whole)] == [f"<r{i}>" for i in range(5)]
    bad = bytearray(whole)
    at = len(parts[0]) + len(parts[1]) + len(parts[2]) // 2
    bad[at : at + 3] = b"\xff\xff\xff"
    found = list(warc.read_records(bytes(bad)))
    assert [r.fields["warc-record-id"] for r in found if isinstance(r, warc.Record)] == ["<r0>", "<r1>", "<r3>", "<r4>"]
    gap = next(g for g in found if isinstance(g, warc.Gap))
    assert (gap.offset, gap.length) == (len(parts[0]) + len(parts[1]), len(parts[2]))
    cut = list(warc.read_records(whole[:-5]))
    assert isinstance(cut[-1], warc.Gap) and len(cut) == 5
    assert list(warc.read_records(b"")) == []


def test_verdicts_are_those_of_the_contract(spark):
    words = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    assert {rule.key: rule.verdict for rule in url_filter.DEFAULT_RULES} == words
    rows = spark.createDataFrame([(i, f"http://sub.{key}x") for i, key in enumerate(words)], "page_id long, url string")
    got = {r["rule"]: r["verdict"] for r in url_filter.filter_urls(rows).collect()}
    assert got == words
