"""Nulls, empty and very long values, repeated rows, empty tables and clashing columns, for each operator."""

import os
import random

import pytest
from pyspark.sql import functions as F

from papyrion.llm import bpe, decontaminate, html_extract, lm_scoring, near_dedup, quality_classifier, quality_rules, toxicity, url_filter, warc
from papyrion.llm.scratch import Scratch

DOCS = "doc_id long, text string, score string, kept string, spans string, items string, token_ids string, decoded string, label string"
LONG = "word " * 200_000


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *["mine"] * 7) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, an empty, a blank and a very long text, an id without a row of its own, and rows repeated in full."""
    return docs_of(spark, [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "some words here"), (5, "some words here"), (5, "other words under the same id"), (None, "no id")])


def labels_of(spark, ids):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2, "mine") for i in ids], "doc_id long, quality int, toxic int, text string")


def test_urls(spark):
    rules = [url_filter.UrlRule("block", "com", "/a"), url_filter.UrlRule("allow", "com", "/a"), url_filter.UrlRule("block", "x.com", "")]
    long = "http://x.com/" + "a/" * 500_000
    rows = spark.createDataFrame([(1, "http://com/ab", "mine"), (2, long, "mine"), (2, long, "mine"), (3, None, "mine"), (None, "http://b.com/a", "mine")], "page_id long, url string, rule string")
    rows = rows.selectExpr("page_id", "url", "rule", "rule as host", "rule as path", "rule as verdict")
    for most in (64 << 20, 0):
        got = sorted(((r["page_id"] or 0, r["rule"], r["verdict"], len(r["path"])) for r in url_filter.filter_urls(rows, rules, max_table_bytes=most).collect()), key=str)
        # of rules with equal keys the last counts; the longer key wins
        assert got == [(0, "com/a", "allow", 2), (1, "com/a", "allow", 3), (2, "x.com", "block", 1_000_001), (2, "x.com", "block", 1_000_001), (3, None, "allow", 0)]
        assert url_filter.filter_urls(rows.limit(0), rules, max_table_bytes=most).count() == 0


def test_rules(odd):
    rows = quality_rules.judge_documents(odd).collect()
    assert len(rows) == 8 and not any(r["kept"] for r in rows)
    assert quality_rules.keep_clean_documents(odd).columns == odd.columns


def test_classifier(spark, odd):
    labels = labels_of(spark, range(1, 6))
    model = quality_classifier.train(odd, labels)
    once = quality_classifier.train(odd.dropDuplicates(["doc_id", "text"]), labels)
    assert (model.bucket_scores() == once.bucket_scores()).all()  # rows repeated in full train once
    scores = [r["score"] for r in quality_classifier.score_documents(odd, model).collect()]
    assert len(scores) == 8 and all(0 <= s <= 1 for s in scores)
    assert quality_classifier.keep_accepted(odd, model).columns == odd.columns
    assert quality_classifier.keep_accepted(odd.limit(0), model).count() == 0


def test_groups_keep_each_text_once(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = docs_of(spark, [(1, a), (2, a), (2, b), (7, c), (7, c), (None, a), (None, a), (8, None), (8, None), (9, "")])
    kept = near_dedup.keep_one_of_each_group(rows)
    assert kept.columns == rows.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (7, c), (None, a), (None, a), (8, None), (9, "")], key=str)
    judged = near_dedup.near_duplicates(rows).collect()
    assert {(r["doc_id"], r["component_id"]) for r in judged} == {(1, 1), (2, 1), (2, 2), (7, 7), (None, None), (8, 8), (9, 9)}
    assert near_dedup.keep_one_of_each_group(rows.limit(0)).count() == 0


def test_near_duplicates_take_odd_rows(odd):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == 8 and {r["component_id"] for r in got} == {1, 2, 3, 4, 5, None}


def test_toxicity(spark, odd):
    labels = labels_of(spark, range(1, 6))
    assert toxicity.learn_insults(odd, labels) == {}
    assert toxicity.learn_insults(odd.limit(0), labels) == {}
    rows = toxicity.score_documents(odd, toxicity.ClauseGrammar({"some": 1.0})).collect()
    assert len(rows) == 8 and len({(r["doc_id"], r["score"]) for r in rows}) == 7
    assert toxicity.upper_tail(3, 5, 0.5) == pytest.approx(0.5) and toxicity.upper_tail(900, 1000, 0.1) < 1e-200 and toxicity.upper_tail(0, 9, 0.2) == pytest.approx(1)


def test_clauses_against_plain_rules(spark):
    """The composed machine against the rules read word by word."""
    rng = random.Random(6)
    config = toxicity.ToxicityConfig()
    grammar = toxicity.ClauseGrammar({"zorg": 0.5, "blim": 1.0}, config)
    vocabulary = ["zorgish", "blim", "tree", "you", "not", "said", "kill", "walks", "they", "never"]

    def weight(words):
        kinds = [grammar.symbol(w) for w in words]
        total = 0.0
        for i, (kind, strength) in enumerate(kinds):
            if kind not in (toxicity.INSULT, toxicity.THREAT):
                continue
            before = [k for k, _ in kinds[max(0, i - config.reach) : i]]
            around = [k for k, _ in kinds[max(0, i - config.reach - 1) : i] + kinds[i + 1 : i + config.reach + 2]]
            name = "negated" if toxicity.NEGATION in before else "reported" if toxicity.REPORT in [k for k, _ in kinds[:i]] else "aimed" if toxicity.TARGET in around or toxicity.SUBJECT in around and kind == toxicity.INSULT else ""
            total += config.weights[f"{name} {kind}".strip()] * strength
        return total

    for _ in range(500):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))]
        assert grammar.clause_weight(" ".join(words)) == pytest.approx(weight(words)), words


def test_archives(spark):
    rows = spark.createDataFrame([(1, "u", "a", "x", 5), (1, "u", "a", "x", 5), (2, "u", "a", "x", 5), (None, None, "b", "x", 5), (3, "v", "y" * 3_000_000, "x", 5)], "page_id long, url string, html string, record_type string, payload_bytes int")
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive_round_trip(rows).collect()), key=str)
    assert got == [(0, "response", None, 1), (1, "response", None, 1), (1, "response", None, 1), (2, "revisit", 1, 1), (3, "response", None, 3_000_000)]


def test_damaged_archives_are_quarantined(spark, tmp_path):
    whole = b"".join(warc.member(warc.record("resource", {"WARC-Record-ID": f"<r{i}>"}, b"body %d" % i), 1) for i in range(9))
    bad = bytearray(whole)
    bad[len(whole) // 2] ^= 0xFF
    (tmp_path / "bad").write_bytes(bytes(bad))
    (tmp_path / "short").write_bytes(whole)
    files = spark.createDataFrame([(f"file://{tmp_path}/bad", 9), (f"file://{tmp_path}/short", 10)], "file string, records long")
    records, quarantine = warc.salvage(files, Scratch(spark, "test"))
    assert records.count() == 8 + 9
    gaps = {r["file"].rpartition("/")[2]: [] for r in quarantine.collect()}
    assert set(gaps) == {"bad", "short"} and "9 records where 10 were written" in [r["gap"] for r in quarantine.collect()]
    assert quarantine.where("length > 0").count() == 1


def test_reading_takes_linear_time():
    import os
    import time

    one = warc.member(warc.record("resource", {"WARC-Record-ID": "<r>"}, os.urandom(20_000)), 1)
    took = []
    for n in (200, 1600):
        began = time.process_time()
        assert sum(isinstance(r, warc.Record) for r in warc.read_records(one * n)) == n
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.2


def test_language_model(spark, odd):
    vocabulary, model = lm_scoring.train(odd, lm_scoring.WindowLmConfig(rounds=2, min_count=2))
    rows = lm_scoring.score_documents(odd, vocabulary, model).collect()
    assert len(rows) == 8 and {r["n_words"] for r in rows} == {0, 2, 3, 6, 200_000}
    assert len({r["log_likelihood"] for r in rows if r["n_words"] == 3}) == 1


def test_language_model_against_plain_sums(spark):
    """Each word's probability from the definition, in plain Python over the learned weights."""
    import numpy as np
    import pyarrow as pa

    from papyrion.llm.bytewords import SPACED, pieces

    texts = ["a b c a b", "c c b", "a", "z a z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm_scoring.word_counts(docs).cache()
    vocabulary, model = lm_scoring.train(docs, lm_scoring.WindowLmConfig(rounds=3, min_count=2, known_count=1), counts=counts)
    c = model.config
    got = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score_documents(docs, vocabulary, model, counts=counts).collect()}
    for i, text in enumerate(texts):
        piece = next(pieces(pa.array([text])))
        hashes = piece.hashes(*piece.words(SPACED)[:2])
        words, share, _ = vocabulary.look_up(hashes)
        total = 0.0
        for t, w in enumerate(words):
            h = np.zeros(c.dim)
            for place, by in enumerate(d for k in range(1, c.window + 1) for d in (-k, k)):
                h += model.E[place][words[t + by] if 0 <= t + by < len(words) else c.size]
            h = np.tanh(h)
            k = c.branches
            for weights, biases, node, branch in ((model.C, model.Cb, 0, w // k**2), (model.S, model.Sb, w // k**2, w // k % k), (model.W, model.Wb, w // k, w % k)):
                z = h @ weights[node] + biases[node]
                total += z[branch] - np.log(np.exp(z).sum())
            total += share[t]
        assert got[i] == pytest.approx(total, abs=1e-3)


def test_bpe(odd):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.encode_documents(odd, path)
    assert sorted(out.columns) == sorted(odd.columns)
    rows = out.collect()
    assert len(rows) == 8 and sorted(len(r["token_ids"]) for r in rows)[:3] == [0, 0, 0] and max(len(r["token_ids"]) for r in rows) == 200_000
    assert bpe.encode_documents(odd.limit(0), path).count() == 0 and bpe.encode_digests(odd.limit(0), path).count() == 0


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, "some words here"), (1, "some words here"), (None, "x"), (3, None)], "item_id long, text string")
    rows = decontaminate.find_contamination(odd, items).collect()
    assert len(rows) == 8 and [(r["doc_id"], r["n_hit"], r["items"]) for r in rows if r["n_hit"]] == [(5, 3, ["1"])] * 2
    assert decontaminate.find_contamination(odd.limit(0), items).count() == 0
    cut = decontaminate.remove_contamination(odd, items)
    assert cut.columns == odd.columns and cut.count() == 6
    assert decontaminate.remove_contamination(odd.limit(0), items).count() == 0


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_pages(spark):
    rows = [(1, "http://h/a", "<p>x</p><p>y</p>"), (1, "http://h/a", "<p>x</p><p>y</p>"), (2, "http://h/b", "<p>x</p><p>own</p>"), (None, None, None), (4, "http://h/c", "<p>x</p>" + "<p>many words here</p>" * 50_000)]
    rows = spark.createDataFrame([(*r, "mine", "mine") for r in rows], "page_id long, url string, html string, text string, lines string")
    got = sorted(((r["page_id"] or 0, r["text"][:20], r["n_chars"]) for r in html_extract.extract_main_text(rows).collect()), key=str)
    # equal neighbours are copies and not each other's template; the next unequal one is
    assert [x for x in got if x[0] in (0, 2)] == [(0, "", 0), (2, "own", 3)] and len(got) == 5
    assert html_extract.extract_main_text(rows.limit(0)).count() == 0


def test_every_page_is_aligned_with_its_neighbour(spark):
    rng = random.Random(12)
    pages = []
    for i in range(120):
        lines = [rng.choice(["<p>menu</p>", "<p>foot</p>", f"<p>text {rng.randrange(30)}</p>", "<div class=ad>buy</div>", f"<article><p>story {rng.randrange(5)}</p></article>"]) for _ in range(rng.randrange(9))]
        pages.append((i, f"http://h{rng.randrange(3)}/{rng.randrange(60):02d}", "".join(lines)))
    for protect in (True, False):
        frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
        got = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(frame, protect_articles=protect).collect()}
        parsed = [(u[7:9], u[9:], i, html_extract.blocks(h)) for i, u, h in pages]
        texts = lambda page: [b.text for b in page]
        for host, _, i, page in parsed:
            ours = texts(page)
            path, first, _ = min((p, j, 0) for h, p, j, other in parsed if h == host and texts(other) == ours)
            firsts = {}
            for h, p, j, other in sorted(parsed, key=lambda r: r[:3]):
                if h == host and texts(other) != ours:
                    firsts.setdefault(tuple(texts(other)), (p, j))
            # the longest common start; of equal ones the last before, else the first after
            ranked = sorted(((*v, k) for k, v in firsts.items()), key=lambda r: r[:2])
            theirs = None
            if ranked:
                most = max(len(os.path.commonprefix([path, r[0]])) for r in ranked)
                best = [r for r in ranked if len(os.path.commonprefix([path, r[0]])) == most]
                earlier = [r for r in best if r[:2] < (path, first)]
                theirs = list((earlier[-1] if earlier else best[0])[2])
            lines, places = html_extract.candidates(page, protect)
            left = got[i].split(" ") if got[i] else []
            words = " ".join(lines).split(" ") if lines else []
            assert len(left) <= len(words)
            if theirs is None or all(p < 0 for p in places):
                assert got[i] == " ".join(lines)
            elif places == list(range(len(page))):  # every line can be deleted, so what is gone is the common subsequence
                gone = len(lines) - sum(1 for _ in _lines_left(got[i], lines))
                assert gone == longest_common(ours, theirs)


def test_nearest_url_is_on_either_side(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [(0, "http://h/a/x", page("A", "zero")), (1, "http://h/b/1", page("B", "one")), (2, "http://h/b/2", page("B", "two"))]
    text = lambda rows: {r["page_id"]: r["text"] for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert text(rows) == {0: "A zero", 1: "one", 2: "two"}
    # copies, at one URL or several, have one result
    same = [(i, "http://h/c/1" if i < 30 else f"http://h/c/1{i}", page("menu", "same")) for i in range(10, 60)]
    assert text([(9, "http://h/c", page("menu", "other")), *same]) == {9: "other"} | {i: "same" for i, _, _ in same}
    assert set(text(same).values()) == {"menu same"}
    # equal lines, of which some copies protect one
    rows = [(1, "http://h/d/1", page("menu", "x")), (2, "http://h/d/2", "<p>menu</p><article><p>x</p></article>"), (3, "http://h/d/3", page("menu", "y"))]
    assert text(rows) == {1: "x", 2: "x", 3: "y"}


def _lines_left(text, lines):
    """The lines of which a text without some of them is made, in order."""
    at = 0
    for line in lines:
        if text.startswith(line, at) and (at + len(line) == len(text) or text[at + len(line)] == " "):
            at += len(line) + 1
            yield line


def test_stages_take_odd_tables(spark, odd, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path / "tables")
    labels_of(spark, range(1, 6)).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "some words here"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (odd, odd.limit(0)):
            out = stage(spark, rows, folder)
            assert out.columns[:2] == ["doc_id", "text"] and out.count() <= 8, name
            assert name.startswith("bpe") or out.columns == odd.columns
            assert not rows.isEmpty() or out.count() == 0
    spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long").limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_shared_folder_is_asked_for():
    from papyrion.session import set_checkpoint_folder

    class Bare:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return {}

        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        set_checkpoint_folder(Bare)
