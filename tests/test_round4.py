"""Round 4: whole jobs where a part had been left out."""

import random

import numpy as np
from pyspark.sql import functions as F

from papyrion.llm import html_extract
from papyrion.llm.scratch import Scratch
from papyrion.operators import graph, phrases
from papyrion.plans import catalog
from papyrion.plans.inputs import nodes

SCHEMA = "doc_id long, doc_type string, authors array<string>, tags array<string>"


def _pairs(rows, least):
    jaccard = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    as_set = lambda c: {x for x in c or [] if x is not None}
    sets = [(i, kind, as_set(authors), as_set(tags)) for i, kind, authors, tags in rows if i is not None]
    score = lambda a, b: 0.5 * jaccard(a[3], b[3]) + 0.3 * (a[1] is not None and a[1] == b[1]) + 0.2 * jaccard(a[2], b[2])
    return sorted((a[0], b[0], round(s, 6)) for a in sets for b in sets if a[0] < b[0] and (s := score(a, b)) >= least)


def test_sim_pairs_gives_every_pair(spark, tmp_path):
    """both ids and the similarity of each pair, not numbers of links."""
    part = [(i, f"part {i}", f"Brand#{i % 3}", "XY"[i % 2], i % 10, 900.0) for i in range(300)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    rows = [tuple(r) for r in nodes(spark, str(tmp_path)).select("doc_id", "doc_type", "authors", "tags").collect()]
    found = catalog.QUERIES["sim_pairs"](spark, str(tmp_path)).select("doc_id", "other_id", "similarity").collect()
    assert sorted(tuple(r) for r in found) == _pairs(rows, 0.6)


def test_pairs_of_blocks_are_the_pairs_of_documents(spark):
    """Classes in several blocks, classes that are not similar to themselves, nulls, and an id that comes twice."""
    rng = random.Random(5)
    kinds = [(rng.choice(["x", "y", None]), rng.sample(["a", "b", None], rng.randrange(3)) or None, rng.sample("pqrst", rng.randrange(5))) for _ in range(15)]
    rows = [(i, kind, authors, tags + tags[:1]) for i in range(120) for kind, authors, tags in [rng.choice(kinds)]]
    rows += [(None, *rows[3][1:]), (7, *rows[8][1:])]
    for least in (0.55, 0.6, 0.72, 0.85):
        for most in (4, 256):
            found = graph.all_similar_pairs(spark.createDataFrame(rows, SCHEMA), least, most).select("doc_id", "other_id", F.round("similarity", 6))
            assert sorted(tuple(r) for r in found.collect()) == _pairs(rows, least)


def test_pages_with_articles_are_compared_too(spark, monkeypatch):
    """every page meets its nearest URL, though no line of these may be deleted; so their texts stay whole."""
    page = "<nav>Menu</nav><article><h1>Head {0}</h1><p>quoted</p><p>own {0}</p></article><footer>foot</footer>"
    rows = [(i, f"http://h{i % 3}.org/{i:02d}", page.format(i)) for i in range(30)] + [(30, "http://alone.org/1", page.format(30)), (31, "http://h0.org/00b", page.format(0))]
    kept, keep = {}, Scratch.save

    def save(scratch, df, name):
        out = keep(scratch, df, name)
        if name == "shared":
            kept[name] = out.collect()
        return out

    monkeypatch.setattr(Scratch, "save", save)
    found = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: f"Head {0 if i == 31 else i} quoted own {0 if i == 31 else i}" for i, _, _ in rows}
    assert sorted((r["host"], tuple(r["shared"])) for r in kept["shared"]) == [(f"h{h}.org", (0, 2, 4)) for h in range(3) for _ in range(10)]


def test_captions_and_formulas_are_text(spark):
    rows = [(1, "http://h.org/1", "<article><p>a</p><figure><img src=x><figcaption>Caption</figcaption></figure><p>with <math><mi>x</mi></math></p></article>")]
    found = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in found] == ["a Caption with x"]


def test_few_candidates_are_handed_on(spark):
    """rare runs of words are not shuffled; concepts are those of loops, however many terms are broadcast."""
    rng = random.Random(6)
    word = lambda: rng.choice(["machine", "learning", "the", "deep", "net", "x", "réseau", "ñandú", "".join(rng.choices("abcdefgh", k=8))])
    texts = ["".join(word() + rng.choice([" ", " ", "\t", "\u00a0 ", ", ", ".\n"]) for _ in range(rng.randrange(120))) for _ in range(60)] + [None, "", " \n", "the machine " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string").repartition(3)
    plain = docs.select("doc_id", F.explode(phrases.candidates("content")).alias("term")).collect()
    value = {r["term"]: r["c_value"] for r in phrases.terms(docs, phrases.PhraseConfig(min_count=4)).collect()}
    assert {t for t in {r["term"] for r in plain} if sum(r["term"] == t for r in plain) >= 4} == set(value)
    want = {}
    for r in plain:
        if value.get(r["term"], 0) > 0:
            want.setdefault(r["doc_id"], set()).add(r["term"])
    want = {i: sorted(found, key=lambda t: (-value[t], t))[:3] for i, found in want.items()}
    for most in (0, 2, 6, 1000):
        config = phrases.PhraseConfig(min_count=4, most_broadcast=most)
        found = phrases.concepts(docs, phrases.terms(docs, config), 3, config).collect()
        assert {r["doc_id"]: r["concepts"] for r in found} == want

    frequent = phrases._frequent_pairs(docs, phrases.PhraseConfig(min_count=4), "content").value
    rare = {r["term"] for r in plain} - set(value)
    assert len(rare) > 5 * len(value) and int(np.unpackbits(frequent).sum()) < len(rare) / 4
