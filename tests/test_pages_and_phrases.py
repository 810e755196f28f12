"""Text files read in parts, and terms by C-value against plain loops."""

import math
import random
import re
from collections import Counter

from papyrion.operators import phrases
from papyrion.operators.phrases import PhraseConfig
from papyrion.sources import files


def test_text_files_in_parts_have_the_pages_of_whole_ones(spark, tmp_path):
    rng = random.Random(9)
    page = lambda: rng.choice(["", " \n", "a few words \r\n of a page é日\n" * rng.randrange(1, 40)])
    given = {"one.txt": [page() for _ in range(60)], "two words.txt": ["start " * 40, *(page() for _ in range(9)), ""], "short.txt": ["tiny"], "empty.txt": [""], "big page.txt": ["word " * 9000, "end " * 30]}
    given["odd.txt"] = ["".join(chr(0x4E00 + i) for i in range(1200))]
    for name, pages in given.items():
        (tmp_path / name).write_text("\f".join(pages), newline="")
    folder, columns = str(tmp_path), [c.split()[0] for c in files.PAGES.split(", ")]
    want = files.extract_pages(files.scan(spark, folder, "*.txt"), "text", None).select(*columns)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    listed = sorted((r["file_key"], r["hash"]) for r in files.text_listing(spark, folder).collect())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "2000")
        raw = spark.read.option("lineSep", "\f").text(folder)
        assert raw.rdd.getNumPartitions() > 12
        got = files.text_pages(spark, folder).select(*columns).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {k for k, _ in listed} == set(given) - {"empty.txt"} and len({h for _, h in listed}) == len(listed)  # Spark lists no empty files
    (tmp_path / "short.txt").write_text("tinY")
    again = sorted((r["file_key"], r["hash"]) for r in files.text_listing(spark, folder).collect())
    assert [a[0] for a, b in zip(listed, again) if a != b] == ["short.txt"]


def plain_terms(texts, config):
    counts = Counter()
    for t in texts:
        for stretch in re.split(r"[.!?;:,()\n]+", (t or "").lower()):
            w = stretch.split()
            for n in range(2, config.most_words + 1):
                for i in range(len(w) - n + 1):
                    p = tuple(w[i : i + n])
                    if all(len(x) > 1 and x.isalpha() for x in p) and p[0] not in config.stop_words and p[-1] not in config.stop_words:
                        counts[p] += 1
    counts = {p: n for p, n in counts.items() if n >= config.min_count}
    out = set()
    for p, n in counts.items():
        holders = [m for q, m in counts.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        alone = n - (sum(holders) / len(holders) if holders else 0)
        out.add((" ".join(p), len(p), n, len(holders), math.floor(math.log2(len(p)) * alone * 1e4 + 0.5)))
    return out


def test_terms_equal_plain_loops(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["machine", "learning", "the", "of", "deep", "net", "x", "2nd", "réseau"])
    texts = ["".join(word() + rng.choice([" ", " ", " ", ", ", ".\n"]) for _ in range(rng.randrange(60))) for _ in range(40)] + [None, "", "deep learning " * 3000]
    config = PhraseConfig(min_count=3, stop_words=("the", "of"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, content string").repartition(4)
    found = phrases.terms(docs, config)
    want = plain_terms(texts, config)
    assert {tuple(r) for r in found.collect()} == want
    value = {t: c for t, _, _, _, c in want if c > 0}
    for r in phrases.concepts(docs, found, 3, config).collect():
        held = {t for t in value if t in {" ".join(p) for p in _runs(texts[r["doc_id"]])}}
        assert r["concepts"] == sorted(held, key=lambda t: (-value[t], t))[:3]


def _runs(text):
    for stretch in re.split(r"[.!?;:,()\n]+", text.lower()):
        w = stretch.split()
        for n in (2, 3, 4):
            yield from (tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def test_no_texts(spark):
    assert phrases.terms(spark.createDataFrame([], "content string")).count() == 0


def test_candidates_are_found_once_a_row(spark):
    docs = spark.createDataFrame([(1, "deep learning net\u2028 works, of deep nets")], "doc_id int, content string")
    assert docs.select(phrases.candidates("content").alias("c")).first()["c"] == ["deep learning", "deep nets"]
    plan = phrases.terms(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "size(flatten(array(regexp" not in plan and "size(transform(flatten(array(regexp" not in plan
