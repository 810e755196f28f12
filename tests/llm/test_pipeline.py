"""The pipeline's stages, each on its own input and against a plain restatement of it."""

import hashlib
import os
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from papyrion.llm import decontaminate, quality_classifier

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


SPACES = re.compile(r"[\x20\x09-\x0D]+")


def line_fails(line):
    """The line rules, read off their description."""
    words = [w for w in SPACES.split(line) if w]
    if not words:
        return False
    separators = sum(w in ("|", "»", "›", ">", "·", "•", "/", "::") for w in words)
    noise = sum(c in "#*$%&|<>{}=~^!?" for c in line)
    return (
        not re.search(r"""[.!?…。！？]["”»')\]]*(?:[\x20\x09-\x0D]|$)""", line)
        or separators > 0 and 5 * separators >= len(words)
        or noise > 0 and 10 * noise >= sum(map(len, words))
        or re.search(r"(?i)cookie|javascript|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|subscribe", line) is not None
    )


def cleaned(text):
    """The text without failing lines, or None if the document goes."""
    from test_rules_and_urls import base_counts

    n, chars, _, _, repeated = base_counts(text)
    lines = (text or "").split("\n")
    lost = sum(len(SPACES.sub("", x)) for x in lines if line_fails(x))
    return None if n < 50 or 2 * repeated > n or 2 * lost > chars else "\n".join(x for x in lines if not line_fails(x))


def test_stages(spark, tmp_path):
    from test_dedup import brute_force
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert set(after) <= set(before) and out.columns[: len(columns)] == columns
        if i < len(names) - 1:
            assert out.columns == columns
        if name == "quality classifier":
            model = quality_classifier.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            scores = quality_classifier.score_documents(docs, model).where(F.col("score") >= 0.3)
            assert set(after) == {r[0] for r in scores.collect()}
            assert len(after) > 0.6 * len(before)
        elif name == "quality rules":
            want = {d: cleaned(t) for d, t in before.items()}
            assert after == {d: t for d, t in want.items() if t is not None}
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "minhash near-dedup":
            want = brute_force(list(before.items()), 5)
            assert set(after) == {d for d, (_, c) in want.items() if d == c}
        elif name == "benchmark decontamination":
            bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            left = decontaminate.find_contamination(out, bench)
            hits = {r["doc_id"]: r["n_hit"] for r in decontaminate.find_contamination(docs, bench).collect()}
            assert all(after[d] == before[d] for d in after if not hits[d])
            assert all(len(after[d]) < len(before[d]) for d in after if hits[d])
            assert left.where("n_hit > 0").count() <= 2  # a cut can join what stood apart
        else:
            assert set(after) == set(before)
            assert out.where("n_tokens <> size(token_ids)").isEmpty()
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            for r in out.collect():
                ids = library.encode(r["text"], add_special_tokens=False).ids
                assert r["token_ids"] == ids
                assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        docs, before = out, after
    whole = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert whole == {r["doc_id"]: r["decoded_sha256"] for r in docs.collect()}
