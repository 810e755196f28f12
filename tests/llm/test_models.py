"""Classifier, toxicity grammar, language model, tokenizer and decontamination."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from papyrion.llm import bpe, decontaminate, lm_scoring, quality_classifier, toxicity
from papyrion.llm.bytewords import ALNUM, SPACED, pieces, shingles

WORDS = "the house stands by a river and people of this town walk there every day with their dogs in autumn".split()


def prose(rng, n=80):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def labelled(spark, n=400):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        bad, rude = i % 4 == 0, i % 3 == 0
        text = " ".join(w.upper() + "!!" for w in prose(rng).split()) if bad else prose(rng)
        if rude:
            text += " You are a zorgish fool, a zorgle. " + prose(rng, 10)
        docs.append((i, text, "x"))
        labels.append((i, int(not bad), int(rude)))
    docs += [(n, None, "x"), (n + 1, "", "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_learns_and_keeps_every_row(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.train(docs, labels)
    rows = quality_classifier.score_documents(docs, model).join(labels, "doc_id", "left").withColumn("h", quality_classifier.held_out()).collect()
    assert len(rows) == 402 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["h"] and r["quality"] is not None]
    assert np.mean([(r["score"] >= 0.3) == bool(r["quality"]) for r in held]) >= 0.95
    kept = quality_classifier.keep_accepted(docs, model)
    assert kept.columns == docs.columns and 250 < kept.count() < 402
    empty = quality_classifier.train(docs.limit(0), labels.limit(0))
    assert quality_classifier.score_documents(docs.limit(0), empty).count() == 0


def test_toxicity_learns_words_and_reads_clauses(spark):
    docs, labels = labelled(spark)
    insults = toxicity.learn_insults(docs, labels)
    assert any(w.startswith("zorg") for w in insults)
    g = toxicity.ClauseGrammar(insults)
    rows = toxicity.score_documents(docs, g).join(labels, "doc_id").withColumn("h", quality_classifier.held_out()).where("h").collect()
    assert all((r["score"] >= 0.5) == bool(r["toxic"]) for r in rows)
    assert toxicity.learn_insults(docs, labels.limit(0)) == {}
    g = toxicity.ClauseGrammar({"idiot": 1.0})
    plain, aimed, negated, told = (g.score(t) for t in ("an idiot stood there", "you are an idiot", "he was not an idiot", "She said that an idiot came"))
    assert aimed > plain >= 0.5 > told > negated >= g.score("") == g.score(None)
    assert g.score("an idiotic thing; not here") >= 0.5 and g.score("I will kill you") > g.score("they kill time")


def test_only_real_copies_are_dropped(spark):
    from papyrion.llm.scratch import Scratch

    # "common" is the least hash of all for some seed; texts that share it are no copies
    sets = [(i % 2, ["common", *(f"w{i}x{j}" for j in range(20 + i))]) for i in range(40)]
    copy = [f"copy{j}" for j in range(50)]
    sets += [(1, copy), (1, copy), (1, [*copy[:-2], "other"]), (0, [*copy, "clean"])]
    rows = spark.createDataFrame([(n, w, " ".join(w)) for n, w in sets], "label int, w array<string>, text string").withColumn("s", toxicity._shingles(F.col("text")))
    kept = [(r["label"], r["w"]) for r in toxicity._without_copies(rows, Scratch(spark, "test")).collect()]
    assert len(kept) == 42 and (1, copy) in kept and (0, [*copy, "clean"]) in kept


def test_language_model_beats_word_frequencies(spark):
    rng = random.Random(4)
    loop = "alpha beta gamma delta epsilon zeta eta theta".split()
    texts = [" ".join(loop[(i + j) % 8] for j in range(200)) for i in range(40)] + [prose(rng, 200) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(98, None), (99, " ")], "doc_id long, text string").repartition(3)
    config = lm_scoring.WindowLmConfig(batch=256)
    vocabulary, model = lm_scoring.train(docs, config)
    got = {r["doc_id"]: r for r in lm_scoring.score_documents(docs, vocabulary, model).collect()}
    ordered, mixed = np.mean([got[i]["perplexity"] for i in range(40)]), np.mean([got[i]["perplexity"] for i in range(40, 80)])
    assert ordered < 4 and ordered < mixed / 2
    assert (got[98]["n_words"], got[98]["log_likelihood"], got[98]["perplexity"]) == (0, 0.0, None) and got[99]["n_words"] == 0
    again = lm_scoring.score_documents(docs, *lm_scoring.train(docs, config)).where("doc_id = 0").first()
    assert again["log_likelihood"] == pytest.approx(got[0]["log_likelihood"], rel=1e-5)
    v, m = lm_scoring.train(docs.limit(0), config)
    assert lm_scoring.score_documents(docs.limit(0), v, m).count() == 0


def test_language_model_grows_and_tells_rare_words_apart(spark):
    texts = [" ".join(["common"] * 40 + [f"w{i}"] * (1 + i % 3)) for i in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm_scoring.word_counts(docs).cache()
    assert lm_scoring.build_vocabulary(counts, lm_scoring.WindowLmConfig(min_count=1)).config.size >= 901 + 64
    config = lm_scoring.WindowLmConfig(min_count=1000, known_count=3, rounds=2)
    vocabulary, model = lm_scoring.train(docs, config, counts=counts)
    probe = ["common w0 common", "common w1 common", "common w2 common", "common never common"]
    rows = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    got = [r["log_likelihood"] for r in lm_scoring.score_documents(rows, vocabulary, model, counts=counts).orderBy("doc_id").collect()]
    assert len(set(np.round(got, 6))) == 4
    # over all words and one that no text had, the probabilities in a window add up to 1
    words = ["common", *(f"w{i}" for i in range(900))]
    rows = spark.createDataFrame([(i, f"common {w} common") for i, w in enumerate(words)], "doc_id long, text string")
    found = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score_documents(rows, vocabulary, model, counts=counts).collect()}
    piece = next(pieces(pa.array([f"common {w} common" for w in words])))
    around, offsets = vocabulary.contexts(piece)[1:]
    entries = vocabulary.contexts(piece)[0]
    ends = [sum(model.log_probabilities(entries[o + k : o + k + 1], around[:, o + k : o + k + 1])[0] for k in (0, 2)) for o in offsets[:-1]]
    # one occurrence of each shared entry is left for unseen words
    assert 0.93 < sum(np.exp(found[i] - e) for i, e in enumerate(ends)) <= 1.0001


def test_language_model_does_not_depend_on_partitions(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, prose(rng, 200)) for i in range(60)], "doc_id long, text string")
    scores = []
    for n in (1, 40):
        rows = docs.repartition(n)
        scores.append({r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score_documents(rows, *lm_scoring.train(rows)).collect()})
    assert all(scores[1][i] == pytest.approx(v, rel=1e-3) for i, v in scores[0].items())


def test_language_model_gradient():
    """A step along the gradient raises the likelihood of the batch."""
    config = lm_scoring.WindowLmConfig()
    rng = np.random.default_rng(1)
    words, around = rng.integers(0, config.size, 500).astype(np.int32), rng.integers(0, config.size + 1, (4, 500)).astype(np.int32)
    model = lm_scoring.WindowLm(config)
    before = model.log_probabilities(words, around).sum()
    for _ in range(20):
        model.train(words, around, 0.3)
    assert model.log_probabilities(words, around).sum() > before


ALPHABET = ["a", "B", "Σ", "İ", "é", "e\u0301", "\x1c", "\x85", "\xa0", "\u200b", "\u3000", "1", "½", "中", "'s", "'T", "😀", "<|endoftext|>", "<|", "|>", " ", "\n", "!", "_", "ß", "\x00", "\x0b", "ǅ", "Ⅷ"]


def test_bpe_matches_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(9)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(500)] + ["", "x" * 20_000, "Hello, world's 42 lowercased WORDS!"]
    rows = spark.createDataFrame(list(enumerate(texts)) + [(9999, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.encode_digests(rows, path).collect()}
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[i]["n_tokens"] == len(e.ids), texts[i]
        assert got[i]["ids_sha256"] == sha(" ".join(map(str, e.ids)))
        assert got[i]["decoded_sha256"] == sha(library.decode(e.ids, skip_special_tokens=False))
    assert got[9999]["n_tokens"] == 0
    tokenizer = bpe.WordBpe(bpe.tokenizer_definition(path))
    assert tokenizer.decode(tokenizer.encode(texts[-1])) == library.decode(library.encode(texts[-1], add_special_tokens=False).ids, skip_special_tokens=False)
    full = bpe.encode_documents(rows, path).where("doc_id = 502").first()
    assert full["token_ids"] == library.encode(texts[502], add_special_tokens=False).ids


def test_bpe_keeps_none_of_the_data():
    import pickle

    import public_tokenizers

    tokenizer = bpe.WordBpe(bpe.tokenizer_definition(public_tokenizers.path("word_bpe_49k.json")))
    before = len(pickle.dumps(tokenizer))
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(20_000))
    assert len(tokenizer.encode(text)) > 20_000 and len(pickle.dumps(tokenizer)) == before


def test_bpe_in_groups_and_stretches(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    tokenizer = bpe.WordBpe(bpe.tokenizer_definition(path))
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(300))) for _ in range(40)] + ["", " " * 90, "\n".join(["Σé it's 42!"] * 60)]
    monkeypatch.setattr(bpe, "_STRETCH", 50)
    groups = list(bpe._groups(pa.array(texts)))
    assert [t for g in groups for t in g.to_pylist()] == texts
    assert all(len(g) == 1 or sum(map(len, g.to_pylist())) <= 50 for g in groups)
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        parts = [tokenizer.encode(s) for s in bpe._stretches(text)]
        assert sum(parts, []) == wanted == tokenizer.encode(text)
        digests = bpe._digests([tokenizer.texts_of(tokenizer.encode_texts(pa.array([s]))) for s in bpe._stretches(text)], True)
        assert digests[0][0].as_py() == hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()
        assert digests[1][0].as_py() == hashlib.sha256(library.decode(wanted, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_long_text(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    text = "the quick brown ford's 17 naïve foxes, jumped\n" * 60_000
    rows = spark.createDataFrame([(1, "a b"), (2, text), (3, None)], "doc_id long, text string")
    wanted = library.encode(text, add_special_tokens=False).ids
    full = {r["doc_id"]: r for r in bpe.encode_documents(rows, path).collect()}
    assert full[2]["token_ids"] == wanted and full[2]["decoded"] == library.decode(wanted, skip_special_tokens=False) and full[3]["decoded"] == ""
    got = {r["doc_id"]: r for r in bpe.encode_digests(rows, path).collect()}
    assert got[2]["n_tokens"] == len(wanted) and got[2]["ids_sha256"] == hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()


def test_segment_tree():
    rng = random.Random(2)
    values = [rng.randrange(5) for _ in range(37)]
    tree = bpe.SegmentTree(list(values))
    for _ in range(300):
        assert tree.leftmost_least() == (values.index(min(values)), min(values))
        i, v = rng.randrange(37), rng.randrange(9)
        values[i] = v
        tree.set(i, v)


def windows_of(items, n=10):
    for i, text in items:
        w = decontaminate.normalise(text)
        k = min(n, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            yield i, tuple(w[j : j + k])


def test_decontamination_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(12)] + ["Straße", "é"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 10, 11, 25, 40]))) for i in range(1, 25)] + [(90, None), (91, "..."), (92, "")]
    docs = [(i, " ".join([say(5), items[i % 24][1].upper(), "-", say(3), items[(i * 7) % 24][1][: rng.randrange(5, 60)]])) for i in range(60)] + [(100, None), (101, ""), (102, say(20_000))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for config in (decontaminate.DecontaminationConfig(), decontaminate.DecontaminationConfig(max_block_words=60)):
        got = {r["doc_id"]: r for r in decontaminate.find_contamination(d, b, config).collect()}
        found = list(windows_of(items))
        for i, text in docs:
            w = decontaminate.normalise(text)
            hit, names = set(), set()
            for item, window in found:
                n = len(window)
                for j in range(len(w) - n + 1):
                    if tuple(w[j : j + n]) == window:
                        hit |= set(range(j, j + n))
                        names.add(str(item))
            assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(w), len(hit), sorted(names))
    assert decontaminate.find_contamination(d, b.limit(0)).where("n_hit > 0").isEmpty()


def test_spans_are_cut_out(spark):
    item = " ".join(f"word{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"Before this. {item.title()}! And after it.", 9), (2, item, 9), (3, None, 9), (4, "clean", 9)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in decontaminate.remove_contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[1]["text"] == "Before this.! And after it." and got[1]["n_chars"] == len(got[1]["text"])
    assert set(got) == {1, 3, 4} and got[4]["text"] == "clean"


def test_spans_do_not_depend_on_blocks(spark):
    say = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    # the second item overlaps the first in text 2, and the third spans what lies around the first in text 3
    third = f"{say('c', 6)} {say('d', 6)}"
    items = [(1, say("a", 20)), (2, f"{say('a', 20)[-30:]} {say('b', 12)}".split(" ", 1)[1]), (3, third)]
    docs = [(1, f"{say('a', 20)} clean {say('c', 6)} {say('d', 6)} text"), (2, f"{say('z', 60)} {say('a', 20)} {say('b', 12)} {say('y', 60)}"), (3, f"{say('z', 60)} {say('c', 6)} {say('a', 20)} {say('d', 6)} {say('y', 60)}"), (4, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    configs = (decontaminate.DecontaminationConfig(), decontaminate.DecontaminationConfig(max_block_words=1))
    one, many = ({r["doc_id"]: r["text"] for r in decontaminate.remove_contamination(d, b, c).collect()} for c in configs)
    assert one == many and 1 not in one
    assert one[2] == f"{say('z', 60)} {say('y', 60)}" and "c5 d0" in one[3]


def test_words_over_bytes():
    import re

    import pyarrow as pa

    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "B", "é", " ", "\n", "\t", "-", "中", "7"]) for _ in range(rng.randrange(30))) for _ in range(300)] + [None, ""]
    for limit in (1, 64, 1 << 20):
        seen = []
        for piece in pieces(pa.array(texts), limit):
            for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
                starts, ends, offsets = piece.words(table)
                for r in range(piece.rows):
                    text = (texts[piece.first + r] or "") if table is SPACED else (texts[piece.first + r] or "").lower()
                    got = [piece.data[a:b].tobytes().decode() for a, b in zip(starts[offsets[r] : offsets[r + 1]], ends[offsets[r] : offsets[r + 1]])]
                    assert [g if table is SPACED else g.lower() for g in got] == re.findall(pattern, text)
            seen += range(piece.first, piece.first + piece.rows)
        assert seen == list(range(len(texts)))
    piece = next(pieces(pa.array(["the The tHe then"])))
    starts, ends, _ = piece.words(SPACED)
    h = piece.hashes(starts, ends)
    assert h[0] == h[1] == h[2] != h[3]
    assert len(set(piece.hashes(starts, ends, lower=False).tolist())) == 4
    assert len(shingles(h, 2)) == 2 and len(shingles(h[:1], 2)) == 1 and len(shingles(h[:0], 2)) == 0


def test_all_queries_are_complete_and_consistent(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
    F.lit(1)
