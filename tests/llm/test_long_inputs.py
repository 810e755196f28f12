"""Work in proportion to the text: repetitive items, long texts full of matches, repeated clauses."""

import random
import time

from papyrion.llm import decontaminate, toxicity


def plain_hits(items, words, window):
    hit, found = set(), set()
    for name, seq in items:
        n = min(window, len(seq))
        starts = {tuple(seq[i : i + n]) for i in range(len(seq) - n + 1)} if seq else set()
        for i in range(len(words) - n + 1):
            if seq and tuple(words[i : i + n]) in starts:
                hit |= set(range(i, i + n))
                found.add(name)
    return hit, found


def scanned(items, text, window):
    machine = decontaminate.SuffixAutomaton(items, window)
    import pyarrow as pa

    (piece,) = decontaminate.pieces(pa.array([text]))
    ((_, _, n, mask, found),) = decontaminate.hits(piece, machine)
    return n, mask, {machine.ids[i] for i in found}


def test_windows_equal_plain_loops():
    rng = random.Random(6)
    for _ in range(60):
        word = lambda: rng.choice("ab" if rng.random() < 0.7 else "abcd")
        items = [(str(k), [word() for _ in range(rng.randrange(9))]) for k in range(5)]
        words = [word() for _ in range(40)]
        hit, found = plain_hits(items, words, 4)
        n, mask, got = scanned(items, " ".join(words), 4)
        assert n == 40 and got == found and set(() if mask is None else mask.nonzero()[0].tolist()) == hit


def test_an_item_of_equal_words():
    n = 20_000
    began = time.process_time()
    count, mask, found = scanned([("1", ["a"] * n), ("2", ["a"] * 7), ("3", ["b", *["a"] * n])], " ".join(["a"] * n), 10)
    assert count == n and mask.all() and found == {"1", "2", "3"}
    assert time.process_time() - began < 5


def test_clauses_of_a_long_text():
    grammar = toxicity.ClauseGrammar({"zorg": 1.0})
    text = "tree zorg walks. " * 120_000 + "no end"
    began = time.process_time()
    clauses = grammar.matched_clauses(text)
    assert len(clauses) == 120_000 and {c for c, _ in clauses} <= {"tree zorg walks", " tree zorg walks"}
    assert time.process_time() - began < 10
    # one clause with matches throughout, and separators of all kinds
    assert len(grammar.matched_clauses("zorg walks " * 50_000)) == 1
    assert [c for c, _ in grammar.matched_clauses("zorg: a zorg! no; you\nzorg? zorgx. x")] == ["zorg", " a zorg", "zorg", " zorgx"]


def test_scores_do_not_depend_on_which_counts_are_at_hand(spark):
    from papyrion.llm import lm_scoring

    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{min(int(rng.expovariate(0.1)), 50)}" for _ in range(30))) for i in range(40)], "doc_id long, text string")
    counts = lm_scoring.word_counts(docs).cache()
    scores = []
    for most in (4, 1000):
        config = lm_scoring.WindowLmConfig(min_count=2, known_count=2, most_words=3, most_known=most, rounds=2)
        vocabulary, model = lm_scoring.train(docs, config, counts=counts)
        assert vocabulary.config.size == 512 and (vocabulary.last is not None) == (most == 4)
        scores.append({r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score_documents(docs, vocabulary, model, counts=counts).collect()})
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-3 for i in scores[0])
