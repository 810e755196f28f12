"""Locally consistent parsing against plain loops, its offsets, and the comparison of edited texts."""

import random
from hashlib import sha256

import numpy as np
import pytest

from papyrion.llm import fingerprints as fp
from papyrion.llm.fingerprints import FingerprintConfig

M = (1 << 64) - 1


def mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M
    return h ^ (h >> 31)


def plain_levels(text: bytes):
    """Names of each level, by loops over one text."""
    golden, symbols, out = 0x9E3779B97F4A7C15, [(b, mixed(b + 1)) for b in text], []
    while symbols and not (out and len(out[-1]) == 1):
        runs = []
        for coin, name in symbols:
            if runs and runs[-1][0] == coin:
                runs[-1][2] += 1
            else:
                runs.append([coin, name, 1])
        names = [mixed(name ^ (n * golden & M)) if n > 1 else name for _, name, n in runs]
        labels = [coin for coin, _, _ in runs]
        for _ in range(4):
            low = lambda a, b: ((a ^ b) & -(a ^ b)).bit_length() - 1
            labels = [2 * p + (b >> p & 1) for a, b in zip([~labels[0], *labels], labels) for p in [low(a, b)]]
        phrases = []
        for i, name in enumerate(names):
            if i == 0 or (i + 1 < len(names) and labels[i - 1] < labels[i] > labels[i + 1]):
                phrases.append([])
            phrases[-1].append(name)
        out.append([mixed(sum(x * (mixed((k + 1) * golden & M) | 1) for k, x in enumerate(p)) & M) for p in phrases])
        assert all(len(p) <= 11 for p in phrases)
        symbols = [(x, x) for x in out[-1]]
    return out


def plain(text: bytes, config=FingerprintConfig()):
    levels, seen, keys = plain_levels(text), {}, set()
    counted = [*(x for level in levels[config.level - 1 :] for x in level), *(level[0] for level in levels[: config.level - 1] if len(level) == 1)]
    for x in counted:
        x >>= 32
        n = seen[x] = seen.get(x, 0) + 1
        keys.add((x, n))
    return keys, counted


def texts():
    rng = random.Random(3)
    out = [b"", b"a", b"aaaaaaa", "ünï 日本語".encode(), b"abab" * 40, bytes(range(256))]
    return out + [bytes(rng.choice(b"abcde ") for _ in range(rng.randrange(400))) for _ in range(40)]


def test_levels_equal_plain_loops():
    rows = texts()
    data, row = np.frombuffer(b"".join(rows), np.uint8), np.repeat(np.arange(len(rows)), list(map(len, rows)))
    got = [[] for _ in rows]
    for names, at in fp.phrase_levels(data, row):
        for i in set(at.tolist()):
            got[i].append(names[at == i].tolist())
    assert got == [plain_levels(t) for t in rows]


def test_fingerprint_has_the_least_names():
    for text, found in zip(texts(), fp.fingerprints(texts())):
        keys, _ = plain(text)
        once = sorted(x for x, n in keys if n == 1)
        assert len(found) == min(len(keys), 64)
        assert set(x for x in once if len(found) < 64 or x <= found[-1]) <= set(found.tolist())
        assert (fp.from_text(fp.to_text(found)) == found).all()


@pytest.mark.parametrize("before", [b"", b"x", b"some other words, "])
def test_equal_substrings_have_equal_phrases_inside(before):
    rng = random.Random(8)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(3000))
    alone, moved = plain_levels(passage), plain_levels(before + passage + b" and an end")
    for level in (0, 1, 2, 3):
        inside = alone[level][8:-8]  # a few symbols at each end may differ
        assert any(moved[level][i : i + len(inside)] == inside for i in range(len(moved[level])))


def test_likeness():
    a, b = (np.array(x, np.uint32) for x in ([1, 2, 3, 4], [3, 4, 5, 6]))
    none = np.zeros(0, np.uint32)
    assert fp.likeness(a, b) == 2 / 6 and fp.likeness(a, a) == 1 and fp.likeness(none, none) == 1 and fp.likeness(none, a) == 0
    assert fp.likeness(a, b, 3) == 1 / 3  # 1, 2, 3 of both


def test_edited_texts_meet_the_next_row(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(200)))) for i in rng.sample(range(-500, 500), 150)]
    rows += [(700, None), (701, ""), (702, "日本語テキスト" * 30), (703, "long " * 100_000), (9, "twice"), (9, "twice"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, part string, carried string").repartition(7)
    config = FingerprintConfig(batch_bytes=2000)
    got = fp.compare_edited(docs, config).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want, own = [], fp.fingerprints([t.encode() for _, t in order], config)
    for k, (i, text) in enumerate(order):
        after, n = (k + 1) % len(order), len(text) // 3
        new = text[: len(text) - n] + order[after][1][:n]
        other = fp.fingerprints([new.encode()], config)[0]
        want.append((i, len(text), sha256(new.encode()).hexdigest(), fp.to_text(own[k]), fp.to_text(other), fp.likeness(own[k], other), fp.likeness(own[k], own[after])))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    long = [r for r in got if r["n_chars"] > 500]
    assert min(r["near_edited"] for r in long if r["doc_id"] < 700) > 0.3 > 0.1 > max(r["near_next"] for r in long)
    plain_map = {(r["doc_id"], r["fingerprint"]) for r in fp.fingerprint_documents(docs, config).collect()}
    assert plain_map == {(r["doc_id"], r["fingerprint"]) for r in got}


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    row = fp.compare_edited(docs).first()
    assert row["edited_sha256"] == sha256(b"abcdab").hexdigest() and row["near_next"] == 1
    assert fp.compare_edited(docs.limit(0)).count() == 0
