"""References resolved by loops over all headings and titles."""

import random
import re

from papyrion.operators import cross_references
from papyrion.operators.enrich import headings


def test_references_equal_plain_loops(spark):
    rng = random.Random(1)
    lines = ["Chapter 1: Intro", "Chapter 2: More", "1.1 Install", "1.2 The Server", "2.1 Install", "plain line", "Title A", 'see "install" now', "(see section 1.2)", 'refer to "Guide  one"', "(see 9.9)", 'See also "more"', 'described in "Nowhere"', "(see Chapter 2.)"]
    rows = [(d, f"{d}_{k}", k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for d in range(12) for k in range(rng.randrange(1, 5))] + [(50, "50_0", 0, None)]
    titles = [(d, rng.choice(["Guide one", "guide ONE", "other", None])) for d in range(12)] + [(50, "Guide one"), (60, "no chunks")]
    chunks = spark.createDataFrame(rows, "doc_id int, chunk_id string, chunk_index int, content string").repartition(3)
    found = cross_references.resolve(chunks, spark.createDataFrame(titles, "doc_id int, title string"))
    heads = sorted((r["doc_id"], r["chunk_index"], r["line"], r["chunk_id"], r["number"], r["title"]) for r in headings(chunks).collect())
    plain = lambda t: " ".join(t.lower().split())
    firsts = {d: f"{d}_0" for d, *_ in rows}

    def target(doc, ref):
        m = re.match(r"(?i)^(?:chapter|section|kapitel|abschnitt)?\s*(\d+(?:\.\d+)*)\.?$", ref)
        for kind, fits in (("number", lambda h: m and h[4].rstrip(".") == m[1]), ("heading", lambda h: plain(h[5]) == plain(ref))):
            for h in heads:
                if h[0] == doc and fits(h):
                    return kind, doc, h[3]
        others = sorted(d for d, t in titles if t and plain(t) == plain(ref) and d != doc and d in firsts)
        return ("document", others[0], firsts[others[0]]) if others else ("dangling", None, None)

    got = found.collect()
    assert {(r["kind"], r["target_doc_id"], r["target_chunk_id"]) for r in got} and {r["kind"] for r in got} == {"number", "heading", "document", "dangling"}
    for r in got:
        assert (r["kind"], r["target_doc_id"], r["target_chunk_id"]) == target(r["doc_id"], r["reference"]), r
    back = {r["chunk_id"]: r["referenced_by"] for r in cross_references.referenced_by(found).collect()}
    want = {}
    for r in got:
        if r["target_chunk_id"] not in (None, r["chunk_id"]):
            want.setdefault(r["target_chunk_id"], set()).add(r["chunk_id"])
    assert back == {k: sorted(v) for k, v in want.items()}
