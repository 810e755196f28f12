"""Set logic of the store, incremental state, graph, files and the whole run."""

import pytest
from pyspark.sql import functions as F

from papyrion.config import ExtractionConfig, PipelineConfig, from_mapping
from papyrion.operators import graph, incremental, store, vector
from papyrion.plans import pipeline
from papyrion.sources import files
from papyrion.streaming import ingest


def test_upsert_replaces_whole_keys(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id int, v string")
    new = spark.createDataFrame([(1, "x"), (3, "y")], "doc_id int, v string")
    assert sorted(map(tuple, store.upsert(old, new).collect())) == [(1, "x"), (2, "c"), (3, "y")]


def test_plan_statuses(spark):
    listing = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file_key string, hash string")
    state = spark.createDataFrame([("b", "2"), ("c", "0"), ("d", "4")], "file_key string, hash string")
    assert {r[0]: r[1] for r in incremental.plan(listing, state).collect()} == {"a": "new", "b": "unchanged", "c": "modified", "d": "deleted"}


def test_empty_state(spark):
    row = incremental.statistics(spark.createDataFrame([], incremental.STATE)).first()
    assert (row["total_files"], row["total_chunks"], row["avg_quality_score"]) == (0, 0, 0.0)
    with pytest.raises(ValueError):
        incremental.reset(spark.createDataFrame([], incremental.STATE))


def test_paths_and_clusters(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (5, 4)], "source_doc_id long, target_doc_id long")
    assert graph.shortest_path(edges, 1, 4) in ([1, 5, 4],)
    assert graph.shortest_path(edges, 1, 1) == [1]
    assert graph.shortest_path(edges, 4, 1) is None
    rows = [(i, "t", "x", ["a"], tags) for i, tags in ((1, ["p", "q"]), (2, ["p", "q"]), (3, ["q", "p"]), (4, ["z"]))]
    nodes = spark.createDataFrame(rows, "doc_id long, title string, doc_type string, authors array<string>, tags array<string>")
    assert [(r["leader"], r["members"]) for r in graph.clusters(nodes).collect()] == [(1, [1, 2, 3])]


def test_greedy_clusters_follow_the_order(spark):
    # 1-2 and 2-3 are similar, 1-3 are not: 2 joins 1, so 3 stays alone
    tags = {1: ["a", "b", "c"], 2: ["b", "c", "d"], 3: ["c", "d", "e"]}
    nodes = spark.createDataFrame([(i, "t", "x", ["n"], t) for i, t in tags.items()], "doc_id long, title string, doc_type string, authors array<string>, tags array<string>")
    assert [(r["leader"], r["members"]) for r in graph.clusters(nodes, 0.7).collect()] == [(1, [1, 2])]


def test_nearest_is_itself(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id long, embedding array<float>")
    q = v.select(F.col("vec_id").alias("query_id"), "embedding")
    first = vector.nearest_batch(v, q, 1, block_rows=2).collect()
    assert len(first) == 6 and all(r["query_id"] == r["vec_id"] and r["distance"] == 0 for r in first)
    assert vector.nearest(v, [2.0, 1.0], 1).first()["vec_id"] == 2


def test_extraction_cascade():
    assert files.order("text", "pdf") == ["text", "pdf", "pdfplumber", "pymupdf", "html"]
    assert not files.is_valid(["short"])
    assert files.is_valid(["a text that is long enough " * 10])


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for i in range(3):
        body = " ".join(f"The server number {j} keeps data for all users of the house." for j in range(60))
        (d / f"f{i}.pdf").write_text(f"User Manual\nAuthor: Ann Lee\nVersion 1.{i}\nChapter {i}: Basics\n{body}\n\nIn summary: done.")
    (d / "bad.pdf").write_text("x")
    (d / "note.txt").write_text("not listed")
    return d


def test_whole_run(spark, folder):
    config = PipelineConfig(extraction=ExtractionConfig(primary="text"), min_quality_score=50)
    out = pipeline.run(spark, str(folder), config=config)
    report = out.report.first()
    assert (report["total_files_processed"], report["successful"], report["failed"]) == (4, 3, 1)
    docs = {r["doc_id"]: r for r in out.tables["documents"].collect()}
    assert set(docs) == {"f0.pdf", "f1.pdf", "f2.pdf"} and docs["f1.pdf"]["version"] == "1.1"
    assert {r["author_name"] for r in out.tables["authors"].collect()} == {"Ann Lee"}
    # plans are lazy: keep the rows before the folder changes
    state = spark.createDataFrame(out.state.collect(), incremental.STATE)
    tables = {k: spark.createDataFrame(v.collect(), store.SCHEMAS[k]) for k, v in out.tables.items()}
    (folder / "f0.pdf").write_text((folder / "f0.pdf").read_text() + " More text.")
    (folder / "f2.pdf").unlink()
    again = pipeline.run(spark, str(folder), state, tables, config)
    assert {r["doc_id"] for r in again.results.collect()} == {"f0.pdf", "bad.pdf"}
    assert {r["doc_id"] for r in again.tables["documents"].collect()} == {"f0.pdf", "f1.pdf"}
    assert {r["file_key"] for r in again.state.collect()} == {"f0.pdf", "f1.pdf"}


def test_simple_profile(spark, folder):
    rows = pipeline.run_simple(spark, str(folder), size=100).collect()
    assert len({r["chunk_id"] for r in rows}) == len(rows) > 3


def test_stream_of_files(spark, folder, tmp_path):
    stream = ingest.new_files(spark, str(folder))
    q = ingest.ingest(stream, lambda b: files.extract_pages(b, "text"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select("doc_id").distinct().count() == 4


def test_config_names():
    c = from_mapping({"version": "2.0.0", "chunking": {"chunk_size": 50, "strategy": "fixed"}, "validation": {"min_quality_score": 70}, "extraction": {"pdf": {"primary_method": "text"}}})
    assert (c.version, c.chunking.size, c.chunking.strategy, c.min_quality_score, c.extraction.primary) == ("2.0.0", 50, "fixed", 70, "text")


def test_topics_query_follows_the_table(spark, tmp_path):
    from papyrion.plans import catalog

    words = [f"w{i:03d}" for i in range(400)]
    # the last 100 words are the rarest of 400, and the only ones of the last documents
    texts = [" ".join(words[:300])] * 2 + [" ".join(words[300 + 5 * i : 305 + 5 * i]) for i in range(20)] + [" ".join(words[15 * i : 15 * i + 15]) for i in range(20)] * 9
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.QUERIES["tfidf_kmeans"](spark, str(tmp_path)).collect()
    assert len(found) > 4 and sum(r["documents"] for r in found) == len(texts)
    assert any(w >= "w300" for r in found for w in r["top_terms"].split(","))


def test_similar_pairs_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    rows = []
    for i in range(150):
        tags = rng.sample([f"t{k}" for k in range(9)], rng.randrange(5)) + ["all"] * rng.randrange(2)
        rows.append((i, rng.choice("xyz"), rng.sample(["a", "b", "c"], rng.randrange(3)), tags if i else None))
    nodes = spark.createDataFrame(rows, "doc_id long, doc_type string, authors array<string>, tags array<string>")

    def jaccard(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a and b else 0.0

    for least in (0.55, 0.6, 0.75, 0.9):
        want = set()
        for i, kind, authors, tags in rows:
            for j, kind2, authors2, tags2 in rows[:i]:
                score = 0.5 * jaccard(tags or [], tags2 or []) + 0.3 * (kind == kind2) + 0.2 * jaccard(authors, authors2)
                if score >= least + 1e-9 or abs(score - least) < 1e-9:
                    want.add((j, i, round(score, 6)))
        got = {(r["doc_id"], r["other_id"], round(r["similarity"], 6)) for r in graph.similar_pairs(nodes, least).collect()}
        assert {x for x in got ^ want if abs(x[2] - least) > 1e-6} == set()
    with pytest.raises(ValueError):
        graph.similar_pairs(nodes, 0.5)


def test_clusters_against_the_loop(spark):
    import random

    rng = random.Random(4)
    rows = [(i, "x", ["a"], rng.sample("pqrs", rng.randrange(1, 4))) for i in range(60)]
    nodes = spark.createDataFrame(rows, "doc_id long, doc_type string, authors array<string>, tags array<string>")
    alike = {(r["doc_id"], r["other_id"]) for r in graph.similar_pairs(nodes, 0.8).collect()}
    free, want = set(range(60)), []
    for i in range(60):
        if i in free:
            members = [i] + [j for j in range(i + 1, 60) if j in free and (i, j) in alike]
            free -= set(members)
            if len(members) > 1:
                want.append((i, members))
    assert sorted((r["leader"], r["members"]) for r in graph.clusters(nodes, 0.8).collect()) == want


def test_related_chunks_against_all_pairs(spark):
    import random

    from papyrion.functions import chunk_text
    from papyrion.operators import enrich

    rng = random.Random(5)
    names = "Alpha Beta Gamma Delta Omega Sigma Kappa Zeta Theta".split()
    rows = [(d, f"{d}_{i}", i, " ".join(rng.sample(names, rng.randrange(8)))) for d in range(4) for i in range(15)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_id string, chunk_index int, content string")
    concepts = {r["chunk_id"]: set(r["c"]) for r in chunks.select("chunk_id", chunk_text.key_concepts("content").alias("c")).collect()}
    want = {(a[1], b[1], len(concepts[a[1]] & concepts[b[1]])) for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and len(concepts[a[1]] & concepts[b[1]]) >= 3}
    got = [(r["chunk_id"], r["related_id"], r["strength"]) for r in enrich.related_chunks(chunks).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_pages_of_chunks(spark):
    from papyrion.operators import chunking

    texts = ["Chapter 1: One\n" + "first words here. " * 20, "1.1 Two\n" + "second words there. " * 20, "third " * 30]
    pages = spark.createDataFrame([("d", i, t) for i, t in enumerate(texts, 1)], "doc_id string, page_number int, content string")
    joined = pages.groupBy("doc_id").agg(F.array_join(F.collect_list("content"), "\n\n").alias("content"))
    found = {r["content"][:9]: r["page_numbers"] for r in chunking.chunk_pages(pages, joined).collect()}
    assert found["Chapter 1"] == [1] and found["1.1 Two\ns"] == [2, 3]
    fixed = chunking.chunk_pages(pages, joined, chunking.ChunkingConfig(strategy="fixed", size=50, overlap=0)).orderBy("chunk_index").collect()
    assert [r["page_numbers"] for r in fixed] == [[1], [1, 2], [2, 3]]
    semantic = chunking.chunk_pages(pages, joined, chunking.ChunkingConfig(strategy="semantic"))
    assert [r["page_numbers"] for r in semantic.orderBy("chunk_index").collect()] == [[1], [2], [3]]


def test_state_goes_to_disk_and_back(spark, tmp_path):
    folder = str(tmp_path / "state")
    state, values = incremental.load_state(spark, folder)
    assert state.count() == 0 and incremental.get_value(values, "version", "none") == "none"
    state = spark.createDataFrame([("a.pdf", "h", "a.pdf", None, 3, 1.0, 60.0, 10, None)], incremental.STATE)
    values = incremental.update_value(incremental.update_value(values, "version", "1", "t0"), "version", "2", "t1")
    incremental.save_state(state, values, folder)
    state, values = incremental.load_state(spark, folder)
    assert state.count() == 1 and incremental.get_value(values, "version") == "2" and incremental.get_value(values, "last_updated") == "t1"
    report = incremental.inc_report(state, state.limit(0), "2").first()
    assert report["processed_files_count"] == 1 and report["deleted_files_pending"] == 0 and "a.pdf" in report["low_quality_files"]
    assert set(incremental.history(state, values)) == {"pipeline_state", "processed_files", "statistics"}
    values = incremental.update_value(values, "version", "3", "t2")  # a change of what was loaded goes to the same folder
    incremental.save_state(state, values, folder)
    state, values = incremental.load_state(spark, folder)
    assert state.count() == 1 and incremental.get_value(values, "version") == "3"


def test_a_save_that_is_cut_off_loses_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "state")
    state = spark.createDataFrame([("a.pdf", "h", "a.pdf", None, 3, 1.0, 60.0, 10, None)], incremental.STATE)
    values = spark.createDataFrame([("k", "1")], incremental.VALUES)
    assert incremental.save_state(state, values, folder) == 1
    broken = values.select("key", F.raise_error(F.lit("killed")).cast("string").alias("value"))
    with pytest.raises(Exception, match="killed"):  # between the two tables
        incremental.save_state(state.limit(0), broken, folder)
    state, values = incremental.load_state(spark, folder)
    assert state.count() == 1 and incremental.get_value(values, "k") == "1"
    monkeypatch.setattr(incremental.shared, "write_text", lambda *_: 1 / 0)  # before the pointer moves
    with pytest.raises(ZeroDivisionError):
        incremental.save_state(state.limit(0), values, folder)
    monkeypatch.undo()
    assert incremental.load_state(spark, folder)[0].count() == 1
    assert incremental.save_state(state, values, folder) == 4
    assert sorted(p.name for p in (tmp_path / "state").glob("v*")) == ["v00000003", "v00000004"]
    for part in (tmp_path / "state" / "v00000004" / "processed").glob("part-*"):
        part.write_bytes(b"broken")
    with pytest.raises(Exception):  # a damaged version is not an empty one
        incremental.load_state(spark, folder)[0].count()


def test_pages_keep_their_numbers(spark):
    text = b"first page with enough text. " * 5 + b"\f  \f" + b"third page"
    rows = spark.createDataFrame([("a", bytearray(text)), ("b", bytearray(b"\xff\xfe"))], "file_key string, content binary")
    got = [(r["doc_id"], r["page_number"], r["extraction_failed"]) for r in files.extract_pages(rows, "pdfplumber", "text").orderBy("doc_id", "page_number").collect()]
    assert got == [("a", 1, False), ("a", 3, False), ("b", 1, True)]
    assert files.table_text([[["a", None], [1, "b"]], []]) == "\n\nTables:\na | \n1 | b\n" and files.table_text([]) == ""
    assert {"html", "text"} <= set(files.supported())
    info = files.file_info(rows.withColumn("size", F.lit(1).cast("long")).withColumn("modified", F.lit(None).cast("timestamp")))
    assert info.count() == 2


def test_vector_store_upkeep(spark, tmp_path):
    path = str(tmp_path / "vectors")
    rows = spark.createDataFrame([("c1", "t", "some words", [1.0]), ("c2", "t", "other words", None)], "chunk_id string, document_type string, content string, embedding array<float>")
    vector.write_vectors(rows, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and len(vector.chunk_by_id(stored, "c2").first()["embedding"]) == 64
    vector.reset(rows, path)
    assert spark.read.parquet(path).count() == 0


def test_batches_of_folders(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.pdf").write_text("Chapter 1: Intro\n" + f"The words of {name} stand here and are enough for a chunk. " * 30)
    batches = [(str(tmp_path / "one"), {}), (str(tmp_path / "two"), {"min_quality_score": 101.0})]
    got = [(r["folder"].rpartition("/")[2], r["status"], r["files"]) for r in pipeline.run_batch(spark, batches).collect()]
    assert got == [("one", "success", 1), ("two", "failed", 1)]


def test_batches_keep_chunks_vectors_and_tables(spark, tmp_path):
    target = str(tmp_path / "store")
    text = lambda name: "Chapter 1: Intro\n" + f"The words of {name} stand here and are enough for a chunk. " * 30
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.pdf").write_text(text(name))
    batches = [(str(tmp_path / "one"), {}), (str(tmp_path / "two"), {})]
    files = lambda: [r["files"] for r in pipeline.run_batch(spark, batches, target).collect()]
    assert files() == [1, 1]

    def held():
        chunks, vectors, tables = pipeline.load(spark, target)
        ids = lambda df: {r["doc_id"] for r in df.select("doc_id").distinct().collect()}
        assert chunks.count() == chunks.select("chunk_id").distinct().count() == vectors.count()
        return ids(chunks), ids(vectors), ids(tables["documents"]), {r["content"][:40] for r in chunks.where("chunk_index = 0").collect()}, tables["processing_history"].count()

    both = {"one.pdf", "two.pdf"}
    first = held()
    assert first[:3] == (both, both, both) and first[4] == 2
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("part-*.parquet")}
    (tmp_path / "two" / "two.pdf").write_text(text("TWO"))
    (tmp_path / "two" / "three.pdf").write_text(text("three"))
    assert files() == [0, 2]  # what did not change is not processed again
    second = held()
    assert second[0] == both | {"three.pdf"} and second[4] == 4
    ours = {p: t for p, t in written.items() if "chunks" in p.parts}
    kept = [p for p, t in ours.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert kept  # the bucket of the unchanged document was not written again
    (tmp_path / "one" / "one.pdf").unlink()
    assert [r["files"] for r in pipeline.run_batch(spark, batches[:1], target).collect()] == [0]
    assert held()[:3] == 3 * ({"two.pdf", "three.pdf"},)
    found = store.document_on_disk(spark, f"{target}/metadata", "three.pdf").collect()
    assert len(found) == 1 and found[0]["total_chunks"] > 0


def test_a_run_over_text_in_parts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    page = "Chapter 1: Intro\n" + "The words stand here and are enough for a chunk. " * 30
    (tmp_path / "in" / "a b.txt").write_text(f"{page}\f\f{page}")
    results = []
    for in_parts in (True, False):
        config = PipelineConfig(extraction=ExtractionConfig("*.txt", "text", None, in_parts))
        done = pipeline.run(spark, str(tmp_path / "in"), config=config, materialize=True)
        results.append(sorted((r["chunk_id"], r["content"], r["page_numbers"]) for r in done.chunks.select("chunk_id", "content", "page_numbers").collect()))
    assert results[0] == results[1] and len(results[0]) > 0


def test_a_mean_on_the_limit_of_a_grade_is_on_it_in_any_order(spark):
    from papyrion.operators import enrich

    # in doubles these means are 69.99999999999999, 80.00000000000001 and 90.00000000000001 in this order
    points = {70: [491, 493, 503, 473], 80: [618, 482, 580], 90: [611, 606, 635, 624, 674], 79: [552, 555, 552]}
    rows = [(k, p / 700 * 100) for k, of_doc in points.items() for p in of_doc]
    for given in (rows, rows[::-1]):
        got = {r["doc_id"]: r for r in enrich.document_quality(spark.createDataFrame(given, "doc_id int, score double").coalesce(1), 70.0).collect()}
        assert [got[k]["overall_score"] for k in (70, 80, 90, 79)] == [70.0, 80.0, 90.0, 79.0]
        assert [got[k]["grade"] for k in (70, 80, 90, 79)] == ["Acceptable", "Good", "Excellent", "Acceptable"] and got[70]["accepted"]
