import math
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from codexflow import api
from codexflow.operators import audits, bindings, harvest, harvest_plan, profiling, retrieval, structure
from codexflow.sources import readers, writers
from codexflow.sources.oai import OaiPages
from codexflow.streaming import watch

# --- retrieval --------------------------------------------------------------------------------------------------------

CORPUS = [
    (1, "Rivers", "The river ran cold past Café Noir and the old mill.", 1), (2, None, "A mill stands by a river; the river turns its wheel, the wheel grinds.", 2), (3, "Mill mill mill", "Nothing to see in this one at all.", 1),
    (4, "Stars", "Cold stars over the harbour", 3), (5, "量子", "量子計算 is studied here by the river", 4), (6, "Stars", "cold cold cold stars and moon", 3),
]


def chunk_frame(spark):
    rows = [(k, t, b, f"d{k % 3}", p, "cc-by" if k % 2 else None, "body") for k, t, b, p in CORPUS]
    return spark.createDataFrame(rows, "chunk_id long, title string, body string, document_id string, page_start int, license string, content_role string").withColumn("page_end", F.col("page_start"))


def full_text_scores(query):
    """The same ranking by the full-text index of the standard library."""
    db = sqlite3.connect(":memory:")
    db.execute('CREATE VIRTUAL TABLE s USING fts5(title, body, terms, tokenize="unicode61")')
    for k, title, body, _ in CORPUS:
        pairs = "量子 子計 計算 is studied here by the river" if k == 5 else ""
        db.execute("INSERT INTO s(rowid, title, body, terms) VALUES (?, ?, ?, ?)", (k, title or retrieval.UNTITLED, body, pairs))
    match = "{body terms} : (" + " OR ".join(f'"{t}"' for t in query) + ")"
    return {k: -s for k, s in db.execute("SELECT rowid, bm25(s, 2.0, 1.0, 0.2) FROM s WHERE s MATCH ?", (match,))}


@pytest.mark.parametrize("query", [["river"], ["mill", "cold"], ["cafe", "noir"], ["the"], ["量子"], ["absent"], ["stars", "wheel", "the", "moon"]])
def test_scores_equal_the_full_text_index(spark, query):
    got = {r.chunk_id: r.score for r in retrieval.scores(chunk_frame(spark), query).collect()}
    want = full_text_scores(query)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in got)


def test_search(spark):
    chunks = chunk_frame(spark)
    hits = retrieval.search(chunks, 'a "river" OR mill', 5).orderBy("rank").collect()
    assert hits[0].chunk_id == 2 and [h["rank"] for h in hits] == list(range(1, len(hits) + 1)) and 3 not in {h.chunk_id for h in hits}
    assert "[river;]" in hits[0].excerpt
    assert len({(h.document_id, h.page_start) for h in retrieval.search(chunks, "cold stars").collect()}) == retrieval.search(chunks, "cold stars").count()
    assert retrieval.search(chunks, "river", license="unknown").count() == 1 and retrieval.search(chunks, "river", license="cc0").count() == 0
    assert retrieval.search(chunks, "river", role="references").count() == 0 and retrieval.search(chunks, "?! ...").count() == 0
    assert "Evidence for: river" in retrieval.render("river", retrieval.search(chunks, "river"))
    for bad in (0, 101):
        with pytest.raises(ValueError):
            retrieval.search(chunks, "river", bad)


def test_sharp_s_matches_both_ways(spark):
    chunks = spark.createDataFrame([(1, None, "große Straße", "d", 1, 1)], "chunk_id long, title string, body string, document_id string, page_start int, page_end int")
    assert retrieval.search(chunks, "grosse").count() == retrieval.search(chunks, "GROSSE straße").count() == 1
    assert retrieval.scores(chunks, ["große"], parity=True).count() == 1 and retrieval.scores(chunks, ["grosse"], parity=True).count() == 0


def test_versions_and_receipt(spark):
    docs = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p")], "document_id string, profile string")
    with pytest.raises(ValueError):
        retrieval.guard_versions(docs)
    assert retrieval.guard_versions(docs.where("profile = 'p'")).count() == 2 and audits.versions(docs).count() == 1
    rows = spark.createDataFrame([("a", 1, [], "x"), ("a", None, [], "x"), ("b", 0, [], "x"), ("b", 1, ["low_text_page"], "x"), ("b", 2, None, " ")], "document_id string, page_start int, quality_flags array<string>, body string")
    assert tuple(retrieval.index_receipt(rows).first()) == (2, 1, 4)


# --- profiling --------------------------------------------------------------------------------------------------------


def test_bins_and_histogram(spark):
    m = profiling.MIB
    files = spark.createDataFrame([(0,), (m - 1,), (m,), (1024 * m,), (600 * m,)], "size long")
    got = {r.bin: (r.files, r.bytes) for r in profiling.histogram(files, "size").collect()}
    assert got["<1 MiB"] == (2, m - 1) and got["<5 MiB"] == (1, m) and got[">=1024 MiB"][0] == 1 and got["<20 MiB"] == (0, 0) and len(got) == 7


def test_allocation_and_estimates(spark):
    bins = spark.createDataFrame([("<1 MiB", 10_000, 5 * 10**9), (">=1024 MiB", 20, 3 * 10**10), ("<5 MiB", 0, 0)], "bin string, files long, bytes long")
    quota = {r.bin: r.quota for r in profiling.allocate(bins, 60).collect()}
    assert quota == {"<1 MiB": 9, ">=1024 MiB": 20}
    sample = spark.createDataFrame([("<1 MiB", "a", 500_000)] * 8 + [(">=1024 MiB", "b", 1_500_000_000)] * 20, "bin string, category string, bytes long")
    got = {r.category: r for r in profiling.stratified_estimates(sample, bins).collect()}
    assert got["b"].estimated_bytes == 3 * 10**10 and got["b"].ci95_bytes == 0 and got["a"].estimated_bytes == 5 * 10**9 and got["a"].ci95_bytes == 0
    mixed = sample.unionByName(spark.createDataFrame([("<1 MiB", "b", 500_000)] * 8, sample.schema))
    assert {r.category: r.ci95_bytes > 0 for r in profiling.stratified_estimates(mixed, bins).collect()} == {"a": True, "b": True}
    strata = {r.bin: (r.censused, r.insufficient) for r in profiling.strata(sample, bins).collect()}
    assert strata == {"<1 MiB": (False, False), ">=1024 MiB": (True, False)}


def test_duplicates_and_samples(spark):
    files = spark.createDataFrame([("a", 5), ("a", 5), ("b", 7), (None, 9)], "h string, size long")
    assert tuple(profiling.duplicate_summary(files, "h", "size").first()) == (1, 1, 5, 3)
    assert tuple(profiling.duplicate_summary(files.where("h IS NULL"), "h", "size").first()) == (None, None, None, 0)
    many = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "x").otherwise("y").alias("bin"))
    quotas = spark.createDataFrame([("x", 7, 100), ("y", 11, 900)], "bin string, quota long, files long")
    first = {(r.k, r.bin) for r in profiling.stratified_sample(many, quotas, "k").collect()}
    assert len(first) == 18 and first == {(r.k, r.bin) for r in profiling.stratified_sample(many.repartition(5), quotas, "k").collect()}
    assert profiling.uniform_sample(many, "k", 9).count() == 9


def test_page_plans(spark):
    counts = spark.createDataFrame([(1,), (10,), (300,), (5000,)], "n int")
    plan = profiling.page_count_plan(F.col("n"))
    rows = counts.select("n", plan.alias("p"), profiling.page_indices(F.col("n"), plan).alias("i"), profiling.extra_indices(F.col("n"), profiling.page_indices(F.col("n"), plan)).alias("x")).collect()
    for r in rows:
        want = max(1, min(16, r.n, max(3, math.ceil(r.n**0.5 / 2))))
        assert r.p == want and r.i == sorted({round(i * (r.n - 1) / max(1, want - 1)) for i in range(want)})
        assert len(r.x) <= 4 and not set(r.x) & set(r.i)


def test_inspection(spark):
    pages = spark.createDataFrame([("a", 5, 1, 0), ("b", 5, 0, 1), ("c", 5, 0, 0), ("d", 5, 0, 0), ("d", 50, 0, 0), ("e", 50, 0, 0)], "document_id string, alnum_chars int, images int, forms int")
    got = {r.document_id: r.category for r in profiling.inspect(pages).collect()}
    assert got == {"a": "low_text_image_candidate", "b": "low_text_form_candidate", "c": "low_text_unknown", "d": "mixed_text_candidate", "e": "text_present"}
    dpi = spark.range(1).select(profiling.effective_dpi(F.lit(600), F.lit(72.0), F.lit(0.0), F.lit(1.0)), profiling.effective_dpi(F.lit(600), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()
    assert tuple(dpi) == (600.0, None)


# --- bindings and state -----------------------------------------------------------------------------------------------


def test_manifest_from_lines(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text(
        '{"uuid": "u1", "title": "T", "rights": ["All rights reserved"], "downloaded_files": [{"name": "a:b.pdf", "path": "x/u1/a_b.pdf", "download_status": "downloaded", "sizeBytes": 5}]}\n\n'
        '{"pdf_path": "z.pdf", "size_bytes": 6}\n{"pdf_path": "../z.pdf", "size_bytes": 5}\nnot json\n[1]\n{"pdf_path": "ok.pdf", "license": "cc0", "rights": "x", "year": "2001-05"}\n'
    )
    inventory = spark.createDataFrame([("u1/a_b.pdf", 5), ("z.pdf", 5), ("ok.pdf", 1)], "relative string, size long")
    linked, summary = api.link(spark, str(path), inventory)
    got = {r.relative: (r.line, r.license, r.year) for r in linked.collect()}
    assert got == {"u1/a_b.pdf": (1, "all-rights-reserved", None), "ok.pdf": (7, "cc0", "2001")}
    assert tuple(summary.first()) == (2, 1, 4)


def test_download_errors(spark):
    entry = "struct<name:string,path:string,download_status:string,sizeBytes:long,content_url:string>"
    rows = spark.createDataFrame(
        [(1, "u", [("f.pdf", "u/g.pdf", "downloaded", 5, None)]), (2, "v", [("f.pdf", None, "failed", 5, None)]), (3, "w", [("f.pdf", None, "downloaded", None, None)]), (4, "x", [("f.pdf", None, "downloaded", 6, None)])],
        f"line int, uuid string, downloaded_files array<{entry}>",
    )
    inventory = spark.createDataFrame([(p, 5) for p in ("u/f.pdf", "u/g.pdf", "v/f.pdf", "w/f.pdf", "x/f.pdf")], "relative string, size long")
    assert {r.line: r.error for r in bindings.bind_downloads(rows, inventory).collect()} == {1: "ambiguous file names", 3: "missing size", 4: "size mismatch"}


def test_state_tables(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "path string, line int, v string")
    assert {r.v for r in bindings.latest(rows, ["path"], [F.desc("line")]).collect()} == {"y", "z"}
    sources = spark.createDataFrame([("p", "1"), ("q", "1")], "path string, fingerprint string")
    files = spark.createDataFrame([("p", "1"), ("q", "2"), ("r", "1")], "path string, fingerprint string")
    assert {r.path for r in bindings.uncached(files, sources).collect()} == {"q", "r"}
    links = sources.withColumn("license", F.lit("cc0"))
    assert {r.path: r.error for r in bindings.bound(files, links).collect()} == {"p": None, "q": "file changed since it was bound", "r": "no binding"}
    manifests = spark.createDataFrame([("d", "p", {"a": "1", "b": "2"}), ("e", "p", {"a": "1"}), ("f", "p", {"a": "1", "b": "9"})], "document_id string, profile string, files map<string,string>")
    stored = spark.createDataFrame([(d, "p", n, s) for d in "def" for n, s in (("a", "1"), ("b", "2"))], "document_id string, profile string, name string, sha256 string")
    assert [r.document_id for r in bindings.valid_bundles(manifests, stored, ["a", "b"]).collect()] == ["d"]
    assert bindings.keep_newest(spark.createDataFrame([(k, k % 3) for k in range(9)], "generation int, created_at int"), 2).count() == 2


# --- harvest ----------------------------------------------------------------------------------------------------------

OAI = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>i1</identifier><datestamp>2020-01-01</datestamp><setSpec>theses</setSpec></header><metadata><dim:dim xmlns:dim="x"><dim:field mdschema="dc" element="title">A &amp;amp; B</dim:field>
<dim:field mdschema="dc" element="contributor" qualifier="author">Bee</dim:field><dim:field mdschema="dc" element="date" qualifier="issued">2001</dim:field><dim:field mdschema="dc" element="rights" qualifier="uri">http://creativecommons.org/licenses/by/4.0/</dim:field>
<dim:field mdschema="dc" element="identifier" qualifier="uri">hdl:1</dim:field><dim:field mdschema="dc" element="identifier">https://x/1</dim:field></dim:dim></metadata></record>
<record><header status="deleted"><identifier>i2</identifier><datestamp>2020-01-02</datestamp></header></record><resumptionToken>tok</resumptionToken></ListRecords></OAI-PMH>"""
PLAIN = '<oai xmlns="http://www.openarchives.org/OAI/2.0/"><record><header><identifier>j</identifier><datestamp>d</datestamp></header><metadata><r><title>T & U</title><creator>C</creator><name>PhD</name><rights>http://r</rights></r></metadata></record></oai>'


def test_oai_records(spark):
    pages = spark.createDataFrame([("r", "dim", OAI), ("r", "oai_dc", PLAIN), ("r", "oai_dc", "<x"), ("r", "oai_dc", '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><error code="badResumptionToken"/></OAI-PMH>')], "repo string, prefix string, xml string")
    raw = readers.oai_records(pages)
    assert {r.error for r in raw.collect()} == {None, "unreadable XML", "badResumptionToken"} and "tok" in {r.token for r in raw.collect()}
    got = {r.oai_identifier: r for r in harvest.normalise(raw.where("error IS NULL").drop("token", "error"), ["theses"]).collect()}
    a, b, c = got["i1"], got["i2"], got["j"]
    assert a.title == "A & B" and a.authors == ["Bee"] and a.is_thesis and a.licence_class == "cc-by" and a.landing_url == "https://x/1" and a.identifiers == ["hdl:1", "https://x/1"]
    assert b.deleted and not b.is_thesis and b.title is None
    assert c.title == "T & U" and c.authors == ["C", "PhD"] and c.qualification == "PhD" and c.level == "doctoral" and c.rights_uri == ["http://r"]


def test_oai_source(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k:06d}.xml").write_text(OAI)
    spark.dataSource.register(OaiPages)
    assert spark.read.format("oai_pages").option("repo", "r").load(str(folder)).count() == 3
    stream = readers.oai_records(spark.readStream.format("oai_pages").option("repo", "r").option("prefix", "dim").option("pagesPerTrigger", 2).load(str(folder)))
    sink, check = str(tmp_path / "sink"), str(tmp_path / "check")
    for k in range(2):  # a second run resumes and adds nothing twice
        query = watch.append_new(stream.where("error IS NULL").drop("token", "error"), sink, f"{check}{k}")
        query.awaitTermination(90)
        assert query.exception() is None
        assert spark.read.parquet(sink).count() == 2


def test_windows_endpoints_and_registry(spark):
    earliest = spark.createDataFrame([("a", "2018-06-01"), ("b", None), ("c", "1700")], "repo string, earliest string")
    years = harvest.year_windows(earliest, 2019)
    assert years.where("repo = 'a'").count() == 2 and years.where("repo = 'b'").count() == years.where("repo = 'c'").count() == 120
    months = harvest.split_windows(years.where("repo = 'a' AND year(begin) = 2018"))
    assert months.count() == 12 and harvest.split_windows(months).count() == 365 and harvest.split_windows(harvest.split_windows(months)).count() == 0
    odd = spark.createDataFrame([("x", "2020-01-10", "2020-03-05")], "repo string, b string, e string").select("repo", F.to_date("b").alias("begin"), F.to_date("e").alias("end"))
    assert str(harvest.split_windows(odd).agg(F.max("end")).first()[0]) == "2020-03-31" and str(harvest.split_windows(odd, clamp=True).agg(F.max("end")).first()[0]) == "2020-03-05"
    registry = spark.createDataFrame([("r", ["https://h/oai", "https://h/x"], 1), ("s", ["http://g/oai"], 5)], "id string, oai array<string>, nobel int")
    assert [r.url for r in harvest.candidate_endpoints(registry, ["/oai", "/y"]).where("id = 'r'").orderBy("endpoint_no").collect()] == ["https://h/oai", "https://h/x", "https://h/y"]
    assert [r.id for r in harvest.ordered_registry(registry).collect()] == ["s", "r"] and harvest.ordered_registry(registry, ["r"]).count() == 1
    probes = spark.createDataFrame([("r", True), ("s", False)], "id string, ok boolean")
    assert [r.id for r in harvest.reachable(registry, probes).collect()] == ["r"]
    formats = spark.createDataFrame([(["oai_dc", "dim"],), (["x"],), (["qdc", "oai_dc"],)], "f array<string>")
    assert [r[0] for r in formats.select(harvest.chosen_prefix(F.col("f"))).collect()] == ["dim", "oai_dc", "qdc"]
    sets = spark.createDataFrame([("r", "t1", "Doctoral"), ("r", "t2", "Maps")], "id string, set_spec string, set_name string")
    assert harvest.thesis_sets(sets).first().thesis_sets == ["t1"]


PAGE = """<html><head><title>My Work — Site</title><meta name="citation_pdf_url" content="https://s/a.pdf"></head><body><script>var x="<p>no</p>";</script><b>Advisors:</b><i>Ann; Bob;Ann</i><p>Thesis Availability:</p><p>Public domain</p>
<h2>Abstract</h2><p>First &amp;amp; part.</p><p>Second.</p><h2>Files</h2><a href="/b.PDF">f</a><a href="https://creativecommons.org/licenses/by/4.0/">cc</a></body></html>"""


def test_html_records(spark):
    rows = spark.createDataFrame([("u", PAGE), ("v", None)], "url string, html string")
    got = {r.url: r for r in harvest.page_records(rows).collect()}
    r = got["u"]
    assert r.title == "My Work" and r.fields["advisors"] == ["Ann", "Bob"] and r.abstract == "First & part. Second." and r.file_urls == ["/b.PDF", "https://s/a.pdf"]
    assert r.access_guess == "open" and r.licence_class == "cc0/public-domain" and got["v"].title == ""
    maps = spark.createDataFrame([("<loc>https://s/12/</loc><loc>https://s/7</loc><loc>https://s/about/</loc><loc>https://s/12/</loc>",)], "text string")
    assert [x.id for x in harvest.sitemap_ids(maps).collect()] == ["7", "12"]


def test_catalogue(spark, tmp_path):
    rows = spark.createDataFrame([("kth", "1", "2001-01", None, ["A", "B"], [], "PhD", ["T"], [], None, "cc-by", "open"), ("x", "2", None, "1999", None, None, None, None, None, "master", None, None)], "repo string, oai_identifier string, date string, datestamp string, authors array<string>, advisors array<string>, qualification string, types array<string>, sets array<string>, level string, licence_class string, access_guess string")
    cat = harvest.catalogue(rows)
    assert [(r.year, r.level) for r in cat.orderBy("oai_identifier").collect()] == [("2001", "doctoral"), ("1999", "master")] and cat.first().source.startswith("DiVA")
    flat = harvest.flattened(cat)
    assert flat.where("repo = 'kth'").first().authors == "A | B" and flat.where("repo = 'x'").first().authors == ""
    assert harvest.people(cat).count() == 2 and {r.repo: r.cc for r in harvest.catalogue_counts(cat).collect()} == {"kth": 1, "x": 0}
    writers.write_catalogue(flat, cat, harvest.people(cat), str(tmp_path / "cat"))
    assert spark.read.option("header", True).csv(str(tmp_path / "cat/csv")).count() == 2
    assert "| kth |" in writers.report("Counts", harvest.catalogue_counts(cat), ["repo"])


def test_harvest_plans():
    years = (("2019-01-01", "2019-12-31"), ("2020-01-01", "2020-12-31"))
    plan = harvest_plan.Plan(years=years)
    plan = harvest_plan.after_page(plan, "t")
    assert plan.token == "t" and not plan.finished
    plan = harvest_plan.after_expiry(harvest_plan.after_expiry(plan))
    assert [w for w, _ in plan.todo] == list(years)
    plan = harvest_plan.after_page(plan, None)
    assert plan.done == (years[0],)
    for _ in range(3):
        plan = harvest_plan.after_expiry(plan)
    assert len(plan.todo) == 12 and plan.todo[1][0] == ("2020-02-01", "2020-02-29")
    plan = harvest_plan.after_failure(plan)
    assert plan.skipped == (("2020-01-01", "2020-01-31"),) and plan.skipped[0] not in plan.done
    assert len(harvest_plan.split(("2020-02-01", "2020-02-29"))) == 29 and harvest_plan.split(("2020-02-01", "2020-02-02")) == []
    assert harvest_plan.split(("2020-01-10", "2020-03-05"))[-1][1] == "2020-03-31" and harvest_plan.split(("2020-01-10", "2020-03-05"), True)[0][0] == "2020-01-10"
    assert harvest_plan.Plan(failures=6).finished and harvest_plan.Plan(pages=30_000).finished


def test_structure(spark):
    blocks = spark.createDataFrame([("d", 2, "b", [1, 2]), ("d", 1, "a", [1]), ("d", 3, "c", [])], "document_id string, item int, text string, pages array<int>")
    counts = spark.createDataFrame([("d", 3)], "document_id string, page_count int")
    assert [(r.page, r.text) for r in structure.page_texts(blocks, counts).orderBy("page").collect()] == [(1, "a\nb"), (2, "b"), (3, "")]


# --- corpus end to end ------------------------------------------------------------------------------------------------


def corpus_pages(spark):
    long = "Water and stone and more words than forty letters on this page. " * 3
    rows = [("/a.pdf", "f1", "A", 1, "1 Start\n" + long), ("/a.pdf", "f1", "A", 2, "References\n" + long), ("/b.pdf", "f1", "B", 1, "1 Start\n" + long + " References\n" + long), ("/copy.pdf", "f9", "A", 1, "1 Start\n" + long), ("/copy.pdf", "f9", "A", 2, "References\n" + long), ("/c.pdf", "f1", "C", 1, long), ("/c.pdf", "f1", "C", 2, "")]
    return spark.createDataFrame(rows, "path string, fingerprint string, document_id string, page int, text string")


def test_corpus_end_to_end(spark, tmp_path):
    corpus = str(tmp_path / "corpus")
    pages = corpus_pages(spark)
    meta = spark.createDataFrame([("A", "Title A", "cc-by", "en", "https://a")], "document_id string, title string, license string, language string, source_url string")
    assert {r.outcome: r.files for r in api.run(pages, corpus, metadata=meta).collect()} == {"added": 4}
    assert api.run(pages, corpus, metadata=meta).count() == 0  # all sources are known
    assert {(r.status, r.jobs) for r in api.status(spark, corpus).collect()} == {("ready", 2), ("needs_ocr", 1)}
    receipt = api.index(spark, corpus, str(tmp_path / "index")).first()
    assert receipt.documents == 2 and receipt.chunks >= 3
    hits = api.search(spark, str(tmp_path / "index"), "water stone").collect()
    assert {h.document_id for h in hits} == {"A", "B"} and next(h for h in hits if h.document_id == "A").original_path == "/a.pdf"
    assert api.search(spark, str(tmp_path / "index"), "water", role="references").count() >= 1
    assert api.export(spark, corpus, str(tmp_path / "e1"), licenses=["cc-by"])["rows"] == 1 and api.export(spark, corpus, str(tmp_path / "e2"), licenses=["cc0"])["rows"] == 0
    assert api.export(spark, corpus, str(tmp_path / "e3"), kind="chunks", format="jsonl", shard_rows=1)["rows"] >= 3
    with pytest.raises(Exception):
        api.export(spark, corpus, str(tmp_path / "e1"))
    assert [tuple(r)[:4] for r in api.dedup(spark, corpus).collect()] == [("A", "B", 0, True)]  # the same text but for spaces
    api.run(pages.where("document_id = 'B'").withColumn("fingerprint", F.lit("f2")), corpus, api.Config(profile_tag="other"))
    with pytest.raises(ValueError):
        api.dedup(spark, corpus)
    assert tuple(api.audit(pages).first())[:2] == (3, 7)


def test_limit_leaves_the_rest_for_later(spark, tmp_path):
    corpus = str(tmp_path / "c")
    first = {r.outcome: r.files for r in api.run(corpus_pages(spark), corpus, limit=1).collect()}
    assert first == {"added": 2, "waiting": 2}
    assert {r.outcome for r in api.run(corpus_pages(spark), corpus).collect()} == {"added"}
    assert api.Config(min_chars=41).profile != api.Config().profile


def test_shards_and_review(spark):
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit("x" * 10).alias("text")).repartition(2)
    got = writers.shards(rows, ["k"], most_rows=3, most_bytes=50).groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()
    assert all(r.n <= 5 and r.b <= 60 for r in got) and sum(r.n for r in got) == 20
    blocks = spark.createDataFrame([("formula", [2]), ("text", [2, 3])], "label string, pages array<int>")
    assert {r.label: r.blocks for r in writers.review(blocks, 2, 3).collect()} == {"formula": 1, "text": 1}
    for low, high in ((1, 1), (0, 2), (3, 2)):
        with pytest.raises(ValueError):
            writers.review(blocks, low, high)


def test_sidecars_and_pages(spark, tmp_path):
    raw = spark.createDataFrame([("a", '{"landing_url": "u", "repo": "r", "language": "", "authors": ["x"]}'), ("b", "[1]"), ("c", "{}")], "path string, json string")
    got = {r.path: r for r in readers.sidecars(raw).collect()}
    assert got["a"].source_url == "u" and got["a"].repository == "r" and got["a"].language == "und" and got["a"].language_method == "unknown" and got["a"].license == "unknown" and got["b"].error and not got["c"].error
    (tmp_path / "x.pdf.metadata.json").write_text('{"title": "T"}')
    (tmp_path / "x.pdf").write_bytes(b"1234")
    assert readers.read_sidecars(spark, str(tmp_path)).first().title == "T"
    files = readers.inventory(spark, str(tmp_path), hashed=True)
    assert files.count() == 1 and files.select(readers.relative_to(str(tmp_path), F.col("path"))).first()[0] == "x.pdf" and readers.inventory(spark, str(tmp_path), settled_before="2001-01-01T00:00:00").count() == 0
    docs = spark.createDataFrame([("d", "one\f\ftwo\r\n\0x\f "), ("e", None)], "id string, text string")
    assert [(r.document_id, r.page, r.text) for r in readers.pages_of(docs, "id", "text").orderBy("document_id", "page").collect()] == [("d", 1, "one"), ("d", 2, ""), ("d", 3, "two\nx"), ("e", 1, "")]


def test_watching_a_folder(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.txt").write_text("one")

    def process(files):
        return files.select("path", F.lit("done").alias("outcome"))

    ledger, check = str(tmp_path / "ledger"), str(tmp_path / "check")
    time.sleep(1.5)
    for name in ("b.txt", None):
        query = watch.watch(spark, str(root), ledger, check, process, settle=0)
        query.awaitTermination(90)
        assert query.exception() is None
        if name:
            (root / name).write_text("two")
            time.sleep(1.5)
    assert {r.outcome: r.files for r in watch.pass_summary(spark.read.parquet(ledger)).collect()} == {"done": 2}


def test_entry_and_registry(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60
    assert __spark_entry__.entry(spark).count() == 10
