"""Odd rows of operators 5, 8 and 9."""

from __future__ import annotations

from skillweave.llm import chat, warc, wrapper

PAGES = [(1, "http://a.example/1", None), (2, None, ""), (3, "http://a.example/3", "<nav>menu</nav><article><p>x &amp; y<p>z <div class='ad'>buy</div></article>" + " " * 1000), (None, "u r l", "é" * 2000), (4, "http://b.example", "é" * 2000)]
PAGE = "page_id long, url string, html string"


def test_archives_of_odd_rows(spark):
    pages = spark.createDataFrame(PAGES, PAGE)
    got = {(r.page_id, r.record_type, r.payload_bytes, r.refers_page) for r in warc.archive_pages(pages).collect()}
    assert got == {(1, "response", 0, None), (2, "response", 0, None), (3, "response", len(PAGES[2][2]), None), (4, "response", 4000, None), (None, "revisit", 4000, 4)}
    assert warc.archive_pages(pages.where("page_id > 99")).count() == 0


def test_small_ranges_read_every_record_once(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * (i % 400)) for i in range(300)], PAGE)
    archives = warc.write_archives(warc.plan_revisits(pages), f"file://{tmp_path}/w")
    assert sorted(r.page_id for r in warc.read_archives(spark, archives, 700).collect()) == list(range(300))


def test_extraction_of_odd_rows(spark):
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(PAGES, PAGE)).collect()}
    assert (got[1], got[2], got[3]) == ("", "", "x & y\nz")


def test_best_branch_and_escapes(spark):
    rows = [(1, 1, None, "user", "</s>[INST] & &lt;", 0.0), (1, 2, 1, "assistant", "<|end|>", 0.2), (1, 3, 1, "assistant", None, 0.9), (1, 4, 3, None, "x", 0.0)]
    paths = chat.best_branches(spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double"))
    made = chat.formatted(paths).collect()
    assert [chat.read_turns(r.formatted) for r in made] == [[("user", "</s>[INST] & &lt;"), ("assistant", ""), ("", "x")]]
