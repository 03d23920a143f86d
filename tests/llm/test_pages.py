"""Page text: blocks, LCS against the textbook table, differencing, edge rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import prose

from ticketlens.llm import pages
from ticketlens.llm.pages import blocks, main_texts, shared_lines

SCHEMA = "page_id long, url string, html string, host string, path string, text string, row long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], SCHEMA)


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    mask = shared_lines(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    kept, rest = [x for x, m in zip(a, mask) if m], iter(b)
    assert len(kept) == lcs(a, b) and all(x in rest for x in kept)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40), st.integers(1, 60))
def test_shared_lines_in_parts_of_the_table(a, b, bits):
    kept_bits, pages.TABLE_BITS = pages.TABLE_BITS, bits
    try:
        mask = shared_lines(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    finally:
        pages.TABLE_BITS = kept_bits
    kept, rest = [x for x, m in zip(a, mask) if m], iter(b)
    assert len(kept) == lcs(a, b) and all(x in rest for x in kept)


def test_large_pages_in_another_order_take_bounded_memory():
    import tracemalloc

    rs = np.random.RandomState(0)
    a = rs.randint(0, 2**60, 20_000).astype(np.uint64)
    b = rs.permutation(a)
    tracemalloc.start()
    mask = shared_lines(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 200 < mask.sum() < 400  # about twice the root of the number of blocks
    assert peak < 60e6  # a whole table would take 50 MB, its rows of Python numbers twice that


def test_blocks():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a>m</a></nav><div class='ad'>buy</div>"
        "<script>var t='</p>';</script><article><h1>A &amp;amp; b</h1><p><b>One\n two<br>three<p>Four &eacute;&nbsp;x"
        "<div class='comments'><p>reader</div><ul><li>a<li>b</ul><form>f</form>tail<!-- <p>no --></article><footer>&copy;</footer>"
    )
    assert [t for k, t in blocks(page) if k in ("heading", "article")] == ["A &amp; b", "One two three", "Four é x", "a", "b", "tail"]
    assert {t for k, t in blocks(page) if k == "furniture"} == {"m", "buy", "reader", "f", "©"}


def test_capital_i_with_dot_before_a_script():
    """Its lower case is two characters, so places in a lower-cased copy would be off."""
    page = "<p>İİİ</p><SCRIPT>var a = '</p>';</Script><article><h1>Head</h1><p>Text İ</p></article><style>İ{}</STYLE><p>x"
    assert [b for b in blocks(page) if b[0] != "furniture"] == [("open", "İİİ"), ("heading", "Head"), ("article", "Text İ"), ("open", "x")]


def test_names_whose_parts_turn_their_meaning():
    for name in ("legal-text", "search-result", "ad-hoc", "form-factor", "comment-policy", "header-1", "notice-period", "share_price"):
        page = f"<article><p>One</p><div class='{name}'><p>Two</p></div><p id='{name}'>Three</p></article>"
        assert [t for k, t in blocks(page) if k == "article"] == ["One", "Two", "Three"], name
    for name in ("ad", "site-footer", "ad-slot", "nav-links", "cookie-banner", "comment-list", "page_sidebar", "menu-item-link", "social:share"):
        page = f"<article><p>One</p><div class='x {name}'><p>Two</p></div><p>Three</p></article>"
        assert [t for k, t in blocks(page) if k == "article"] == ["One", "Three"], name


def test_headers_inside_the_article():
    for header in ("<header>%s</header>", "<div class='article-header'>%s</div>", "<div id='header'>%s</div>"):
        page = "<header>Site</header><article>" + header % "<h1>Head</h1><p>By line</p><nav>menu</nav>" + "<p>Text</p></article>"
        assert [t for k, t in blocks(page) if k != "furniture"] == ["Head", "By line", "Text"]
        bare = "<article>" + header % "<p>Share this</p>" + "<h2>Later</h2><p>Text</p></article>"
        assert [t for k, t in blocks(bare) if k != "furniture"] == ["Later", "Text"]
    assert [t for k, t in blocks("<div class='header'><h1>Site</h1></div><p>x</p>") if k != "furniture"] == ["x"]
    assert [t for k, t in blocks("<article><header><p>never closed") if k != "furniture"] == []


def test_broken_markup_does_not_fail():
    for page in ("<", "<p", "a < b <p>c", "</p></div>x", "<script>never closed", "<!-- open", "<p class='x>y", "&#xZZ; &bogus; &#0;"):
        blocks(page)
    assert blocks("a < b<p>c") == [("open", "a < b"), ("open", "c")]


def test_pages_without_an_article_lose_what_neighbours_share(spark):
    site = "<div>Site of things</div><p>Read our rules</p>%s<p>All about us</p>"
    rows = [(i, f"https://h.example/en/{i}?x=1", site % f"<p>{prose(i, 12)}</p><p>{prose(50 + i, 9)}</p>") for i in range(9)]
    rows.append((100, "https://other.example/en/1", site % "<p>alone</p>"))
    got = texts(main_texts(frame(spark, rows)))
    for i in range(9):
        assert got[i] == f"{prose(i, 12)}\n{prose(50 + i, 9)}"
    assert got[100] == "Site of things\nRead our rules\nalone\nAll about us"  # nothing to compare with


def test_copies_of_a_page_and_marked_articles_keep_their_text(spark):
    page = f"<header>Top</header><main><p>{prose(1, 20)}</p></main><div>Bottom</div>"
    plain = f"<p>{prose(2, 20)}</p><p>{prose(3, 20)}</p>"
    rows = [(i, f"http://a.example/{i}", page) for i in range(3)] + [(10 + i, f"http://b.example/{i}", plain) for i in range(3)]
    got = texts(main_texts(frame(spark, rows)))
    assert {got[i] for i in range(3)} == {prose(1, 20)}
    assert {got[10 + i] for i in range(3)} == {f"{prose(2, 20)}\n{prose(3, 20)}"}


def test_articles_lose_what_the_site_repeats_in_them(spark):
    page = "<nav>m%d</nav><article><h1>%s</h1><p>%s</p><p>%s</p><p>Share this with friends</p><p>Read more</p></article>"
    own = {i: [prose(i, 5), prose(20 + i, 12), prose(40 + i, 9)] for i in range(6)}
    own[2] = own[1]  # the same article at two URLs
    own[4] = [own[4][0], own[3][1], own[4][2]]  # a paragraph that only one neighbour has
    rows = [(i, f"https://h.example/{i}", page % (i, *own[i])) for i in range(6)]
    got = texts(main_texts(frame(spark, rows)))
    assert got == {i: "\n".join(own[i]) for i in range(6)}


def test_article_paragraphs_stay_unless_most_pages_have_them(spark):
    """Two neighbours with a paragraph are no proof while most pages of the host lack it."""
    page = "<article><h1>%s</h1><p>%s</p><p>Les.</p><p>Subscribe now</p></article>"
    plain = "<article><h1>%s</h1><p>%s</p><p>Subscribe now</p></article>"
    rows = [(i, f"https://h.example/{i:02d}", (page if 4 <= i < 8 else plain) % (prose(i, 4), prose(30 + i, 12))) for i in range(12)]
    got = texts(main_texts(frame(spark, rows)))
    assert got == {i: "\n".join([prose(i, 4), prose(30 + i, 12)] + ["Les."] * (4 <= i < 8)) for i in range(12)}


def test_headings_stay_even_if_all_pages_have_them(spark):
    page = "<article><h1>Daily news</h1><p>%s</p><p>%s</p><p>%s</p><p>Usual</p></article>"
    rows = [(i, f"https://h.example/{i:02d}", page % (prose(i, 9), prose(30 + i, 12), prose(60 + i, 7))) for i in range(8)]
    got = texts(main_texts(frame(spark, rows)))
    assert got == {i: f"Daily news\n{prose(i, 9)}\n{prose(30 + i, 12)}\n{prose(60 + i, 7)}" for i in range(8)}


@pytest.mark.parametrize("bound", [pages.BROADCAST_BLOCKS, -1])
def test_ends_of_ranges_and_hot_copies(spark, monkeypatch, bound):
    """Tiny ranges, a page copied very often, usual blocks and decisions by broadcast and by a shuffle give what one range gives."""
    monkeypatch.setattr(pages, "BROADCAST_PAGES", bound)
    site = "<p>Site</p><article><h1>%s</h1><p>%s</p><p>Usual</p></article>"
    rows = [(i, f"https://h.example/{i:03d}", site % (prose(i, 3), prose(100 + i, 8))) for i in range(40)]
    rows += [(1000 + i, "https://h.example/020?c", rows[20][2]) for i in range(60)]
    rows += [(2000 + i, f"https://k.example/{i:03d}", f"<p>Top</p><p>{prose(i, 8)}</p>") for i in range(30)]
    want = {i: f"{prose(i, 3)}\n{prose(100 + i, 8)}" for i in range(40)} | {1000 + i: f"{prose(20, 3)}\n{prose(120, 8)}" for i in range(60)}
    want |= {2000 + i: prose(i, 8) for i in range(30)}
    monkeypatch.setattr(pages, "BROADCAST_BLOCKS", bound)
    for size in (10_000, 7, 2):
        monkeypatch.setattr(pages, "RANGE_PAGES", size)
        monkeypatch.setattr(pages, "hot_bound", lambda total: 5)
        assert texts(main_texts(frame(spark, rows))) == want


def test_extra_columns_of_any_name(spark):
    rows = [(i, f"https://h.example/{i}", f"<p>Same</p><p>{prose(i, 6)}</p>") for i in range(6)]
    names = "kinds hashes same key key2 copies range number place usual keep n_shared host path found first"
    wide = spark.createDataFrame([(*r, *["x"] * 16) for r in rows], ["page_id", "url", "html", *names.split()])
    got = main_texts(wide)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_shared"]
    assert texts(got) == {i: prose(i, 6) for i in range(6)}


def test_pages_that_nothing_changes_are_not_shuffled(spark):
    """Marked pages without a repeated block, of which some share a URL and html, are finished where they are."""
    from conftest import plan_text

    page = "<nav>%s</nav><article><h1>%s</h1><p>%s</p></article><p>open</p>"
    rows = [(i, f"https://h.example/{i}", page % (prose(i, 3), prose(20 + i, 3), prose(40 + i, 9))) for i in range(9)]
    got = main_texts(frame(spark, [*rows, rows[3], rows[3]]))
    assert "SortMergeJoin" not in plan_text(got) and "Exchange hashpartitioning" not in plan_text(got)
    assert texts(got) == {i: f"{prose(20 + i, 3)}\n{prose(40 + i, 9)}" for i in range(9)} and got.count() == 11


def test_no_single_partition(spark):
    from conftest import plan_text

    rows = [(i, f"https://h.example/{i}", f"<p>{prose(i, 6)}</p>") for i in range(6)]
    assert "SinglePartition" not in plan_text(main_texts(frame(spark, rows)), "formatted")


def test_every_copy_of_a_page_is_compared_with_the_nearest_other_page(spark):
    site = "<nav>n%d</nav><p>Site of things</p><p>%s</p><p>All about us</p>"
    rows = [(i, f"https://h.example/{i:02d}", site % (0, prose(i, 12))) for i in (0, 1, 30, 31)]
    # one page under many addresses, its menu not always the same
    rows += [(2 + i, f"https://h.example/02?{i}", site % (i % 3, prose(2, 12))) for i in range(20)]
    rows += [(25, "https://h.example/02?same", site % (0, prose(2, 12)))] * 2
    got = main_texts(frame(spark, rows)).collect()
    assert len(got) == 26
    want = {i: prose(i, 12) for i in (0, 1, 30, 31)}
    assert all(r["text"] == want.get(r["page_id"], prose(2, 12)) and r["n_shared"] == 2 for r in got)


def test_many_ranges_give_the_same(spark):
    site = "<p>shared</p>%s"
    rows = [(i, f"https://h.example/{i:03d}", site % f"<p>{prose(i, 8)}</p>") for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = texts(main_texts(frame(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: prose(i, 8) for i in range(60)}


def test_edge_rows(spark):
    long_page = "<article>" + "".join(f"<p>{prose(i, 30)}</p>" for i in range(2000)) + "</article>"
    rows = [(1, None, "<p>a"), (None, "u", "<p>b"), (3, "u", None), (4, "u", ""), (5, "u", long_page), (5, "u", long_page)]
    found = main_texts(frame(spark, rows)).collect()
    assert len(found) == 6
    by_id = {r["page_id"]: r for r in found}
    assert (by_id[1]["text"], by_id[1]["url"], by_id[None]["text"]) == ("a", None, "b")
    assert by_id[3]["text"] == by_id[4]["text"] == "" and by_id[3]["n_chars"] == 0
    assert by_id[5]["text"].count("\n") == 1999 and by_id[5]["n_chars"] == len(by_id[5]["text"])
    assert main_texts(frame(spark, [])).collect() == []
