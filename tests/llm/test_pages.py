import random
import time
import tracemalloc

import pytest

from wordloom.llm import pages as module
from wordloom.llm.pages import extract_main_text, lines_of, main_text, shared

SHELL = "<html><head><title>t</title><style>p{}</style></head><body>{}</body></html>"


def page(inner):
    return SHELL.replace("{}", inner, 1) if "{}" in inner else SHELL.replace("<body>{}", "<body>" + inner)


def text_of(inner, other=None):
    return main_text(lines_of(page(inner)), other and lines_of(page(other)))


def test_article_without_what_surrounds_it():
    inner = (
        "<header>Site</header><nav><ul><li>Menu</ul></nav><div class='ad'>Buy</div>"
        "<article><h1>Title &amp; more</h1><p><b>One\n two.<br><p>Three<script>x('</p>')</script></p>"
        "<form><input>Sign up</form><div id=comments><p>Nice!</p></div></article>"
        "<aside>Side</aside><footer>&copy; us</footer>"
    )
    assert text_of(inner) == "Title & more\nOne two.\nThree"


def test_wrappers_do_not_drop_an_article():
    main = "<main><h1>Title</h1><p>Text</main>"
    for wrapper in (
        'div class="content-sidebar-wrap"', 'div class="layout with-sidebar"', 'div class="page no-sidebar"',
        'div class="overflow-hidden"', 'div style="overflow:hidden"', "div class=sidebar", 'div data-hidden="1"',
        "div aria-hidden='false'", "form id=aspnetForm", "header class=menu",
    ):
        end = wrapper.split()[0]
        for inner in (main, main.replace("main", "article")):
            assert text_of(f"<{wrapper}>{inner}</{end}><footer>us</footer>") == "Title\nText", wrapper
    for mark in ('class="overflow-hidden"', 'style="overflow:hidden"', 'class="with-sidebar"'):
        assert text_of(f"<article {mark}><p>Text</article>") == "Text"
        page = f"<html><body {mark}><article><p>Text</article></body></html>"
        assert main_text(lines_of(page), None) == "Text"


def test_names_and_hiding_inside_an_article():
    inner = "<article><p>Text<section class='related-work'><p>Related work</section>{}</article>"
    for beside in (
        "<div class='box ad'>Buy</div>", "<div class=ad-slot>Buy</div>", "<div id=related-posts>More</div>",
        "<div hidden>Gone</div>", "<div style='color:red; display: none'>Gone</div>", "<div hidden=hidden>Gone</div>",
        "<div id=comments><article>Nice!</article></div>",
    ):
        assert main_text(lines_of(inner.replace("{}", beside)), None) == "Text\nRelated work", beside
    shown = "<div hidden><article>Gone</article></div><article>Shown</article>"
    assert text_of(shown) == "Shown"


def test_shared_lines_go_unless_they_are_of_an_article():
    a = "<div>Home</div><div>Own text</div><div>Contact</div>"
    b = "<div>Home</div><div>Other text</div><div>Contact</div>"
    assert text_of(a, b) == "Own text"
    assert text_of(a) == "Home\nOwn text\nContact"
    article = "<article><p>Copied</p></article>"
    assert text_of(article, article) == "Copied"


def test_copies_without_an_article_keep_their_text(spark):
    inner = "<nav>Home</nav><div>Contact</div>" + "".join(f"<p>Paragraph {i} of the text</p>" for i in range(20))
    own = inner + "<p>Print</p>"
    want = "\n".join(["Contact", *(f"Paragraph {i} of the text" for i in range(20))])
    rows = [(1, "http://a.example/x", page(inner)), (2, "http://a.example/x;sid=1", page(inner))]
    rows += [(3, "http://a.example/x;sid=1/print", page(own))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert got == {1: want, 2: want, 3: want + "\nPrint"}


@pytest.mark.parametrize("bits", [1 << 27, 60, 3])
def test_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(module, "TABLE_BITS", bits)

    def length(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best = max(table[i][j + 1], table[i + 1][j])
                table[i + 1][j + 1] = max(best, table[i][j] + (x == y))
        return table[-1][-1]

    rng = random.Random(bits)
    cases = [("abcbdab", "bdcaba"), ("", "a"), ("aaaa", "aa"), ("xayb", "ab"), ("ab", "cd")]
    cases += [["".join(rng.choices("abc" + x, k=rng.randint(0, 25))) for x in "de"] for _ in range(150)]
    for a, b in cases:
        hits = shared(list(a), list(b))
        left = iter(b)
        assert all(x in left for x, hit in zip(a, hits) if hit)
        assert sum(hits) == length(a, b)


def test_pages_of_very_many_lines_in_bounded_memory():
    rng = random.Random(3)
    a, b = ([str(rng.randrange(3000)) for _ in range(60_000)] for _ in range(2))
    tracemalloc.start()
    assert 0 < sum(shared(a, b)) < 60_000
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()
    same = [f"line {i}" for i in range(200_000)]
    changed = [*same[:70_000], "own", *same[70_001:]]
    assert shared(changed, same).index(False) == 70_000 and sum(shared(changed, same)) == 199_999


@pytest.mark.parametrize(
    "bad", ["<a ", '<a "', "<!", "<a 'b", "<", "<div>", "</section>", '<p x="a>', "&amp", "<a b='c\" ", "<!--", "<b x>"]
)
def test_malformed_pages_take_linear_time(bad):
    began = time.process_time()
    lines_of(bad * (5_000_000 // len(bad)))
    lines_of("<div>" * 100_000 + "</section>" * 100_000)
    assert time.process_time() - began < 30


def test_tags_end_at_the_first_bracket_outside_quotes():
    assert [x[0] for x in lines_of('<p a="x>y" b=\'>\'>One</p><p "c>Two</p>')] == ["One", '<p "c>Two']
    assert [x[0] for x in lines_of('a <p x="1>b</p> c <p y="2">d</p>')] == ['a <p x="1>b', "c", "d"]
    assert [x[0] for x in lines_of("1 < 2 <3> <p>x")] == ["1 < 2 <3>", "x"]


@pytest.mark.parametrize(
    "name",
    [
        "comments-section", "comment-thread", "post-comments", "newsletter-signup", "ad-container", "sponsored-content",
        "cookie-consent", "related-content", "share-tools", "advert-top", "reader-comments", "article-comments",
        "social_links", "newsletter_box", "promo-block",
    ],
)
def test_names_that_mark_text_beside_the_article(name):
    inner = f"<article><p>Text</p><section class='x {name}'><p>Beside</p></section><p>More</p></article>"
    assert text_of(inner) == "Text\nMore"


@pytest.mark.parametrize(
    "name", ["related-work", "with-sidebar", "share-price", "ad-hoc", "social-science", "commentary", "content", "adverb"]
)
def test_names_that_mark_nothing(name):
    assert text_of(f"<article><p>Text</p><section class='{name}'><p>Own</p></section></article>") == "Text\nOwn"


def test_broken_and_empty_pages(spark):
    rows = [
        (1, "http://a.example/x?y", page("<article><p>One</article>")),
        (2, "http://a.example/x/2", "<article><p>Two"),
        (3, None, "no tags < at all"),
        (4, "not a url", None),
        (None, "http://b.example/", ""),
        (1, "http://a.example/x?y", page("<article><p>One</article>")),
        (6, "http://a.example/z", "<article><p>a<!-- hidden <p>-->b" + "<p>line" * 500),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = extract_main_text(pages.selectExpr("*", "1 AS _key", "2 AS _range", "'t' AS text"))
    texts = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()), key=repr)
    want = [(1, "One", 3), (1, "One", 3), (2, "Two", 3), (3, "no tags < at all", 16), (4, "", 0)]
    want += [(None, "", 0), (6, "ab" + "\nline" * 500, 2502)]
    assert texts == sorted(want, key=repr)
    assert extract_main_text(pages.limit(0)).count() == 0


def test_same_rows_in_any_number_of_ranges(spark):
    rows = [(i, f"http://h{i % 3}.example/{i % 7}/{i}", page(f"<div>Menu</div><p>text {i}</p>")) for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = []
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(tuple, extract_main_text(pages).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] == found[2]
    assert all(text == f"text {i}" for i, _, text, _ in found[0])
