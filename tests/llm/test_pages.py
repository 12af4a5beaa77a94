import html
import re

from tests.llm.helpers import given, rows_of, with_clashing_columns

from tallyhouse.llm import pages


def page_rows(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(df):
    return {r["page_id"]: r["text"] for r in rows_of(pages.extract_main_text(df))}


def article_by_hand(page):
    """For the given pages: paragraphs and title of the article, cut by their own tags."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", body))
    blocks = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    df = given(spark, "pages")
    found = texts(df.repartition(4))
    expected = {r.page_id: article_by_hand(r.html) for r in df.collect()}
    assert found == expected
    assert all(r["n_chars"] == len(r["text"]) for r in rows_of(pages.extract_main_text(df)))


def test_structure_without_the_rest():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="ad-free">
    <header><h1>Site</h1></header><nav><ul><li>Menu</nav><div class="cookie-notice">Cookies</div>
    <main><article class="post"><header><h1>Head&shy;line &amp; more</h1></header><p>First <b>bold</b>&nbsp;text<br>goes
    on<script>var x = "<p>no</p>"</script><p title='a > b'>Second<!-- <p>gone</p> --> one</p>
    <form><input>Form</form><ul><li>Item<li>Item 2</ul><aside>Side</aside>
    <div id=comments><article><p>Reader says</article></div><p>Last &lt;tag&gt;</p></article></main>
    <footer>Foot</footer></body></html>"""
    assert pages.main_text(page, set()).split("\n\n") == [
        "Head\xadline & more", "First bold text goes on", "Second one", "Item", "Item 2", "Last <tag>",
    ]


def test_broken_markup_never_fails():
    for page in ("", "<", "<p", "a < b", "<!-- x", "<script>x", "</p></div>", '<a href="x>y', "<p class='x' <b>z", "&#xZZ; &", "<article>x"):
        pages.main_text(page, set())
    assert pages.main_text("plain text", set()) == "plain text"
    assert pages.main_text("<article>open <p>end", set()) == "open\n\nend"
    assert pages.main_text("<p " + "x='" * 50000, set()) is not None


def test_pages_without_an_article_lose_the_lines_of_their_nearest_page(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="5")
    frame = "<html><body><div>Welcome to us</div><div>{}</div><p>{}</p><div>All rights</div></body></html>"
    rows = [(k, f"http://h.example/a/{k:02d}?q=1", frame.format("Section", f"Own text {k}")) for k in range(30)]
    rows += [
        (100, "http://other.example/x", frame.format("Alone", "Keeps all")),
        (101, None, frame.format("No", "address")),
        (102, "http://h.example/b", None),
        (103, "not a url", ""),
        (104, "https://H.example/z", "<article><p>Welcome to us</p></article>"),
    ]
    found = texts(with_clashing_columns(page_rows(spark, rows)))
    assert [found[k] for k in range(30)] == [f"Own text {k}" for k in range(30)]
    assert found[100] == "Welcome to us\n\nAlone\n\nKeeps all\n\nAll rights" and "address" in found[101]
    assert found[102] == "" and found[103] == "" and found[104] == "Welcome to us"


def test_no_rows_and_repeats(spark):
    assert texts(page_rows(spark, [])) == {}
    twice = page_rows(spark, [(1, "http://a/b", "<p>x</p>")] * 2 + [(None, None, None)])
    assert sorted((r["page_id"] or 0, r["text"]) for r in rows_of(pages.extract_main_text(twice))) == [(0, ""), (1, "x"), (1, "x")]


def test_common_subsequence_is_longest():
    def length(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, best[j + 1] = best[j + 1], last + 1 if x == y else max(best[j + 1], best[j])
        return best[-1]

    import random

    rng = random.Random(4)
    for _ in range(300):
        a, b = [[rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2)]
        places = pages.common_subsequence(a, b)
        assert len(places) == length(a, b) and places == sorted(set(places))
        rest = iter(b)
        assert all(a[p] in rest for p in places)


def test_topics_of_an_article_are_no_marks():
    page = '<article><h2 id="social-history">Social history</h2><p>x</p><section class="related-work">y</section></article>'
    assert pages.main_text(page, set()) == "Social history\n\nx\n\ny"
    page = '<h2 id="cookies">Baking cookies</h2><p class="share-prices">Shares rose</p>'
    assert pages.main_text(page, set()) == "Baking cookies\n\nShares rose"
    assert pages.main_text(f"<article>{page}</article>", set()) == "Baking cookies\n\nShares rose"
    page = '<article><p>a</p><section id="cookies"><p>b</p></section><div class="adBanner1">c</div><div class="share-buttons">d</div>'
    assert pages.main_text(page + '<p class="notice">e</p><div id="comments">f</div></article>', set()) == "a\n\nb"
    page = '<main><article><p>a</p></article><article class="teaser">b</article><article class="comment"><p>c</p></article></main>'
    assert pages.main_text(page, set()) == "a"


def test_articles_lose_what_stands_in_plain_containers_of_their_nearest_page(spark):
    page = (
        "<article><h1>Title</h1><div>Read us daily</div><p>Said before</p><div><p>Own {0}</p><div>Note {0}</div></div>"
        "<section>More stories<ul><li>One</ul></section></article>"
    )
    rows = [(k, f"http://h.example/{k:02d}", page.format(k)) for k in range(20)]
    rows += [(k, f"http://copy.example/{k}", "<article><div>All the same</div></article>") for k in range(20, 22)]
    found = texts(page_rows(spark, rows))
    assert [found[k] for k in range(20)] == [f"Title\n\nSaid before\n\nOwn {k}\n\nNote {k}\n\nOne" for k in range(20)]
    assert found[20] == found[21] == "All the same"


def test_common_subsequence_of_large_and_repeated_lines(monkeypatch):
    n = 50_000
    assert len(set(pages.common_subsequence([1] * n, [2] + [1] * (n - 1) + [3]))) == n - 1
    a, b = [k % 2 for k in range(n)], [3, *[(k + 1) % 2 for k in range(n)]]
    places = pages.common_subsequence(a, b)
    rest = iter(b)
    assert len(places) == n - 1 and all(a[k] in rest for k in places)
    monkeypatch.setattr(pages, "TABLE_BITS", 8)
    test_common_subsequence_is_longest()


def test_very_long_pages(spark):
    row = "<div>same</div>"
    long = "".join(f"<p>{k}</p>{row}" for k in range(20_000))
    rows = [(1, "http://h.example/a", long), (2, "http://h.example/b", row * 20_000 + "<p>end</p>")]
    found = texts(page_rows(spark, rows))
    assert found[1] == "\n\n".join(map(str, range(20_000))) and found[2] == "end"
