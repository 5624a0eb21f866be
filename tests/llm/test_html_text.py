import html
import re

import pytest

from hiretide.llm.html_text import extract_text, main_text


def by_markup(page):
    """The blocks of the only article of a generated page."""
    begin = page.index("<article>") + 9
    end = page.find("</article>", begin)
    parts = re.split(r"</?(?:p|h1)>", page[begin:end if end >= 0 else None])
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(x for x in lines if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    texts = {r.page_id: r for r in extract_text(pages).collect()}
    for row in pages.collect():
        assert texts[row.page_id].text == by_markup(row.html)
        assert texts[row.page_id].n_chars == len(texts[row.page_id].text)


def test_boilerplate_inside_and_around_the_article_goes():
    page = ("<html><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><main>"
            "<header><h1>Title</h1></header><p>First &amp; second &eacute;<br>line"
            "<p>Third <a href=x>link</a> here<div class='ad'>Buy!</div><aside>side</aside>"
            "<form><input>mail</form><section class='comments'><p>me too</section>"
            "<div class='cookie-notice'>We use cookies</div><p>Last.</main><footer>x</footer>")
    assert main_text(page) == "Title\nFirst & second é line\nThird link here\nLast."


def test_rules_without_an_article():
    good = "This is the text of the page and it has many of the words that are in a text. " * 2
    page = (f"<div><a href=1>A</a> <a href=2>B</a></div><p>{good}</p><p>Short.</p>"
            "<p>" + "buy now cheap pills discount offer deal sale " * 3 + "</p>")
    assert main_text(page) == good.strip() + "\nShort."


def test_neighbours_decide_short_blocks():
    junk = "<p>" + "zzz yyy xxx www vvv uuu ttt sss rrr qqq " * 4 + "</p>"
    good = "<p>" + "it is the way that they were in the house and so on for a while. " * 3 + "</p>"
    assert "near good" in main_text(junk + good + "<p>near good</p>" + junk + junk)
    assert "near junk" not in main_text(good + junk + junk + "<p>near junk</p>" + junk)


@pytest.mark.parametrize("page", [
    None, "", "   ", "<p", "<p a=\"", "<!-- x", "<script>x<p>y", "</p></div>", "&#xZZ;&amp"])
def test_broken_pages_do_not_fail(page):
    assert main_text(page) in ("", "&#xZZ;&")


def test_linear_on_hostile_pages():
    for page in ('<a "' * 50_000, "<!--" * 50_000, "<div>" * 30_000, "<p>" * 30_000, "<" * 50_000):
        main_text(page)


def test_edges(spark):
    rows = [(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None), (2, "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in extract_text(pages).collect()) == [
        ("1", "x"), ("1", "x"), ("2", ""), ("None", "")]
    assert extract_text(pages.filter("1 = 0")).collect() == []


@pytest.mark.parametrize("entry, around", [
    ("<li><p>item {}", "ul"), ("<li><div><p>item {}</div>", "ul"), ("<tr><td>item {}<td>x", "table"),
    ("<tbody><tr><th>item {}<td><p>x", "table"), ("<dt>item {}<dd><p>x", "dl"),
    ("<li><span class=nav><p>item {}", "ol"), ("<li><div>item {}", "ul")])
def test_deep_menus_and_lists_end(entry, around):
    entries = "".join(entry.format(i) for i in range(300))
    good = "This is the text of the page and it has many of the words that are in a text. " * 2
    menu = f"<nav><{around}>{entries}</{around}></nav><article><p>{good}</article><p>{good}behind"
    assert main_text(menu) == good.strip()
    inside = f"<article><p>{good}<{around}>{entries}</{around}></article><p>{good}behind"
    assert main_text(inside).startswith(good.strip()) and "behind" not in main_text(inside)


def test_omitted_end_tags_close_their_own_list_alone():
    from hiretide.llm.html_text import _Reader

    def opened(page):
        reader = _Reader()
        for tag in page.split():
            reader.close(tag[1:]) if tag[0] == "/" else reader.start(tag, "")
        return [t for t, _ in reader.open]

    assert opened("ul li p li p li") == ["ul", "li"]
    assert opened("ul li ul li p li") == ["ul", "li", "ul", "li"]
    assert opened("ul li ul li p /ul li") == ["ul", "li"]
    assert opened("table tr td p tr td td") == ["table", "tr", "td"]
    assert opened("table tr td table tr td tr") == ["table", "tr", "td", "table", "tr"]
    assert opened("table thead tr th tbody tr td") == ["table", "tbody", "tr", "td"]
    assert opened("p p div") == ["div"] and opened("dl dt dd p dt") == ["dl", "dt"]
    assert opened("div " * 500 + "p /div /div") == ["div"] * 498


GOOD = "This is the text of the page and it has many of the words that are in a text. " * 2


@pytest.mark.parametrize("around", [
    '<div class="page no-sidebar"><article>{}</article></div>', '<article class="post has-sidebar">{}</article>',
    '<div class="ad-free"><p>{}</div>', '<section aria-label="Hidden gems"><p>{}</section>',
    '<article title="the hidden valley">{}</article>', '<div data-id="comments-1"><p>{}</div>',
    '<form id="aspnetForm"><nav>Menu</nav><article>{}</article></form>',
    '<div class="with-sidebar layout"><p>{}</div>', "<div data-class=sidebar data-role=banner><p>{}</div>",
    '<div class="content-sidebar-wrap"><article>{}</article><div class="sidebar">Side</div></div>',
    '<form><p>{}</form>', '<div id="widget-page"><main>{}</main></div>', '<div class="main sidebar-left">{}</div>'])
def test_names_and_forms_about_the_page_do_not_hide_it(around):
    page = f"<html><body><header>Site</header>{around.format(GOOD)}<footer>x</footer></body></html>"
    assert main_text(page) == GOOD.strip()


@pytest.mark.parametrize("part", [
    '<div class="sidebar">It is the best of all the pages in here.</div>', "<div class='ad'>Buy!</div>",
    '<section class="comments"><article>' + GOOD * 9 + "</article></section>",
    '<div class="related-posts"><article>More of it.</article></div>',
    '<form action=x>Your name in the box, and then send it to us.</form>', '<p hidden>Not seen.</p>',
    "<div id=cookie-notice>We use cookies.</div>", '<div role="banner">Site</div>',
    '<div class="widget"><p>About the author and so on.</div>', "<p style='color:red; display: none'>Not seen.</p>"])
def test_parts_that_are_not_the_article_go(part):
    for page in (f"<article>{GOOD}</article>{part}", f"<main><p>{GOOD}</p>{part}</main>"):
        assert main_text(f"<html><body>{page}</body></html>") == GOOD.strip()
    if "comments" not in part:
        assert main_text(f"<html><body><p>{GOOD}</p>{part}</body></html>") == GOOD.strip()


POLISH = "Wczoraj wieczorem nad jeziorem spotkaliśmy się z przyjaciółmi, żeby porozmawiać o długiej podróży w góry. "
JAPANESE = "昨日の夜、湖のほとりで友人たちと会い、山への長い旅について話しました。" * 4
DUTCH = "Gisteren liepen wij langs het meer naar huis toe omdat onze vrienden daar voor ons hadden gekookt. " * 2


def test_blocks_in_other_languages_stay_beside_known_ones():
    english = f"<p>{GOOD}</p>"
    for other in (POLISH * 3, JAPANESE):
        assert main_text(f"{english}<p>{other}</p>{english}") == f"{GOOD.strip()}\n{other.strip()}\n{GOOD.strip()}"
    marked = f'{english}<div lang="nl-NL"><p>{DUTCH}</p></div>'
    assert main_text(marked) == f"{GOOD.strip()}\n{DUTCH.strip()}"
    assert main_text(f'<html lang="nl"><p>{DUTCH}</p><p lang=en>{GOOD}</p>') == f"{DUTCH.strip()}\n{GOOD.strip()}"
    junk = "buy now cheap pills discount offer deal sale " * 6
    assert main_text(f"{english}<p>{junk}</p>{english}") == f"{GOOD.strip()}\n{GOOD.strip()}"
