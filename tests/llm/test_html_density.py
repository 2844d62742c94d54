from __future__ import annotations

from ledgerlake.llm.html_density import extract_main_text, main_text

PARA = "This is a paragraph of running text that is long enough to look like an article."


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def test_article_without_furniture():
    furniture = (
        "<header><h1>Site name</h1><p>A tagline that goes on and on about the site.</p></header><nav><ul><li><a href=a>Home</a></li></ul></nav>",
        "<div class='ad'>Buy this thing now, it is a very good thing to buy.</div><div id='cookie-notice'>We use cookies for many purposes.</div>",
        "<aside>Popular posts and other links that nobody reads at all.</aside><form><label>Mail</label><input><p>Subscribe to our letter today.</p></form>",
        "<section class='comments'><h2>Comments</h2><article class='comment'><p>A reader says a lot about this article, at length.</p></article></section>",
        "<footer>&copy; somebody, all rights reserved, and a lot more text.</footer>",
    )
    article = f"<article><h1>Title</h1><p>{PARA} One.<p>Short.</p><ul><li>a<li>b</ul><p>{PARA} Two &amp; &#233;&nbsp;end <a href=x>link</a>.</p></article>"
    want = f"Title\n{PARA} One.\nShort.\na\nb\n{PARA} Two & é end link."
    assert main_text(page("".join(furniture[:3]) + article + "".join(furniture[3:]))) == want
    assert main_text(page(article)) == want
    # the same without an article element
    plain = article.replace("article>", "div>")
    assert main_text(page("".join(furniture[:3]) + plain + "".join(furniture[3:]))) == want


def test_article_over_several_sections():
    body = f"<nav><a href=a>x</a></nav><div><section><p>{PARA}</p><p>{PARA} b</p></section><section><h2>Sub</h2><p>{PARA} c</p></section></div>"
    assert main_text(page(body)) == f"{PARA}\n{PARA} b\nSub\n{PARA} c"


def test_broken_and_odd_pages():
    assert [main_text(s) for s in (None, "", " \n ", "<p></p>", "<!-- x", "<script>var a")] == [""] * 6
    assert main_text("no markup at all") == "no markup at all"
    assert main_text("<p title='a>b'>one<br>two <b>three<p>four") == "one two three\nfour"
    assert main_text("<div>" * 30_000 + PARA) == PARA
    assert main_text("1 < 2 &lt; 3") == "1 < 2 < 3"
    assert main_text(f"<table><tr><td>{PARA}<td>{PARA}</table>") == f"{PARA}\n{PARA}"


def test_hidden_text_and_wrappers_with_telling_names():
    body = f"<div class='page sidebar-left'><article><h1>T</h1><p>{PARA}</p><p style='display: none'>not seen</p><div hidden>nor this</div></article></div>"
    assert main_text(page(body)) == f"T\n{PARA}"


def test_frame_keeps_columns_and_rows(spark):
    rows = [(1, "u", None, "t"), (2, "v", page(f"<p>{PARA}</p>"), "t"), (2, "v", page(f"<p>{PARA}</p>"), "t"), (None, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, node string")
    out = extract_main_text(df)
    assert out.columns == ["page_id", "url", "html", "node", "text"]
    assert sorted(r.text for r in out.collect()) == ["", "", PARA, PARA]
    assert extract_main_text(df.limit(0)).count() == 0


def test_names_inside_an_article_cut_no_text():
    inner = f"<h2 id='related-work'>Related</h2><section id='search'><p>{PARA}</p></section><p class='ad-hoc'>Ad hoc.</p><h2 id='search'>Search</h2>"
    cut = "<div class='ad'>Buy this.</div><div id='cookie-notice'>We use cookies.</div><div class='share-links'><a href=a>Share</a></div>"
    assert main_text(page(f"<article><h1>T</h1><p>{PARA}</p>{inner}{cut}</article>")) == f"T\n{PARA}\nRelated\n{PARA}\nAd hoc.\nSearch"


def test_short_siblings_between_sections_stay():
    part = f"<section>{f'<p>{PARA}</p>' * 6}</section>"
    whole = [PARA] * 6
    body = f"<div>{part}<div><p>Short.</p></div>{part}</div>"
    assert main_text(page(body)).split("\n") == [*whole, "Short.", *whole]


NAMED = (
    "user-comments comment-section comments-area comment-list post-comments ad-slot ad-container advert-box sidebar-left site-notice sticky-ad "
    "promo-box related-posts adslot ad-300x250 commentSection"
).split()


def test_compound_names_cut_inside_outside_and_without_an_article():
    block = "<{t} {a}='{n}'><p>Somebody says quite a lot here, in running text that is as dense as any article.</p><p>{p}</p></{t}>"
    for name in NAMED:
        for tag, attribute in (("div", "class"), ("section", "id"), ("div", "id")):
            named = block.format(t=tag, a=attribute, n=name, p=PARA)
            text = f"<h1>T</h1><p>{PARA}</p><p>{PARA}</p>"
            want = f"T\n{PARA}\n{PARA}"
            assert main_text(page(f"<article>{text}{named}</article>")) == want, name
            assert main_text(page(f"<article>{text}</article>{named}")) == want, name
            assert main_text(page(f"<div>{text}</div>{named}")) == want, name
    for name in ("related-work", "ad-hoc", "search", "no-comment-needed", "thread", "reading-list", "notice-period"):
        kept = f"<section class='{name}'><p>{PARA} kept</p></section>"
        assert main_text(page(f"<article><h1>T</h1><p>{PARA}</p>{kept}</article>")) == f"T\n{PARA}\n{PARA} kept", name


def test_attributes_of_any_length_and_stray_quotes():
    long = "x" * 50_000 + ">MARKUP"
    assert main_text(page(f'<article><p data-x="{long}">{PARA}</p><p data-y=\'{long}\' class=b>{PARA} 2</p></article>')) == f"{PARA}\n{PARA} 2"
    assert main_text(f"<p don't>{PARA} it's</p><p title=\"a>{PARA}") == f"{PARA} it's\n{PARA}"
    many = "".join(f"<p a='>' b=\"<i>\" c=d'e>{PARA}</p>" for _ in range(2_000))
    assert main_text(f"<article>{many}</article>").count(PARA) == 2_000
    assert main_text("<p " + "a='b' " * 40_000) == ""


def test_densities_equal_a_recursive_definition():
    import math
    import random

    from ledgerlake.llm import html_density as H

    rng = random.Random(8)

    def tree(depth):
        if not depth or rng.random() < 0.2:
            return "w" * rng.randint(1, 30)
        tag = rng.choice(["div", "section", "b", "a", "i"])
        return f"<{tag}>" + " ".join(tree(depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"

    for _ in range(60):
        p = H.Page(f"<html><body>{tree(5)}</body></html>")
        cut = p.cut()
        density, total, *_ = H.densities(p, cut)
        kids = [[c for c in range(len(p.tag)) if p.parent[c] == k] for k in range(len(p.tag))]

        def below(k):
            return [x for c in kids[k] for x in (c, *below(c))]

        def linked(k):
            return k > 0 and (p.tag[k] == "a" or linked(p.parent[k]))

        def sizes(k):
            nodes = {k, *below(k)}
            text = [(n, sum(map(len, t.split()))) for n, t in p.items if t is not None and n in nodes]
            return sum(s for _, s in text), len(nodes) - 1, sum(s for n, s in text if linked(n)), sum(p.tag[n] == "a" for n in nodes - {k})

        c0, _, l0, _ = sizes(0)

        def composite(k):
            c, t, lc, lt = sizes(k)
            if not c:
                return 0.0
            base = math.log(c / max(1, c - lc) * lc + l0 / max(1, c0) * c + math.e)
            return c / max(1, t) * max(0.0, math.log(c / max(1, lc) * max(1, t) / max(1, lt)) / base)

        for k in range(len(p.tag)):
            assert math.isclose(density[k], composite(k), rel_tol=1e-12, abs_tol=1e-12)
            assert math.isclose(total[k], sum(map(composite, kids[k])), rel_tol=1e-9, abs_tol=1e-9)
