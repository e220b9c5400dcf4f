"""Main text of pages unlike the tables' one template."""

from replivote.llm import extraction

STORY = "<p>" + "story text " * 30 + "</p>"


def texts(spark, pages):
    rows = [(i, *p) for i, p in enumerate(pages)]
    got = extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r["text"] for r in got.orderBy("page_id").collect()]


# names


AROUND = (
    "div class=has-sidebar", "div class=no-sidebar", "div class='page content-with-nav'", "form id=aspnetForm", "div class=sidebar", "div id=side"
)


def test_no_name_of_a_wrapper_loses_the_page(spark):
    pages = []
    for host, around in enumerate(AROUND):
        for inner in ("<main><article>{}</article></main>", "<main>{}</main>", "<div class=body>{}</div>", "{}"):
            tag = around.split()[0]
            pages.append((f"http://h{host}/", f"<body><nav>menu</nav><{around}>{inner.format(STORY)}</{tag}><div class=ad>Buy!</div></body>"))
    assert texts(spark, pages) == [" ".join(STORY[3:-4].split())] * len(pages)


def test_no_section_of_an_article_is_skipped_by_a_part_of_its_name():
    names = ["id=side-effects", "class=related-work", "id=social-history", "id=ad-hoc", "id=related", "id=notice"]
    page = "<article>" + "".join(f"<section {n}><p>text</p></section>" for n in names) + STORY + "</article>"
    assert not any(n.skipped for n in extraction.nodes(extraction.parse(page)))


def test_sections_of_an_article_whatever_they_are_called(spark):
    names = ["id=side-effects", "class=related-work", "id=social-history", "id=ad-hoc", "id=related", "id=notice"]
    sections = "".join(f"<section {n}><p>{'kept ' * 40}{n[-4:]}</p></section>" for n in names)
    (text,) = texts(spark, [("http://h/", f"<body><article>{sections}<div class=share>Share this</div></article></body>")])
    assert [w for w in text.split() if w != "kept"] == [n[-4:] for n in names]


def test_a_name_still_skips_what_is_not_the_article():
    page = f"<body><div class=post>{STORY}<div class='box ads'>Buy!</div></div><div id=comments>so true</div><form>Search</form></body>"
    assert sum(n.skipped for n in extraction.nodes(extraction.parse(page))) == 3


# the vote and the winners


def test_an_article_full_of_links_stays_on_its_hosts_path(spark):
    links = "<p>plain " + "<a href=/x>a linked word</a> " * 30 + "</p>"
    page = "<body><div class=story>{}</div><div class=box><p>" + "box " * 10 + "</p></div></body>"
    got = texts(spark, [("http://h/", page.format(STORY))] * 5 + [("http://h/", page.format(links)), ("http://alone/", f"<article>{links}</article>")])
    assert all(t == "plain " + " ".join(["a linked word"] * 30) for t in got[5:])
    assert all("box" not in t for t in got)


def test_title_and_small_sections_are_not_lost(spark):
    titled = f"<body><article><h1>The title</h1><div class=body>{STORY}</div></article></body>"
    plain = f"<body><div class=post><h1>The title</h1><div class=body>{STORY}</div></div><footer>foot</footer></body>"
    parts = "".join(f"<section class={c}><p>{c} {'word ' * n}</p></section>" for c, n in (("intro", 20), ("main", 60), ("end", 20)))
    got = texts(spark, [("http://a/", titled)] * 3 + [("http://b/", plain)] * 3 + [("http://c/", f"<body><div class=all>{parts}</div></body>")] * 3)
    assert all(t.startswith("The title story") for t in got[:6])
    assert all({"intro", "main", "end"} <= set(t.split()) for t in got[6:])


def test_ids_of_headings_do_not_split_the_vote(spark):
    page = "<body><div class=story>{}</div><div class=legal><p>{}</p></div></body>"
    heads = [(f"part {k} " + "word " * 20) for k in "abcdefgh"]
    body = "".join(f"<section id={h.split()[1]}-{{n}}><p>{h}</p></section>" for h in heads)
    pages = [("http://h/", page.format(body.replace("{n}", c), "small print")) for c in "pqrst"] + [("http://h/", page.format("<p>short</p>", "small print " * 50))]
    got = texts(spark, pages)
    assert all(t == " ".join(" ".join(heads).split()) for t in got[:5]) and got[5] == "short"


def test_a_page_unlike_its_host_gives_its_own_article(spark):
    usual = f"<body><div class=story>{STORY}</div></body>"
    other = f"<body><div class=story><p>teaser</p></div><div class=special><p>{'special text ' * 30}</p></div></body>"
    got = texts(spark, [("http://h/", usual)] * 9 + [("http://h/", other)])
    assert got[9] == " ".join(["special text"] * 30)


def test_class_words_with_path_marks_and_deep_pages():
    page = f"<body><div class='w-1/2 a.b'>{STORY}</div></body>"
    assert extraction.extract(page, None).startswith("story text")
    assert extraction.extract("<div>" * 2000 + STORY, None).startswith("story text")


# comments, adverts and what is not shown

TALK = "<p>" + "reader's words " * 200 + "</p>"
WHOLE_STORY = " ".join(STORY[3:-4].split())


def test_readers_comments_are_not_the_article(spark):
    reply = f"<article class=comment-body>{TALK}</article>"
    layouts = [
        f"<main><article class=post><h1>T</h1>{STORY}</article><div id=comments class=comments-area><h2>Comments</h2>{reply * 5}</div></main>",
        f"<main><article class=post><h1>T</h1>{STORY}<section id=comments>{TALK}</section></article></main>",
        f"<article class=post><h1>T</h1>{STORY}<div class=comment-list><ol><li id=c1>{TALK}<ul><li>{TALK}</li></ul></li></ol></div></article>",
        f"<article class=post><h1>T</h1>{STORY}<ol><li class=comment>{TALK}<ol><li>{TALK}</li></ol><li class=comment>{TALK}</ol></article>",
        f"<article><h1>T</h1>{STORY}<div class='post-comments wide'>{TALK}</div></article><article class='comment odd'>{TALK}</article>",
        f"<div class=content><h1>T</h1>{STORY}<div id=disqus_thread>{TALK}</div></div><div class=comment-respond><form>Say it</form></div>",
    ]
    pages = [(f"http://h{k}/{n}", f"<body><nav>menu</nav>{page}</body>") for k, page in enumerate(layouts) for n in range(3)]
    assert texts(spark, pages) == [f"T {WHOLE_STORY}"] * len(pages)


JUNK = (
    "div class=ad-slot", "div class=google-ads", "div class=share-buttons", "div class=cookie-notice", "div class=related-posts", "div class=newsletter-signup",
    "p class=advert", "li class=sponsored", "div role=navigation", "ul role='menu'", "div hidden", "p hidden=''", "div style='color:red; display: none'",
    "article class=teaser", "article class='card related-post'",
)


def test_what_is_named_or_hidden_as_no_part_of_the_article(spark):
    pages = []
    for frame in ("<article><h1>T</h1>{}</article>", "<div class=content><h1>T</h1>{}</div>"):
        for junk in JUNK:
            page = frame.format(f"<{junk}><b>not</b><br>this</{junk.split()[0]}>{STORY}<{junk}>nor this<br>one</{junk.split()[0]}>")
            pages.append((f"http://h{len(pages)}/", f"<body>{page}</body>"))
    assert texts(spark, pages) == [f"T {WHOLE_STORY}"] * len(pages)


def test_names_that_only_sound_alike_are_kept(spark):
    names = ["class=side-effects", "class=ad-hoc", "class=social-history", "class='w-full shared-memory'", "data-hidden=1", "aria-hidden=true", "class=hidden-figures"]
    body = "".join(f"<div {n}><p>{n[-5:].strip('=')} {'kept ' * 9}</p></div>" for n in names)
    (text,) = texts(spark, [("http://h/", f"<body><article>{STORY}{body}</article></body>")])
    assert text.count("kept") == 9 * len(names)


def test_an_unclosed_paragraph_of_an_advert_ends_at_the_next_block():
    page = f"<article><h1>T</h1><p class=advert>Buy<br>now<p>first</p>{STORY}<ul><li class=ad>Buy<li>second</ul></article>"
    assert extraction.extract(page, None) == f"T first {WHOLE_STORY} second"


def test_deeply_nested_named_tags_take_little_memory():
    import tracemalloc

    page = "<div class='row item'>" * 20_000 + STORY + "</section></b>" * 20_000
    tracemalloc.start()
    assert extraction.extract(page, None) == WHOLE_STORY
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_a_very_long_page_is_whole(spark):
    page = f"<body><article>{STORY * 20_000}</article><div class=comments>{TALK}</div></body>"
    assert texts(spark, [("http://h/", page), ("http://h/", page), (None, None)]) == [" ".join([WHOLE_STORY] * 20_000)] * 2 + [""]
