from needbridge.llm import wrappers as w

SCHEMA = "page_id long, url string, html string, text string"


def page(i, main, extra=""):
    return (f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{x:1}}</style><script>var t="</p>";</script></head><body>'
            f'<nav><ul><li><a href="/a">a{i}</a></li><li><a href="/b">b</a></li></ul></nav><!-- x --><div class="ad">Buy {i}</div>'
            f'{main}{extra}<footer>&copy; site</footer></body></html>')


def run(spark, rows):
    out = w.extract(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return {r.page_id: r.text for r in out}


def test_article_pages(spark):
    rows, want = [], {}
    for i in range(30):
        paras = [f"Para &amp; {i} {j}" for j in range(i % 5)]
        rows.append((i, f"http://h{i % 2}.org/{i}", page(
            i, f"<article><h1>Head  {i}</h1><p><b>bold\n {i}<br>" + "".join(f"<p>{p}</p>" for p in paras) + "</article>",
            '<aside>side</aside><section id="comments"><p>I agree</p></section>')))
        want[i] = "\n".join([f"Head {i}", f"bold {i}", *[p.replace("&amp;", "&") for p in paras]])
    rows += [(100, None, None), (101, "not a url", ""), (102, "http://h0.org/x", "plain &lt; text")]
    got = run(spark, rows)
    assert {k: got[k] for k in want} == want and got[100] == got[101] == ""


def test_pages_without_article_element(spark):
    rows, want = [], {}
    for i in range(12):
        rows.append((i, "http://h.org", page(
            i, '<div class="cookie-notice">We use cookies</div><div class="top">Welcome to our site</div>'
               f'<div id="content"><h2>Story {i}</h2><p>Once <a href="x">upon</a> a time {i} there was a story.</p>'
               f'<form>Name <input></form><p>It ended {i}.</p></div>', '<div class="comments"><p>nice</p></div>')))
        want[i] = f"Story {i}\nOnce upon a time {i} there was a story.\nIt ended {i}."
    assert run(spark, rows) == want


def test_alignment_makes_optional_and_repeated_groups():
    a = w.skeleton(["/body/h1", "/body/p", "/body/p"])
    b = w.skeleton(["/body/p", "/body/div.x"])
    (body,) = w.align(a, b)[2]
    assert [(n[0], n[1]) for n in body[2]] == [("h1", "?"), ("p", "+"), ("div.x", "?")]
    assert w.align(a, a) == a


def test_odd_markup_and_empty_table(spark):
    assert [t for _, t, _ in w.blocks_of("a < b <p>x<p>y</div></p><li>1<li>2<!-- open")] == ["a < b", "x", "y", "1", "2"]
    assert list(w.blocks_of("<script>never closed <p>x")) == []
    assert run(spark, []) == {}


def test_missing_end_tags_of_silent_elements():
    texts = lambda html: [t for _, t, _ in w.blocks_of(html)]
    assert texts("<html><head><title>t</title><body><article><p>a</article>") == ["a"]
    assert texts("<head><title>t</title><meta charset=x><script>s</script>a<p>b") == ["a", "b"]
    assert texts("<p>a<svg width=1 /></p><p>b</p><svg><title>x</title><text>no</text></svg><p>c</p>") == ["a", "b", "c"]
    for name in ("button", "select", "object", "noscript"):
        assert texts(f"<div><p>a<{name}>no</p><p>b</p></div><p>c<{name}>no</{name}> d</p>") == ["a", "b", "c d"], name
    assert texts("<div><p>a</p><noscript><div><p>no</p></div></noscript><p>b</p></div>") == ["a", "b"]


def test_content_is_chosen_per_page(spark):
    rows = [(i, "http://h.org", page(i, f"<article><p>a {i}</article>")) for i in range(4)]
    rows += [(10, "http://h.org", page(10, "<main><p>in main</p></main>")), (11, "http://h.org", page(11, "<div><p>in div</p></div>")),
             (12, "http://h.org", "plain &lt; <b>text</b>")]
    rows += [(20 + i, "http://copies.org", "<body><div><p>the same page</p></div></body>") for i in range(5)]
    rows += [(30 + i, "http://n.org", f"<body><div>Welcome</div><p>story {i}</p></body>") for i in range(3)]
    got = run(spark, rows)
    assert [got[i] for i in (0, 3, 10, 11, 12)] == ["a 0", "a 3", "in main", "in div", "plain < text"]
    assert {got[20 + i] for i in range(5)} == {"the same page"} and got[31] == "story 1"


def test_marks_in_parts_of_a_class(spark):
    body = '<article><div class="entry-header"><h1>Title {0}</h1></div><p>Story {0}</p><div class="share-buttons">Share</div></article>'
    rows = [(i, "http://h.org", page(i, f'<div class="{c}">{body.format(i)}</div><div class="{c}">more</div>')) for i, c in enumerate(
        ["content has-sidebar", "with-navigation", "plain", "sidebar"])]
    rows.append((9, "http://i.org", page(9, '<div class="no-sidebar"><p>A long story without any article element.</p></div>')))
    got = run(spark, rows)
    assert [got[i] for i in range(4)] == [f"Title {i}\nStory {i}" for i in range(4)]
    assert got[9] == "A long story without any article element."


def test_varying_ids_share_paths_and_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(w, "MERGE", 3)
    rows = [(i, "http://h.org", f'<body><div id="w-{i}">Welcome</div><div id="post-{i}" class="p-{i:x}0a">' + "".join(
        f"<h{1 + (i >> k) % 2}>t{i}</h{1 + (i >> k) % 2}>" for k in range(5)) + "</div></body>") for i in range(32)]
    got = run(spark, rows)
    assert all("Welcome" not in got[i] and f"t{i}" in got[i] for i in range(32))
    (host,) = w.infer(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).collect()
    assert {"/body/div.w-0", "/body/div.p-0.post-0/h1"} <= set(w.paths_of(__import__("json").loads(host.wrapper)))
