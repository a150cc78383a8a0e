import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from chartstreak.llm import html_extract as op

SCHEMA = "page_id long, url string, html string, host string, stream string"


def news(rng, i, cut=False):
    menu = "".join(f'<li><a href="/{k}">Menu {rng.random()}</a></li>' for k in range(rng.randint(2, 6)))
    paras = [f"Paragraph {i} {k} with &amp; and  <b>bold</b>\n text {rng.random()}." for k in range(rng.randint(1, 7))]
    body = "".join(f"<p>{p}</p>" for p in paras)
    aside = '<aside>Related stories</aside>' if i % 3 == 0 else ""
    ad = f'<div class="ad-slot" id="ad-{i}">Buy {rng.random()}</div>' if i % 2 else ""
    page = (f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>x</p>";</script></head>'
            f'<body class="has-sidebar"><header>Site</header><nav><ul>{menu}</ul></nav><!-- c > <p>no</p> -->{ad}'
            f'<article><h1>Title {i}</h1>{body}{aside}<form><input>Sign up</form></article>'
            f'<section id="comments"><article class="comment"><p>Nice {i}</p></article></section>'
            f'<footer>&copy; Foot {i}</footer></body></html>')
    want = "\n".join([f"Title {i}"] + [p.replace("&amp;", "&").replace("<b>", "").replace("</b>", "").replace("\n", " ")
                                       .replace("  ", " ") for p in paras])
    if cut:
        page = page[:page.index("<footer>") + 12]
    return page, want


def shop(rng, i):
    text = [f"Story {i}.{k} says {rng.random()}" for k in range(rng.randint(1, 4))]
    return (f'<html><body><div class="top"><a href=1>Home</a> <a href=2>About</a></div><div class="box">'
            f'{"".join(f"<p>{t}" for t in text)}</div><div class="sidebar">Side {rng.random()}</div>'
            f'<div class="bottom">Always the same line.</div></body></html>'), "\n".join(text)


def pages():
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(60):
        html, want[i] = news(rng, i, cut=i % 10 == 9)
        rows.append((i, f"http://News.example.org/{i}", html, "x", "y"))
    for i in range(60, 90):
        html, want[i] = shop(rng, i)
        rows.append((i, f"https://shop.example.org:8080/{i}", html, "x", "y"))
    edge = {100: None, 101: "", 102: "plain text &lt;b&gt;", 103: "<p>unclosed <", 104: "<article><p" , 105: "<!-- open",
            106: "<article>" + "<p>long &eacute; text</p>" * 20_000 + "</article>"}
    want |= {100: "", 101: "", 102: "plain text <b>", 103: "unclosed <", 104: "", 105: "",
             106: "\n".join(["long é text"] * 20_000)}
    rows += [(i, None if i % 2 else f"http://e{i}.example.org/", h, "x", "y") for i, h in edge.items()]
    return rows + [rows[0]], want


def test_articles_are_extracted(spark):
    rows, want = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    out = op.extract_pages(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.text == want[r.page_id], r.page_id
        assert r.n_chars == len(r.text)
    assert {(r.page_id, r.url) for r in out} == {(r[0], r[1]) for r in rows}


def test_open_head_and_open_elements_keep_the_text(spark):
    body = "<article><h1>Title</h1><p>First.</p>{}<p>Second.</p></article>"
    head = '<html><head><meta charset=x><title>T</title><script>"<p>no</p>"</script><style>p{}</style>'
    whole = "Title\nFirst.\nSecond."
    made = [(head + "<body>" + body.format(""), whole), (head + body.format("") + "</html>", whole),
            ("<head><title>T<meta charset=x><body>" + body.format(""), whole),
            ("<head><title>T</title>Text <b>here", "Text here"), ("<head><title>T</title></head><p>Text", "Text"),
            ("<head><noscript><link></noscript><title>T</title><div>Text</div>", "Text"), ("<head><title>T", "")]
    made += [(head + "</head><body>" + body.format(f"<{x}>"), whole) for x in
             ("button", "noscript", "video", "object", "canvas", "iframe", "audio", "title", "svg", "math", "template")]
    made += [("<body>" + body.format("<button>Press"), whole), ("<p>See <video src=x> this</p>", "See this")]
    made += [("<body>" + body.format(f"<{x}>"), "Title\nFirst.") for x in ("script", "style", "textarea")]
    made += [("<p>a</p>" + "<button>" * 20_000 + "<p>b</p>", "a\nb")]
    rows = [(i, f"http://h{i}.example.org/", h, "x", "y") for i, (h, _) in enumerate(made)]
    out = op.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in out} == {i: want for i, (_, want) in enumerate(made)}


def test_shuffled_wrappers_give_the_same(spark, monkeypatch):
    rows, want = pages()
    monkeypatch.setattr(op, "BROADCAST_BYTES", -1)
    out = op.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in out} == want


def unnamed(i, rng, blurb):
    """A page whose names say nothing; every third has a block of changing text before the story."""
    story = "".join(f"<p>Story {i} {k} {rng.random()} " + "goes on " * 6 + "</p>" for k in range(rng.randint(2, 5)))
    extra = f'<div class="q"><p>{blurb} {rng.random()}</p></div>' if i % 3 == 0 else ""
    return (f'<html><body><div class="x"><h1>Name {i}</h1></div>{extra}<div class="y">{story}</div>'
            f'<div class="z"><p>Every page ends so.</p></div></body></html>')


def named(i, rng):
    """A host where a short ``main`` holds next to nothing and the story stands in a container without a name."""
    story = "".join(f"<p>Long story {i} {k} {rng.random()} " + "and so on " * 20 + "</p>" for k in range(4))
    return f'<html><body><main><p>Issue {i}</p></main><div class="k7">{story}</div></body></html>'


def test_optional_and_fixed_parts_of_the_wrapper_decide(spark):
    rng = random.Random(5)
    rows = [(i, f"http://plain.example.org/{i}", unnamed(i, rng, "Buy"), "x", "y") for i in range(40)]
    rows += [(i, f"http://odd.example.org/{i}", named(i, rng), "x", "y") for i in range(40, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.page_id: r.text for r in op.extract_pages(df).collect()}
    for i in range(40):
        lines = out[i].split("\n")
        assert lines[0] == f"Name {i}" and all(x.startswith(f"Story {i} ") for x in lines[1:]) and len(lines) > 2
    assert all("Long story" in out[i] for i in range(40, 60))


def test_another_wrapper_gives_other_rows(spark):
    rng = random.Random(6)
    rows = [(i, f"http://plain.example.org/{i}", unnamed(i, rng, "Buy"), "x", "y") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    wrappers = op.infer_wrappers(df)
    stream = op.load(wrappers.first()["stream"])
    assert any(o for _, o in stream)
    rigid = spark.createDataFrame([("plain.example.org", 0, json.dumps([(k, False) for k, _ in stream]))], op.STREAM)
    whole = {r.page_id: r.text for r in op.extract_pages(df, wrappers=wrappers).collect()}
    other = {r.page_id: r.text for r in op.extract_pages(df, wrappers=rigid).collect()}
    assert {i for i in whole if whole[i] != other[i]} == set(range(0, 30, 3))
    assert all("Buy" in other[i] and "Buy" not in whole[i] for i in range(0, 30, 3))


def test_hot_host_is_merged_in_rounds(spark):
    rng = random.Random(7)
    rows = [(i, "http://hot.example.org/", unnamed(i, rng, "Buy"), "x", "y") for i in range(60)]
    rows += [(i, f"http://h{i}.example.org/", unnamed(i, rng, "Buy"), "x", "y") for i in range(60, 65)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.host: op.infer([op.load(r.stream)]) for r in op.infer_wrappers(df, fan_in=2).collect()}
    assert len(found) == 6
    for _, url, source, _, _ in rows:
        wrapper = found[url.split("/")[2]]
        page = op.Page(source)
        assert sorted(t for _, t in op.aligned(page, wrapper)) == sorted(page.texts)
        assert all(at != op.OUTSIDE for at, _ in op.aligned(page, wrapper))


def test_another_template_of_the_host_is_judged_by_itself():
    stats = {(1, "div.a/p"): (False, 0.0, 9_000, False), (2, "div.b/p"): (False, 0.0, 900, True),
             (3, "div.c/p"): (True, 0.0, 500, False)}
    held = op.article(stats)
    assert held == {(1, "div.a/p")}
    page = [((2, "div.b/p"), "Text of the other template."), ((3, "div.c/p"), "fixed")]
    assert op.chosen(page, stats, held) == ["Text of the other template."]
    assert op.chosen([((3, "div.c/p"), "fixed")], stats, held) == ["fixed"]


def test_empty_table(spark):
    assert op.extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_wrapper_has_groups_and_options():
    rng = random.Random(1)
    streams = [[(k, False) for k, _, _ in op.fold(op.Page(news(rng, i)[0]).keys)] for i in range(12)]
    text = op.as_expression(op.infer(streams))
    assert "(<li> #)+" in text and "(<p> #)+" in text and "(<aside>)?" in text and "|" not in text


def covers(wrapper, items):
    """Whether the items run through the wrapper in order, skipping only optional parts."""
    ends = {0}
    for key, optional in wrapper:
        ends = {i + 1 for i in ends if i < len(items) and items[i] == key} | (ends if optional else set())
    return len(items) in ends


TOKENS = st.lists(st.sampled_from(["<p", "#", "<li", "<div", "</div", "<ul", "</ul"]), max_size=14)


@settings(max_examples=300, deadline=None)
@given(TOKENS, TOKENS)
def test_aligned_wrapper_covers_both(a, b):
    left, right = ([(k, False) for k, _, _ in op.fold(x)] for x in (a, b))
    whole = op.align(left, right)
    groups = op._groups([k for k, _ in whole])
    for side in (left, right):
        grown = [k for k, _, _ in op.absorb([(k, i, i + 1) for i, (k, _) in enumerate(side)], groups)]
        assert covers(whole, grown)
    assert op.load(json.dumps(whole)) == whole


@settings(max_examples=200, deadline=None)
@given(TOKENS)
def test_fold_keeps_every_token(keys):
    spans = [(a, b) for _, a, b in op.fold(keys)]
    assert [i for a, b in spans for i in range(a, b)] == list(range(len(keys)))
