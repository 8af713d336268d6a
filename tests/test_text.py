
from pyspark.sql import functions as F

from scriptorium.functions import html as H
from scriptorium.functions import text as X
from scriptorium.functions.prompts import build_prompt, parse_response
from scriptorium.functions.sets import jaccard, union_all


def values(spark, texts, expr):
    """The expression on each text, in order."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_normalize_title(spark):
    cases = {
        "Rocky IV: the end": "Rocky 4 The End", "MATRIX Reloaded": "Matr9 Reloaded", "l-a_x1b": "L A X1b",
        "  lead": " Lead", "o.k.": "Ok", "x+y z": "X+y Z", "ßeta x": "Sseta X", "(abc) def": "(abc) Def",
        "ROCKY III": "Rocky 3", "ǆungla": "ǅungla", "PART VIII": "Part 8", "tab\tand\u00a0space": "Tab And Space",
        "What's up, Doc?!": "Whats Up Doc", "": "",
    }
    assert values(spark, list(cases), X.normalize_title) == list(cases.values())


def test_file_name_and_keys(spark):
    assert values(spark, ["Rocky 4 The End"], lambda c: X.file_name(c, F.lit("pdf"))) == ["rocky_4_the_end.pdf"]
    assert values(spark, ["\u00a0A: b c "], lambda c: X.wiki_url(c, "w/")) == ["w/A_b_c"]
    assert values(spark, ["Alien: 100% x"], lambda c: X.script_url(c, "s/")) == ["s/Alien-100%2526-x.html"]


def test_base_name(spark):
    paths = ["/a/b/mr. x.final.txt", "file:/a.b/c", "x.htm", "/a/.hidden", "/a/b.c/"]
    assert values(spark, paths, X.base_name) == ["mr. x.final", "c", "x", ".hidden", ""]


def test_absolute_url(spark):
    assert values(spark, ["/x", "http://y", "https://z"], lambda c: X.absolute_url(c, "b:")) == ["b:/x", "http://y", "https://z"]


WORDS = ["a b", "  a\u00a0b\x1cc\u2028d \n", "", " \t\r\n\x1d", "a\u200bb c", "x\x85y", "one", "é  ü\u3000z", None]


def test_words_and_strip_agree_with_python(spark):
    assert values(spark, WORDS, X.word_count) == [len((w or "").split()) for w in WORDS]
    assert values(spark, WORDS[:-1], X.words) == [w.split() for w in WORDS[:-1]]
    assert values(spark, WORDS[:-1], X.strip) == [w.strip() for w in WORDS[:-1]]


def test_items(spark):
    texts = [None, "", "a, b,,c ", " , ", "one"]
    assert values(spark, texts, X.parse_items) == [[], [], ["a", "b", "c"], [], ["one"]]
    assert values(spark, ["b|A|a|B"], lambda c: X.sort_items_ci(F.split(c, r"\|"))) == [["A", "a", "B", "b"]]
    assert values(spark, ["x"], lambda c: X.clean_items(F.array(F.lit(" a "), F.lit(" "), c))) == [["a", "x"]]


def test_after_marker(spark):
    texts = ["menu ALL SCRIPTS\nbody ALL SCRIPTS end", "no marker", "ALL SCRIPTS", ""]
    assert values(spark, texts, lambda c: X.after_marker(c, "ALL SCRIPTS")) == ["\nbody ALL SCRIPTS end", "no marker", "", ""]


def test_preview_and_mentions(spark):
    assert values(spark, ["é" * 3000], lambda c: F.length(X.preview(c))) == [2000]
    items = F.array(F.lit("ab"), F.lit("c"), F.lit("zz"))
    assert values(spark, ["abc", "", None], lambda c: X.mention_count(c, items)) == [2.0, 0.0, 0.0]


SCRIPTS = {
    "no header at all\nsecond line": ["no header at all\nsecond line"],
    "CUT TO: INT. HOUSE - DAY\nbody": ["", "CUT TO: INT. HOUSE - DAY\nbody"],
    "intro\r\nINT. A\r\nx\r\nEXT. B\r\ny": ["intro", "INT. A\r\nx", "EXT. B\r\ny"],
    "EXT./INT. CAR\nz": ["EXT./", "INT. CAR\nz"],
    "a\nINT.\nnext line\nrest": ["a", "INT.\nnext line\nrest"],
    "scène 1\nx\nSCÈNE 2": ["", "scène 1\nx", "SCÈNE 2"],
    "\x1c\u00a0 intro INT. X\n\u2028y\x85": ["intro", "INT. X\n\u2028y"],
    "": [""],
    "  \n ": [""],
    "PRINT. no\nHINT. no\nINT. yes": ["PRINT. no\nHINT. no", "INT. yes"],
    "FADE IN:\nINT. ROOM\nFADE OUT.\nend": ["", "FADE IN:", "INT. ROOM", "FADE OUT.\nend"],
    "x FADE OUT. y CUT TO: z\nINT. q": ["x", "FADE OUT. y CUT TO: z", "INT. q"],
    "int. lower\next. lower": ["", "int. lower", "ext. lower"],
    "A$1 \\ INT. $0 back\\slash\n$2": ["A$1 \\", "INT. $0 back\\slash\n$2"],
    "own \ufdd0\ufdd1 and \ufdd0 INT. x\ufdd0\ufdd2": ["own \ufdd0\ufdd1 and \ufdd0", "INT. x\ufdd0\ufdd2"],
}


def test_segments(spark):
    assert values(spark, list(SCRIPTS), X.segments) == list(SCRIPTS.values())


def test_segments_keep_all_text(spark):
    for text, parts in zip(SCRIPTS, values(spark, list(SCRIPTS), X.segments)):
        assert "".join("".join(parts).split()) == "".join(text.split())


def test_entities(spark):
    cases = {
        "a &amp; b": "a & b", "&amp;lt;": "&lt;", "&lt;&gt;&quot;": '<>"', "&#233;&#xE9;&#x1F600;": "éé😀", "&nosuch; &": "&nosuch; &",
        "&copy;&middot;&eacute;": "©·é", "x": "x", "": "", "&#0;&#55296;": "&#0;&#55296;", "AT&T;": "AT&T;", "&": "&",
    }
    assert values(spark, list(cases), H.decode_entities) == list(cases.values())


def test_strip_markup(spark):
    page = "<html><!-- a <b> --><script>if (a<b) {}</script><STYLE>p{}</STYLE><p class='x'>T&amp;x<br>y</p></html>"
    assert values(spark, [page], H.strip_markup) == ["T&xy"]
    form = "a < b <select><option>x</option></select><TEXTAREA>y</textarea><button>z</button>and c > d<title>t</title>"
    assert values(spark, [form], H.strip_markup) == ["a < b and c > dt"]


def test_paragraphs(spark):
    long = "this one is certainly long enough to be taken"
    page = f"<table><tr><td><p>{long} but in a table</p></td></tr></table><p>short</p><P class='a'>open <b>bold</b><p> {long} </p><p>z</p>"
    assert values(spark, [page], H.paragraphs) == [["short", "open bold", long, "z"]]
    assert values(spark, [page, "<p>short</p>", ""], H.first_long_paragraph) == [long, None, None]
    assert values(spark, [page, ""], H.first_paragraph) == ["short", None]
    assert values(spark, ["<p>" + "x" * 30 + "</p>", "<p>" + "x" * 31 + "</p>"], H.first_long_paragraph) == [None, "x" * 31]


def test_list_links(spark):
    page = ("<ul id='m'><li><a class='q' href='/A_b'> A <b>b</b> </a></li><li><a href=\"http://x/y?a=1&amp;b=2\">Y</a></li>"
            "<li><a name='none'>no link</a></li></ul><ul><li><a href='/second'>not taken</a></li></ul>")
    assert [[tuple(x) for x in v] for v in values(spark, [page, "<p>none</p>"], lambda c: H.list_links(c, "https://b"))] == [
        [("A b", "https://b/A_b"), ("Y", "http://x/y?a=1&b=2")], []]
    nested = ("<OL><li><a href='/ol'>ol</a></li></OL><ul><li><a href='/1'>1</a>: <i>see <a href='/i'>i</a></i><ul><li><a href='/n'>n</a></li>"
              "<ol><li><a href='/m'>m</a></li></ol></ul></li><li>x <a href='/2'>2</a></li></ul><ul><li><a href='/3'>3</a></li></ul>")
    assert [[x["name"] for x in v] for v in values(spark, [nested, ""], lambda c: H.list_links(c, ""))] == [["1", "2"], []]


def test_content_element(spark):
    long = "long enough to be a definition of something"
    page = f"<ul><li><a href='/menu'>menu</a></li></ul><p>{long} not</p><div class='x' id=\"body\"><ul><li><a href='/a'>a</a></li></ul><p>{long}</p></div>"
    assert [[x["url"] for x in v] for v in values(spark, [page], lambda c: H.list_links(c, "", "body"))] == [["/a"]]
    assert values(spark, [page, "<p>none</p>"], lambda c: H.first_long_paragraph(c, 30, "body")) == [long, None]
    assert values(spark, [page.replace('"body"', "body")], lambda c: H.first_paragraph(c, "body")) == [long]


def test_prompts(spark):
    none = F.array().cast("array<string>")
    text = values(spark, ["scene"], lambda c: build_prompt(c, none))[0]
    assert "scene" in text and "Candidates: None" in text
    assert "Candidates: a, b" in values(spark, ["scene"], lambda c: build_prompt(c, F.array(F.lit("a"), F.lit("b"))))[0]
    answers = ['{"tropes": ["a"], "examples": ["x", "y"]}', "", "not json", None, '{"other": 1}']
    assert [None if r is None else (r["tropes"], r["examples"]) for r in values(spark, answers, parse_response)] == [
        (["a"], ["x", "y"]), None, None, None, None]


def test_jaccard(spark):
    rows = [([], []), (["a", "b"], ["b", "a"]), (["a"], ["b"]), (["a"], []), (["a", "a", "b"], ["b", "b"]), (None, None), (None, ["a"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = [tuple(r) for r in df.orderBy("i").select(jaccard(F.col("a"), F.col("b")), jaccard(F.col("b"), F.col("a"))).collect()]
    assert [g[0] for g in got] == [0.0, 1.0, 0.0, 0.0, 0.5, 0.0, 0.0]
    assert all(a == b and 0 <= a <= 1 for a, b in got)
    assert df.select(union_all(F.array(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("b"))))).first()[0] == ["a", "b"]


def test_tags_with_quoted_ends(spark):
    assert values(spark, ['<p title="a > b">text</p> it\'s <b class=\'x>y\'>c</b>', '<p title="open>x'], H.strip_markup) == ["text it's c", "x"]
    assert values(spark, ["&apos;&amp;apos;"], H.decode_entities) == ["'&apos;"]


PAGE = """<div><ul><li><a href="/menu">menu</a></li></ul></div><div id="c" class="x"><div class="toc"><ul><li><a href="#1">toc</a></li></ul><p>A paragraph in the box, long enough for it.</p></div>
<table><tr><td><table><tr><td><p>inner cell with a long enough text in it</p></td></tr></table><p>outer cell with a long enough text in it too</p></td></tr></table>
<p>The first paragraph proper, of some length.</p><ul><li><a href="/one">one</a><ul><li><a href="/deep">deep</a></li></ul></li></ul></div>
<footer><p>A footer paragraph that is long enough to be taken.</p><ul><li><a href="/foot">foot</a></li></ul></footer>"""


def test_content_element(spark):
    assert values(spark, [PAGE], lambda c: H.first_long_paragraph(c, within="c")) == ["The first paragraph proper, of some length."]
    assert values(spark, [PAGE], lambda c: F.transform(H.list_links(c, "http://x", "c"), lambda x: x["name"])) == [["one"]]
    only_footer = '<div id="c">nothing here</div><p>A footer paragraph that is long enough to be taken.</p>'
    assert values(spark, [only_footer, "<p>no such element, but long enough to be taken</p>"], lambda c: H.first_long_paragraph(c, within="c")) == [None, None]
    assert values(spark, ['<DIV id=c><div>a</div>b</DIV>c', '<div id="c">open <div>x'], lambda c: H.strip_markup(H.inside(c, "c"))) == ["ab", "open x"]


def test_bare_attributes(spark):
    assert values(spark, ["<p title=don't>Hello, this isn't lost</p><p>second</p>"], H.strip_markup) == ["Hello, this isn't lostsecond"]
    assert values(spark, ["<p title=don't>Hello, this isn't lost</p><p>second</p>"], H.paragraphs) == [["Hello, this isn't lost", "second"]]
    assert values(spark, ['<a href=/x?a="b>c">d</a>', "a <b class = 'x>y' id=z>c</b>", "<p a=>x</p><p =b>y", 'x<br/>y<br />z'], H.strip_markup) == ['c">d', "a c", "xy", "xyz"]


def test_open_ends(spark):
    pages = ["a<script>code <b>", "a<style>p{}", "a<!-- b <p>", "a<b", "a<p title='x", "a<script>1</script x>b", "a<!-->b<!--->c<!-- d --!>e", "a<button>b", "a < b <3 c", "<", "",
             "x<script src=a>1</SCRIPT>y", "<scripted>z</scripted>"]
    assert values(spark, pages, H.strip_markup) == ["a", "a", "a", "a", "a", "ab", "abce", "ab", "a < b <3 c", "<", "", "xy", "z"]


def test_tokens_are_the_page(spark):
    pages = [PAGE, "a<script>x</script><!-- c --><p a='>'>b < c</P>", "<b", ""]
    assert values(spark, pages, lambda c: F.array_join(F.transform(H.tokens(c), lambda t: t["token"]), "")) == pages
    assert values(spark, pages[1:2], lambda c: F.transform(H.tokens(c), lambda t: t["name"])) == [["", "!", "!", "p", "", "", "", "/p"]]


def test_references_without_semicolon(spark):
    cases = {"a&nbspb&nbsp;c": "a\xa0b\xa0c", "&copyright &notit; &notin;": "©right ¬it; ∉", "&AMP &LT;&ltx": "& <<x", "&#65 &#x41g": "A Ag", "&amper": "&er", "x&y=1": "x&y=1"}
    assert values(spark, list(cases), H.decode_entities) == list(cases.values())
    links = "<ul><li><a href='/x?a=1&copy=2&amp;b=3&copy'>l</a></li></ul>"
    assert [[x["url"] for x in v] for v in values(spark, [links], lambda c: H.list_links(c, ""))] == [["/x?a=1&copy=2&b=3©"]]


def test_links_by_any_attribute(spark):
    page = ("<ul><li><a href=/bare>1</a><li><a title='x > y' href='/k'>2</a><li><a data-href=/no>no</a><li><a href>none</a><li><a x=1 HREF = \"/u\" href=/second>3<li><a\nhref='/n'title=t>4</a>"
            "<li><b><a href=/deep>d</a><li><a href=/open>5 <img alt='</a>'> &amp; <i>6</i></a> <span>s</span> <a href=/two>7</a></ul><ul><li><a href=/later>8</a></ul>")
    got = [[tuple(x) for x in v] for v in values(spark, [page], lambda c: H.list_links(c, ""))][0]
    assert got == [("1", "/bare"), ("2", "/k"), ("3", "/u"), ("4", "/n"), ("5  & 6", "/open"), ("7", "/two")]


def test_attributes(spark):
    tags = ["<a b=1 id=x>", "<a id='it''s'>", '<a data-id=1 id = "a &amp; b">', "<a id>", "<a/id=x/>", "<p class=\"id='no'\" id=yes>", "<a id=''>"]
    assert values(spark, tags, lambda c: H.attribute(c, "id")) == ["x", "it", "a & b", "", "x/", "yes", ""]
    page = "<p id=other>a</p><div class='id=c' id=c>b<div>c</div>d</div>e"
    assert values(spark, [page, "<br id=c>x", "<p>c</p>"], lambda c: H.inside(c, "c")) == ["b<div>c</div>d", "", None]
