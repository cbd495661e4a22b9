"""Text columns on hand-made edge rows."""

import html
import random
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from topiclens.functions.references import decode_references
from topiclens.functions import text, wordlists
from topiclens.functions.stemming import with_stem

EDGES = [
    None, "", " ", "He's\nhere&nbsp;NOW,\tÉté 3.5!", "isn’t it", "\x0b \x0c \x1c",
    "Kelvin", "a  b", " lead", "trail ", "Ünïcode 😀 ok", "1.5 .. x.",
]
KEPT = set(string.printable) - (set(string.punctuation) - {"'", "."})


def clean_by_rule(value):
    """The rule in words: drop line feeds, blank out other characters, collapse spaces."""
    if value is None:
        return None
    value = value.replace("\n", "").replace("&nbsp", " ").replace("\t", " ")
    chars = (c.lower() if c in KEPT else " " for c in value)
    return " ".join("".join(chars).split())


def delete_by_rule(value):
    if value is None:
        return None
    value = value.replace("&nbsp;", " ")
    allowed = set(string.printable) - set(string.punctuation) - {"\n"}
    return "".join(c for c in value if c in allowed)


def test_clean_text_edges(values):
    assert values(EDGES, text.clean_text) == [clean_by_rule(v) for v in EDGES]


def test_clean_text_delete_edges(values):
    assert values(EDGES, text.clean_text_delete) == [delete_by_rule(v) for v in EDGES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=20, max_size=40))
def test_clean_text_any(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select("i", text.clean_text(df.x), text.clean_text_delete(df.x)).collect()
    for i, clean, deleted in rows:
        assert clean == clean_by_rule(texts[i])
        assert deleted == delete_by_rule(texts[i])


def test_apostrophes_in_text_are_straightened(values):
    found = values(["isn’t"], lambda x: text.clean_text(text.straighten_apostrophes(x)))
    assert found == ["isn't"]


def test_tokenize_equals_ml(spark):
    rows = [(i, t) for i, t in enumerate(EDGES) if t is not None and t.strip()]
    df = spark.createDataFrame([*rows, (99, "")], "i int, x string")
    both = Tokenizer(inputCol="x", outputCol="ml").transform(df)
    for row in both.select("x", "ml", text.tokenize(F.col("x")).alias("mine")).collect():
        assert row.mine == row.ml, row.x


def test_empty_tokens_and_their_removal(values):
    assert values(["", " a  b"], text.tokenize) == [[""], ["", "a", "", "b"]]
    assert values(["", " a  b"], lambda x: text.drop_empty(text.tokenize(x))) == [[], ["a", "b"]]


def test_drop_numeric(values):
    tokens = ["12.5 . 7 a.b ½ x1"]
    assert values(tokens, lambda x: text.drop_numeric(F.split(x, " "))) == [["ab", "x1"]]
    compat = values(tokens, lambda x: text.drop_numeric(F.split(x, " "), compat=True))
    assert compat == [["125", "", "ab", "x1"]]


def composed_words(x):
    return text.drop_numeric(text.drop_empty(text.tokenize(text.clean_text(x))))


def test_article_words_equal_the_steps(values):
    every = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [*EDGES, "12.5 a.b . 7x '' x'1 &nb.sp", "".join(f"a{c}1 {c}9 " for c in every)]
    assert values(texts, text.article_words) == values(texts, composed_words)


def test_tokenize_alpha(values):
    texts = ["#REDIRECT x", "<b>Bold</b> it's 3 < 4", "a<b\nc>d", " <i> ", "Kelvin", "x<>y>z"]
    by_rule = [re.sub(r"<.+?>|[^a-zA-Z]", " ", t).lower().split() for t in texts]
    assert values(texts, text.tokenize_alpha) == by_rule


def test_stop_words_are_the_default_and_more(spark, values):
    default = StopWordsRemover.loadDefaultStopWords("english")
    assert sorted(default) == sorted(wordlists.ENGLISH_STOP_WORDS)
    kept = values(["The x getty cat ISN'T here"], lambda x: text.remove_stop_words(F.split(x, " ")))
    assert kept == [["cat"]]
    own = values(["the cat"], lambda x: text.remove_stop_words(F.split(x, " "), ["CAT"]))
    assert own == [["the"]]


def test_strip_punctuation(values):
    tokens = values(["a-b c' ..."], lambda x: text.strip_punctuation(F.split(x, " ")))
    assert tokens == [["ab", "c", ""]]


@pytest.mark.parametrize(
    ("word", "single"),
    [("cats", "cat"), ("cities", "city"), ("ties", "tie"), ("boxes", "box"), ("class", "class"),
     ("churches", "church"), ("women", "woman"), ("men", "men"), ("bus", "bus"), ("is", "is"),
     ("as", "as"), ("this", "this"), ("news", "new"), ("glasses", "glass"), ("", "")],
)
def test_singular(values, word, single):
    assert values([word], text.singular) == [single]


def test_ngrams(values):
    def pairs(x):
        return text.ngrams(text.drop_empty(F.split(x, " ")), 2)

    assert values(["a b c", "a", "", "a b"], pairs) == [["a b", "b c"], [], [], ["a b"]]


PAGES = [
    "<html><body>no paragraph</body></html>",
    "<p>One <b>bold</b> <i>and <u>more</u></i></p><p class='x'>Two</p>",
    "<p>open one<p>open two<div>x</div></div>after",
    "<script>var t='</p><p>no';</script><p>real</p>",
    "<!-- <p>hidden</p> --><style>p{}</style><P>UPPER</P>",
    "<p>a &amp; b &lt;c&gt; &quot;d&quot; &copy; &middot; &amp;lt;</p>",
    "<pre>not a paragraph</pre><p>last",
    "<p></p><p>line\nfeed</p>",
    "<p>a</p><script>no end <p>no</p>",
    "<p>a</p><!-- no end <p>no</p>",
]


def test_paragraphs(values):
    assert values(PAGES, text.extract_elements) == [
        [],
        ["One bold and more", "Two"],
        ["open one", "open two"],  # as in browsers, a block ends an open paragraph
        ["real"],
        ["UPPER"],
        ['a & b <c> "d" © · &lt;'],
        ["last"],
        ["", "line\nfeed"],
        ["a"],
        ["a"],
    ]


def test_paragraph_arguments(values):
    page = ["<h1>T</h1><p>a <b>b</b></p><p>c</p>"]
    assert values(page, lambda x: text.extract_text(x, sep=" ")) == ["a b c"]
    assert values(page, text.extract_text) == ["a bc"]
    assert values(page, lambda x: text.extract_text(x, tag="h1")) == ["T"]
    assert values(page, lambda x: text.extract_elements(x, text=False)) == [["a <b>b</b>", "c"]]


def test_numeric_entities(values):
    texts = [
        "it&#39;s &#8217; &#x2019; &#X41; &#36;1 &#92; &#0; &#xD800; &#9999999;", "none", "", "&", "&;",
        "&#38;lt;b", "&#38;#x41;", "&Eacute;t&eacute;", "&hearts; &zwnj;", "&eacute x", "&#0000000065;",
        "&amp;amp;lt;", "&notit; &notin; &amp &am &ampx &unknown; &CounterClockwiseContourIntegral;",
        "&#128; &#x80; &#13; &#x1; &#xFFFE; &#xFDD0; &#x1F600; &#99999999999999999999; &#xfffffffffffffffff;",
        "a&b &lt&gt;&quot&copy2024 &#x; &#; &#65 &#x41g &amp;#65;",
    ]
    assert values(texts, decode_references) == [html.unescape(t) for t in texts]


def test_any_references(values):
    r = random.Random(5)
    parts = [*"&#;xX0129aAfgl ", "amp", "lt;", "not", "&", "&#", "&#x", "eacute", "&copy"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(2000)]
    assert values(texts, decode_references) == [html.unescape(t) for t in texts]


def test_elements_within_one_another(values):
    pages = ["<div>a<div>b</div>c</div><div class=x>d", "</div><p>x</p>", "<div>1</div>2<div>3</div>", "<DIV>&amp;</div>"]
    found = values(pages, lambda x: text.extract_elements(x, "div"))
    assert found == [["abc", "b", "d"], [], ["1", "3"], ["&"]]
    assert values(["<a.b>x</a.b><axb>y</axb>"], lambda x: text.extract_elements(x, "a.b")) == [["x"]]


@pytest.mark.parametrize(
    "tag,page,found",
    [
        ("td", "<table><tr><td><div>x</div>y</td><td>z</table>", ["xy", "z"]),
        ("li", "<ul><li>a<ul><li>b</li></ul>c</li><li>d</ul>", ["abc", "b", "d"]),
        ("p", "<section><p>a</section><h2>Title</h2><p>b</p>", ["a", "b"]),
        ("p", '<p title="a>b">c</p>', ["c"]),
        ("p", "<p title='</p>'>c<br/>d</p>e", ["cd"]),
        ("h2", "<h2>a <p>b</h2>c", ["a b"]),
        ("p", "<div><p>a<span>b</div>c</span><p>d", ["ab", "d"]),
        ("p", "<p>a<table><tr><td><p>b</td><td>c</p></td></tr></table>d</p>", ["a", "b"]),
        ("dd", "<dl><dt>a<dd>b<dl><dt>c<dd>d</dl>e<dt>f</dl>", ["bcde", "d"]),
        ("tr", "<table><thead><tr><th>a<tbody><tr><td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("option", "<select><option>a<option>b</select>c", ["a", "b"]),
        ("b", "<p>x<b>y<b>z</b></b></p>", ["yz", "z"]),
        ("p", "</p><p>a</b></i>b</div>c", ["abc"]),
        ("em", "<em>a</p>b", ["ab"]),
        ("p", "a < b <p>1 < 2</p>", ["1 < 2"]),
    ],
)
def test_elements_as_a_full_parser_has_them(values, tag, page, found):
    assert values([page], lambda x: text.extract_elements(x, tag)) == [found]


def test_any_tree(values):
    """Well-formed trees of any tags: the text under each element, in order of the starts."""
    r = random.Random(8)

    def tree(depth):
        name, parts, whole, inside = r.choice(["div", "span", "b", "section", "i"]), [], [], []
        for _ in range(r.randrange(4)):
            if depth and r.random() < 0.6:
                markup, words, below = tree(depth - 1)
                parts.append(markup)
                whole.append(words)
                inside += below
            else:
                parts.append(r.choice(["x", " y", "z<br>", "<img alt='<div>'>"]))
                whole.append({"x": "x", " y": " y", "z<br>": "z"}.get(parts[-1], ""))
        words = "".join(whole)
        return f'<{name} class="a>b">{"".join(parts)}</{name}>', words, [(name, words), *inside]

    trees = [tree(6) for _ in range(60)]
    for name in ("div", "b"):
        found = values([t[0] for t in trees], lambda x: text.extract_elements(x, name))
        assert found == [[w for n, w in t[2] if n == name] for t in trees]


def test_title(values):
    pages = [
        "<head><TITLE>\nA &amp; B</TITLE></head>", "<p>none</p>",
        "<!--<title>x</title>--><title>real</title>", "<script>'<title>x</title>'</script><title>&Eacute;</title>",
    ]
    assert values(pages, text.page_title) == ["\nA & B", "", "real", "É"]


# Published examples of the algorithm's steps, and the words its extensions are about.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
    "sky": "sky", "skies": "sky", "dying": "die", "news": "news", "innings": "inning",
    "dies": "die", "died": "die", "cried": "cri", "enjoy": "enjoy", "by": "by", "say": "say",
    "theology": "theolog", "geology": "geolog", "yes": "ye", "using": "use", "is": "is",
}


def test_stems(spark):
    df = spark.createDataFrame([(word,) for word in STEMS], "term string")
    found = {row.term: row.stem for row in with_stem(df).collect()}
    assert found == STEMS
