"""Pure kernels: HTML blocks, chunk ranges, stems, cover density, prompts' parts."""

import random

import numpy as np
import pytest

from corpusloom.functions import embedding, html_blocks
from corpusloom.functions.chunking import chunk_blocks, chunk_ranges
from corpusloom.functions.stemming import stem
from corpusloom.operators.dataset import topic_threshold
from corpusloom.operators.retrieval import clamp_top_k, cover_density, english_lexemes
from corpusloom.sources.sinks import identifier


def test_generic_page():
    page = "<html><body><nav><li>menu</li></nav><article><h1>Top</h1><p>One <b>two</b>&amp; three</p><div class='NavBox x'><p>gone</p></div><h2>Sub</h2><pre>a  \n\n b</pre><ul><li>x<li>y</ul></article></body></html>"
    got = html_blocks.normalize("http://example.com/a", page.encode())
    assert [(b["kind"], b["text"]) for b in got["blocks"]] == [("Heading", "Top"), ("Paragraph", "One two& three"), ("Heading", "Sub"), ("Preformatted", "a\n b"), ("ListItem", "x"), ("ListItem", "y")]
    assert [s["title"] for s in got["chunks"][0]["section_path"]] == ["Top", "Sub"] and len(got["chunks"]) == 1
    for b in got["blocks"]:
        assert got["body_text"].encode()[b["char_start"] : b["char_end"]].decode() == b["text"]


def test_wiki_page():
    page = """<body><div id="mw-content-text"><div class="mw-parser-output"><table class="infobox"><p>box</p></table><h2>Head</h2><p>Lead<sup>1</sup>  text&nbsp;here</p>
    <div class="thumb"><img class="thumbimage"><p>pic</p></div><ul><li>outer<p>inner</p></li></ul><pre> x
  y </pre><div class="toclimit-3"><p>toc</p></div></div></div><p>footer</p></body>"""
    tree = html_blocks.wiki_blocks_tree(page)
    assert [(b["type"], b["text"]) for b in tree] == [("heading", "Head"), ("paragraph", "Lead text here"), ("list_item", "outerinner"), ("paragraph", "inner"), ("code", "x\n  y")]
    assert all(b["section_path"] == ["Head"] for b in tree) and [b["index"] for b in tree] == list(range(5))
    streamed = html_blocks.wiki_blocks_streamed(page)
    assert [b["text"] for b in streamed] == ["Head", "Lead text here", "inner", "outer", "x\n  y"]
    assert [b["text"] for b in html_blocks.wiki_blocks_tree("<body><div>only  text</div></body>")] == ["only text"]


GOLDENS = {
    "content in the body's content element": ('<body><div id="bodyContent"><p>A short page.</p></div><p>outside</p></body>', ["A short page."]),
    "a lead beside an infobox": ('<body><div id="mw-content-text"><table class="infobox"><tr><td><p>box</p></td></tr></table><p>Lead  text<sup>[1]</sup> goes on.</p></div></body>', ["Lead text goes on."]),
    "no structure at all": ("<body><div>Only a\n division  here.</div></body>", ["Only a division here."]),
    "references and a navigation box": (
        '<body><div id="mw-content-text"><p>Body.</p><div class="references"><ol><li>ref</li></ol></div><div class="navbox"><ul><li>nav</li></ul></div></div></body>',
        ["Body."],
    ),
    "sections and a list": ('<body><div class="mw-parser-output"><h2>Part</h2><p>Words.</p><ul><li>one</li><li>two</li></ul></div></body>', ["Part", "Words.", "one", "two"]),
    "contents, hatnote and thumb": (
        '<body><div id="mw-content-text"><div class="shortdescription"><p>short</p></div><div class="hatnote"><p>hat</p></div><div class="toc"><ul><li>1</li></ul></div><div class="thumb"><p>pic</p></div><p>Real.</p></div></body>',
        ["Real."],
    ),
    "messages, side bars and void images": (
        """<body><div class="vector-toc-list"><li>toc</li></div><div class="mw-parser-output"><div class="toclimit-2"><li>toc</li></div><table class="ambox"><tr><td><p>message</p></td></tr></table>
        <div class="sidebar"><p>side</p></div><div class="thumb"><img class="thumbimage" src="x"><p>pic</p></div><h1>Title</h1><p>First.</p><ul><li>item</li><li>item two<sup>2</sup></li></ul>
        <div class="mw-collapsible-content"><p>closed</p></div><p>Last.</p><div class="references"><li>r</li></div></div><footer><p>foot</p></footer></body>""",
        ["Title", "First.", "item", "item two", "Last."],
    ),
}


@pytest.mark.parametrize("name", sorted(GOLDENS))
def test_golden_pages(name):
    page, want = GOLDENS[name]
    assert [b["text"] for b in html_blocks.wiki_blocks_tree(page)] == want
    assert html_blocks.wiki_text(page) == "\n".join(want)
    assert [b["text"] for b in html_blocks.wiki_blocks_streamed(page)] == want  # no block within a block here


def test_inline_cases():
    many = "<article><h1>T</h1>" + "".join(f"<p>five words are in p{i}</p>" for i in range(20)) + "</article>"
    chunks = html_blocks.normalize("http://a.b/", many.encode(), target=30, overlap=10)["chunks"]
    assert len(chunks) > 1 and all(a["char_end"] >= b["char_start"] for a, b in zip(chunks, chunks[1:], strict=False))
    skip = html_blocks.normalize("http://a.b/", b"<p>a</p><div class='Navbox-inner'><ul><li>gone</li></ul></div><p class='navbox'>b</p>")
    assert [b["text"] for b in skip["blocks"]] == ["a", "b"]
    wiki = html_blocks.normalize("https://en.wikipedia.org/wiki/X", b"<div id='mw-content-text'><div class='mw-parser-output'><h2>Head</h2><p>a &amp; b</p><li>c</li></div></div>")
    assert [(b["kind"], b["text"]) for b in wiki["blocks"]] == [("Heading", "Head"), ("Paragraph", "a & b"), ("ListItem", "c")] and wiki["blocks"][0]["section_path"] == [{"level": 1, "title": "Head"}]
    kept = html_blocks.normalize("http://a.b/", b"<article><nav><li>menu</li></nav><p>x</p></article>")
    strict = html_blocks.normalize("http://a.b/", b"<article><nav><li>menu</li></nav><p>x</p></article>", strict_boilerplate=True)
    assert [b["text"] for b in kept["blocks"]] == ["menu", "x"] and [b["text"] for b in strict["blocks"]] == ["x"]


def test_empty_and_broken_pages():
    assert html_blocks.normalize("http://a.b/", None)["error"] == "empty body"
    bad = html_blocks.normalize("http://a.b/", b"<p>\xff</p>")
    assert bad["lossy_decoding"] and bad["blocks"][0]["text"] == "�"


def brute_chunks(tokens, target, overlap):
    """The rule block by block, with a list that is cut down to its shortest sufficient tail."""
    overlap = min(overlap, target - 1)
    out, held = [], []
    for i, n in enumerate(tokens):
        held.append((i, n))
        if sum(x for _, x in held) >= target:
            out.append((held[0][0], i))
            tail = []
            while overlap and held and sum(x for _, x in tail) < overlap:
                tail.insert(0, held.pop())
            held = tail
    if held:
        out.append((held[0][0], held[-1][0]))
    return out


def test_chunk_ranges():
    assert chunk_ranges([20, 2, 2], 10, 3) == [(0, 0), (0, 1), (0, 2), (1, 2)]
    rng = random.Random(1)
    for _ in range(2000):
        tokens = [rng.randrange(1, 30) for _ in range(rng.randrange(15))]
        target, overlap = rng.randrange(1, 40), rng.randrange(0, 45)
        assert chunk_ranges(tokens, target, overlap) == brute_chunks(tokens, target, overlap)


def test_chunk_fields():
    blocks = [{"block_index": i, "text": t, "char_start": 3 * i, "char_end": 3 * i + 1, "token_estimate": 1, "section_path": [i]} for i, t in enumerate("abc")]
    one = chunk_blocks(blocks, 2, 0)
    assert [(c["chunk_id"], c["text"], c["block_index"], c["char_start"], c["char_end"], c["section_path"]) for c in one] == [(0, "a\n\nb", 0, 0, 4, [1]), (1, "c", 2, 6, 7, [2])]


@pytest.mark.parametrize(
    ("word", "root"),
    [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("hopping", "hop"), ("hoping", "hope"), ("relational", "relat"), ("happily", "happili"), ("generously", "generous"), ("skies", "sky"), ("running", "run"), ("national", "nation"), ("electricity", "electr"), ("be", "be"), ("gas", "gas"), ("kiwis", "kiwi")],
)
def test_stems(word, root):
    assert stem(word) == root


def test_cover_density():
    assert cover_density([np.array([1]), np.array([2])]) == pytest.approx(0.1)
    assert cover_density([np.array([1]), np.array([5])]) == pytest.approx(0.1 / 4)
    assert cover_density([np.array([1, 10]), np.array([2, 11])]) > cover_density([np.array([1]), np.array([2])])
    assert english_lexemes("The cats and the Dogs") == [("cat", 2), ("dog", 5)]


def test_embedding_calls():
    waits, left = [], [2]

    class Flaky(embedding.HashingClient):
        def embed_batch(self, texts):
            if left[0]:
                left[0] -= 1
                raise embedding.RetryableError
            return super().embed_batch(texts)

    got = embedding.call(Flaky(8), ["a b", ""], sleep=waits.append)
    assert waits == [0.5, 1.0] and sum(x * x for x in got[0]) == pytest.approx(1) and got[1] == [0.0] * 8
    left[0] = 9
    with pytest.raises(embedding.RetryableError):
        embedding.call(Flaky(8), ["a"], 3, sleep=waits.append)


def test_parameters():
    assert [clamp_top_k(k) for k in (None, 0, 3, 99)] == [5, 1, 3, 12]
    assert [topic_threshold(n) for n in (0, 1, 2, 5, 6, 10)] == [1, 1, 2, 2, 3, 4]
    assert identifier("db.table_1") == "`db`.`table_1`"
    with pytest.raises(ValueError):
        identifier("a; drop")
