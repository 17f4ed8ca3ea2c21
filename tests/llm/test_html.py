import html
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import main_text as M
from tidemark.llm.html_blocks import Block, Path, blocks
from tidemark.llm.labelled_pages import labelled_page


@pytest.fixture(scope="module")
def field():
    return M.train()


def test_held_out_pages(field):
    wrong = total = 0
    for seed in range(50_000, 50_200):
        page, labels = labelled_page(seed)
        got = field.label(blocks(page), {})
        wrong += sum(a != bool(b) for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.01


def test_pages_of_the_table(spark, field):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    held = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in M.extract(pages, field).collect():
        article = re.search("<article>(.*)</article>", held[r["page_id"]], re.S)[1]
        parts = [re.sub(r"<[^>]*>", " ", p) for p in re.split("</?p>|</?h1>", article)]
        wanted = "\n\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))
        assert (r["text"], r["n_chars"]) == (wanted, len(wanted))


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("plain", ["plain"]),
        ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
        ("<script>var a = '</p>';</script><style>p{}</style><!-- x <p> -->a", ["a"]),
        ("<div title='a>b' class=\"x\">t &amp; &lt;u&gt; &#233;</div>", ["t & <u> é"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("a < b <3 </ x>c", ["a < b <3 c"]),
        ("<b>a</b>b <i>c", ["ab c"]),
        ("<p>open <script>never closed <p>x", ["open"]),
        ("<div class='a", []),
        ("<!-- never closed <p>x</p>", []),
        ("x" * 200_000 + "<p>" * 300 + "y", ["x" * 200_000, "y"]),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_deep_pages_end(field):
    assert M.extract_page("<div>" * 20_000 + "<p>Some text is here to be read.</p>", field, {}) is not None


@pytest.mark.parametrize(
    "page, text",
    [
        (
            "<header><a href=/>Site</a></header><nav><a>a</a></nav><div class=content><h1>T</h1><p>Hello world, "
            "this is text.</p><div class='ad'>Buy now stuff today.</div><p>More text here.</p><section "
            "class='comments'><h3>Comments</h3><p>I really like this article a lot.</p></section></div>"
            "<aside>Related things here.</aside><footer>x</footer>",
            "T\n\nHello world, this is text.\n\nMore text here.",
        ),
        (
            "<main><h1>Title</h1><p>Body text one two.</p><aside><p>Side note here.</p></aside><p>Last one.</p>"
            "</main><div id=comments><p>Nice post, I agree with all of it.</p></div>",
            "Title\n\nBody text one two.\n\nLast one.",
        ),
        ("<article><p>a &lt;b&gt; <em>c</em>d</p><form><p>Subscribe to it.</p></form></article>", "a <b> cd"),
    ],
)
def test_the_article_is_told_apart(field, page, text):
    assert M.extract_page(page, field, {}) == text


def test_odd_pages(spark, field):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some text.</p></article>"), (2, None, "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in M.extract(frame, field).collect())
    assert got == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("None", "Some text.", 10)]
    assert M.extract(frame.limit(0), field).count() == 0
    wide = frame.withColumns({"text": F.lit("own"), "n_chars": F.lit(-1)})
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in M.extract(wide, field).collect()) == got


def test_a_small_field_learns():
    small = M.train(n_pages=30, rounds=60)
    page, labels = labelled_page(3)
    assert sum(a != bool(b) for a, b in zip(small.label(blocks(page), {}), labels)) <= len(labels) * 0.1


def chains(rng, n):
    """Scores of a page's labels, of moves, and each way to label it with its score."""
    node = np.stack([np.zeros(n), rng.normal(size=n)], axis=1)
    t, kind = rng.normal(size=(2, 2, 2)), rng.integers(0, 2, n)
    ways = []
    for labels in itertools.product((0, 1), repeat=n):
        moves = sum(t[kind[i], labels[i - 1], labels[i]] for i in range(1, n))
        ways.append((labels, sum(node[i, x] for i, x in enumerate(labels)) + moves))
    return node, t, kind, ways


def test_forward_backward_is_the_sum_over_all_labels():
    rng = np.random.default_rng(4)
    for sizes in ([1], [4, 1, 6], [5]):
        t = rng.normal(size=(2, 2, 2))
        parts = []
        for n in sizes:
            node, _, kind, _ = chains(rng, n)
            parts.append((node, kind))
        node, kind = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        size = np.array(sizes)
        first = np.cumsum(size) - size
        chance, pair = M.posterior(node, t, kind, first, size)
        pairs = iter(pair)
        for begin, n in zip(first, sizes, strict=True):
            weights = {}
            for labels in itertools.product((0, 1), repeat=n):
                score = sum(node[begin + i, x] for i, x in enumerate(labels))
                score += sum(t[kind[begin + i], labels[i - 1], labels[i]] for i in range(1, n))
                weights[labels] = np.exp(score)
            total = sum(weights.values())
            for i in range(n):
                assert chance[begin + i] == pytest.approx(sum(w for x, w in weights.items() if x[i]) / total)
                if i:
                    held = next(pairs)
                    for a, b in itertools.product((0, 1), repeat=2):
                        wanted = sum(w for x, w in weights.items() if (x[i - 1], x[i]) == (a, b)) / total
                        assert held[a, b] == pytest.approx(wanted)


def test_viterbi_is_the_best_of_all_labels():
    rng = np.random.default_rng(5)
    paths = [Path("p", frozenset([f"n{k}"]), frozenset()) for k in range(2)]
    for trial in range(60):
        n = int(rng.integers(1, 8))
        owners = [paths[int(k)] for k in rng.integers(0, 2, n)]
        page = [Block(f"word {i}", p, 0) for i, p in enumerate(owners)]
        names = {f for i, b in enumerate(page) for f in M.path_features(b) + M.text_features(b, i, n)}
        field = M.Field({f: float(rng.normal()) for f in sorted(names)}, rng.normal(size=(2, 2, 2)))
        own = [sum(field.weight[f] for f in M.path_features(b) + M.text_features(b, i, n)) for i, b in enumerate(page)]

        def score(labels):
            moves = sum(
                field.transition[int(owners[i] is owners[i - 1]), labels[i - 1], labels[i]] for i in range(1, n)
            )
            return moves + sum(x for x, label in zip(own, labels, strict=True) if label)

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert field.label(page, {}) == [bool(x) for x in best]


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>a</p><!--><p>b</p><!---><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><!-- x --!><p>b</p><!-- y --><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><!-- x -- > <p>b</p> --><p>c</p>", ["a", "c"]),
        ("<p don't>a</p><p>b isn't</p><p>c</p>", ["a", "b isn't", "c"]),
        ("<p title=don't>a</p><p title = 'x > y' id=\"u'v\">b</p>c", ["a", "b", "c"]),
        ("<p a='x'b=\"y>z\">a</p><p =' >b</p>", ["a", "b"]),
    ],
)
def test_comments_and_attributes_end_as_in_html(page, texts):
    assert [b.text for b in blocks(page)] == texts


@pytest.mark.parametrize(
    "page",
    [
        "<span>" * 50_000 + "<p>a</i>" * 50_000,
        "<div>" * 50_000 + "<li>a" * 50_000,
        "<a><div>" + "<span>" * 50_000 + "<a>b</a>" * 50_000,
        "<table>" * 50_000 + "<td>a" * 50_000,
        "<p x='" * 20_000,
        "<!-- " * 50_000,
    ],
)
def test_many_open_elements_take_seconds(page):
    start = time.perf_counter()
    blocks(page)
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>" + "İ" * 40 + "</p><script>x</SCRIPT><p>one</p><p>two</p><p>three</p>", ["İ" * 40, "one", "two", "three"]),
        ("<p>a</p><svg><path><p>b</p><svg><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><template><p>b</p>", ["a", "b"]),
        ("<p>a <svg><text>n</text></svg>b</p><template><p>c</p></template>d", ["a b", "d"]),
        ("<p>where <math><mi>x</mi></math> is</p><object data=f><p>no player</p></object>", ["where x is", "no player"]),
        ("<p>a</p><math><mi>x<p>b</p><object><p>c</p>", ["a", "x", "b", "c"]),
        ("<script>'</ſcript>'</script>a", ["a"]),
    ],
)
def test_raw_elements_end_where_they_end(page, texts):
    assert [b.text for b in blocks(page)] == texts
