import pytest

from corpusloom.llm.html_text import extract_text, visible_text
from corpusloom.llm.queries import op7_visible_text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("<ul><li>a<li>b</ul>", "- a\n- b"),
        ("<ol start=3><li>a</li><li>b</li></ol>", "3. a\n4. b"),
        ("<ul><li>a<ul><li>b</ul></ul>", "- a\n  - b"),
        ("<script>var x = '<p>'</script>seen<style>p{}</style>", "seen"),
        ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
        ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b></div>", "yes"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("a <!-- b --> c", "a c"),
        ("a < b <p", "a < b <p"),
        ("a<!-->b<!-- c > d", "ab"),
        ("a<math><mi>x</mi><annotation>no</annotation></math>b", "axb"),
        ("a<select><option>Red<option>Blue</select>b", "a Red b"),
        ("a<select><optgroup label=g><option>Red<option selected>Blue</select>b", "a Blue b"),
        ("a<select multiple><option>Red<option>Blue</select>b", "a\nRed\nBlue\nb"),
        ("a<select></select>b", "a b"),
        ("a<textarea>x &lt;b&gt;</textarea>b", "a x <b> b"),
        ("a<svg><defs/><title>no</title><text>l1</text><text>l2</text><desc>no</desc></svg>b", "a l1 l2 b"),
        ("<desc>seen</desc>", "seen"),
    ],
)
def test_layout(html, text):
    assert visible_text(html).strip("\n") == text


def test_table_cells_are_aligned():
    lines = visible_text("<table><tr><th>name<th>n<tr><td>a longer name<td>12</table>").strip("\n").split("\n")
    assert len(lines) == 2
    assert lines[0].index("n", 5) == lines[1].index("12")


def test_long_cells_widen_their_column():
    long = "x" * 70
    lines = visible_text(f"<table><tr><td>{long}<td>one<tr><td>b<td>two</table>").strip("\n").split("\n")
    assert lines == [f"{long}  one", "b" + " " * 71 + "two"]


def test_spanning_cells_and_nested_tables_keep_their_columns():
    page = "<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3<tr><td><table><tr><td>i</table><td>4<td>5</table>"
    assert visible_text(page).strip("\n").split("\n") == ["ab     c", "1   2  3", "i   4  5"]


def test_padding_is_bounded_by_the_text():
    page = "<table><tr><td>" + "x" * 100_000 + "<td>one" + "<tr><td>b<td>two" * 20_000 + "</table>"
    text = visible_text(page)
    assert text.count("x") == 100_000 and text.count("two") == 20_000
    assert len(text) < 20 * len(page) + 100_000


def test_deep_and_long_pages_end():
    assert "x" in visible_text("<div>" * 50_000 + "x")
    assert visible_text("<b>word </b>" * 50_000).count("word") == 50_000


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "<p>a", 0), (None, "<p>a", 0), (1, "<p>a", 0), (2, None, 0), (3, "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text int")
    found = sorted(map(tuple, extract_text(pages).collect()), key=str)
    assert found == sorted([(1, "a"), (None, "a"), (1, "a"), (2, None), (3, "")], key=str)
    assert extract_text(pages.limit(0)).collect() == []


def test_query(spark, small_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    found = {r["page_id"]: r["text"] for r in op7_visible_text(spark, small_dir).collect()}
    assert found == {key: visible_text(html) for key, html in pages.items()}
