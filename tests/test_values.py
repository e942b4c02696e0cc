"""File names, URLs, HTML and nested values."""

from pyspark.sql import functions as F

from noticeflow.functions import html, names, nested

T = F.col("t")


def test_url_id(evaluate):
    given = ["a?opportunityId=12&opportunityId=34", "a", "opportunityId=12ab", "opportunityId="]
    assert evaluate(given, names.url_id(T)) == ["12", None, "12", None]


def test_link_needs_three_pieces(evaluate):
    given = ["go", "go('/a')", "go('/a','b')"]
    assert evaluate(given, names.link_target(T, "http://h")) == [None, "http://h/a", None]


def test_names(evaluate):
    base = names.document_base(F.lit(12), F.lit("34"), F.lit("202103"))
    name = names.document_name(base, F.lit(2), names.extension(T))
    assert evaluate(['attachment; filename="a.b.pdf'], name) == ["proposiciones_12_34_202103_2.pdf"]
    parsed = names.parse_document_name(T)
    got = evaluate(
        ["d/proposiciones_12_34_20213_7.zip"],
        *[parsed[f] for f in ("name", "opp", "code", "year", "month", "seq", "archive")],
    )
    file = "proposiciones_12_34_20213_7.zip"
    assert got == [
        (file, "12", "34", "2021", "03", "7", f"Acta_Presentacion_Y_Proposiciones/2021/03/{file}")
    ]
    assert evaluate(["a.b.c", "a", "ñ.ñó.1"], names.without_extensions(T)) == ["a", "a", "ñ"]


PAGE = """<table><tr><td class="l"> Acta de presentación</td><td><A
 onclick="go('/a/b')" href=x>1</a><a href='q' onclick='go("/c")'>2</a></td></tr>
<tr><td>Otra</td><td><a onclick=stop>3</a></td></tr>
<tr><td>No: <b>Acta de presentac</b></td><td><a onclick="n">4</a></td></tr></table>
<p><strong><a href="http://h/ExpedientesPublicados2021.zip">d</a><a href="http://h/o.zip">o</a></strong>"""


def test_html(evaluate):
    got = evaluate(
        [PAGE], html.row_attributes(T, "Acta de presentac"), html.row_attributes(T, "Otra"),
        html.strong_links(T, "ExpedientesPublicados2021"), html.inner_texts(T, "strong"),
    )
    assert got == [
        (["go('/a/b')", 'go("/c")'], ["stop"], ["http://h/ExpedientesPublicados2021.zip"], ["do"])
    ]


def _spans(*pairs):
    return F.array(
        *[
            F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit("X").alias("label"))
            for a, b in pairs
        ]
    )


def test_realign(evaluate):
    moved = nested.realign_entities(T, _spans((0, 7), (0, 7), (9, 11), (7, 9)))
    got = evaluate(["Grupo Á, de 😀 Grupo A"], moved)[0]
    assert got["text"] == "Grupo A de Grupo A"
    # The last span is ", ", which cleaning empties: found at the start.
    assert [tuple(e) for e in got["entities"]] == [
        (0, 7, "ORG"), (0, 7, "ORG"), (8, 10, "ORG"), (0, 0, "ORG"),
    ]
    assert got["lost"] == 0


def test_lost_entity(evaluate):
    # The mark joins the letter before it in the whole text, not in the piece.
    got = evaluate(["xño"], nested.realign_entities(T, _spans((1, 2))))[0]
    assert (got["text"], got["entities"], got["lost"]) == ("x o", [], 1)


def test_numbered_keys(evaluate):
    values = F.split(T, ",")
    assert evaluate(["a,b,c"], nested.numbered_keys(F.lit("k"), values)) == [
        {"k": "a", "k_2: ": "b", "k_3: ": "c"}
    ]
    assert evaluate(["x"], nested.megabytes(F.lit(1572864))) == [1.5]


def _nested(rng, depth, names):
    """A random table: its HTML and, per outermost row, whether it has the label and its anchors."""
    rows, page = [], "<TABLE border=1>"
    for _ in range(rng.randint(0, 3)):
        anchors, labelled, cells = [], False, ""
        for _ in range(rng.randint(0, 3)):
            kind = rng.random()
            if kind < 0.25 and depth:
                inner, own = _nested(rng, depth - 1, names)
                cells += f"<td>x{inner}</td>"
                anchors += [a for _, found in own for a in found]
                labelled |= any(label for label, _ in own)
            elif kind < 0.45:
                cells, labelled = cells + "<td class=c> the Label here</td>", True
            else:
                name = f"n{next(names)}"
                cells += f"<td><a href='#' onclick='{name}'>y</a></td>"
                anchors.append(name)
        page += f"<tr id='r'>{cells}" + rng.choice(["</tr>", "</TR >", ""])
        rows.append((labelled, anchors))
    return page + "</table>", rows


def test_rows_around_other_tables(evaluate):
    import itertools
    import random

    rng, pages, want = random.Random(8), [], []
    for _ in range(60):
        names = itertools.count()
        parts = [_nested(rng, 3, names) for _ in range(rng.randint(1, 3))]
        pages.append("<p>".join(p for p, _ in parts))
        want.append([a for _, rows in parts for labelled, anchors in rows if labelled for a in anchors])
    assert evaluate(pages, html.row_attributes(T, "Label")) == want
    assert sum(map(len, want)) > 50
    odd = ["", "<tr", "<tr><td>Label<a onclick=a>", "</table></tr><a onclick=b>", "<track><td>Label<a onclick=c>"]
    assert evaluate(odd, html.row_attributes(T, "Label")) == [[], [], ["a"], [], []]
    assert evaluate([None], html.row_attributes(T, "Label")) == [None]
