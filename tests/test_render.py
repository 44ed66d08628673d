from __future__ import annotations

from foliospark.functions.render import Tree, document, table
from foliospark.operators.assemble import free_names


def node(kind, text="", children=(), **more):
    return {"node_type": kind, "text": text, "children": list(children), **more}


def test_table():
    cells = [{"row": 0, "col": 0, "content": "a|b"}, {"row": 1, "col": 1, "content": "x\ny"}, {"row": 1, "col": 1, "content": "last"}, {"row": 9, "col": 0, "content": "out"}]
    assert table({"rows": 2, "cols": 2, "cells": cells}) == "| a\\|b |  |\n| --- | --- |\n|  | last |"
    assert table({"rows": 2, "cols": 2, "cells": []}) == table(None) == ""


def test_tree():
    nodes = [
        node("heading", heading_text="Top", heading_level=1),
        node("group", heading_text="Part", heading_level=3, children=[2, 3, 99]),
        node("heading", heading_text="hidden"),
        node("paragraph", "  body‎ "),
        node("list", children=[5, 6]),
        node("list_item", "one"),
        node("list_item", " "),
        node("image", description="a cat"),
        node("image"),
        node("strange", "x"),
        node("table", grid={"rows": 1, "cols": 1, "cells": [{"row": 0, "col": 0, "content": "c"}]}),
    ]
    assert document(nodes, "flat") == "# Top\n\n### Part\n\nbody\n\n- one\n\n<!-- image -->\na cat\n\n<!-- image -->\n\n| c |\n| --- |".replace("body", "body‎").replace("‎", "")
    assert Tree(nodes).roots() == [0, 1, 4, 7, 8, 9, 10]


def test_fallbacks_and_depth():
    assert document([], "flat", [" t1 ", "", "t2"]) == "t1\n\nt2"
    assert document([], "flat", ["t"], table_fallback=False) == "flat"
    assert document([node("paragraph", " ")], "flat") == "flat"
    deep = [node("list", children=[i + 1]) for i in range(40)]
    for end, text in ((30, "x"), (31, "")):
        nodes = [*deep[:end], node("paragraph", "x")]
        assert Tree(nodes).walk([0]) == text


def test_free_names():
    assert free_names(["a.pdf", "a.pdf", "a_1.pdf", "a.pdf"]) == ["a.pdf", "a_1.pdf", "a_1_1.pdf", "a_2.pdf"]
    assert free_names(["a"], taken=["a"]) == ["a_1"]
