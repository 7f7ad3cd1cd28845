from keelgraph.llm.pieces import cuts


def test_boundary_far_from_the_middle():
    text = "a" * 44 + "$$" + "x" * 402 + "$$" + "c" * 112
    assert len(text) == 562 and [a for a, _, _ in cuts(text)] == [0, 450]
    assert [a for a, _, _ in cuts("a" * 60 + "。" + "b" * 460)] == [0, 61]
    table = "c" * 112 + "<table>" + "y" * 392 + "</table>" + "d" * 43
    assert [a for a, _, _ in cuts(table)] == [0, 112]


def test_bare_cut_only_without_any_boundary():
    text = "z" * 20 + " " + "z" * 5_000 + " " + "z" * 20
    pieces = cuts(text)
    assert {21, 5022} <= {a for a, _, _ in pieces} and all(b - a <= 462 for a, _, b in pieces)
