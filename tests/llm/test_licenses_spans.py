"""License notices that a search over merged windows would lose."""

from sensorflow.llm import licenses


def test_a_notice_with_edits_beside_a_better_one():
    spans = licenses.scan("x relased undr the mit license released under the mit license y")["spans"]
    assert [(s["first"], s["stop"], s["edits"]) for s in spans] == [(1, 6, 2), (6, 11, 0)]
    many = " ".join(["released under the mit license", "relased under the mit license", "z"] * 50)
    assert [s["edits"] for s in licenses.scan(many)["spans"]] == [0, 1] * 50


def test_long_texts_are_linear():
    import time
    began = time.time()
    found = licenses.scan("cc by " * 400000)
    assert found["n_base"] == 400000 and (found["first_word"], found["last_word"]) == (0, 799998)
    found = licenses.scan("xx released under the mit lisense " * 8000)
    assert [(s["first"], s["stop"]) for s in found["spans"]] == [(6 * i + 1, 6 * i + 6) for i in range(8000)]
    assert time.time() - began < 30
