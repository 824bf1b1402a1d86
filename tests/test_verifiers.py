"""Verifiers, gates and batch rewards."""

from __future__ import annotations

import pytest

from lumenfold.functions.verifiers import Registry, reward_batch, route


def wrap(text):
    return f"<think>because</think><answer>{text}</answer>"


def test_rewards(spark, tmp_path):
    rows = [
        ("m", wrap("\\boxed{1,000}"), "1000"),
        ("m", wrap("<|begin_of_box|>7<|end_of_box|>"), "8"),
        ("o", wrap("abcd"), "abce"),
        ("g", wrap("Paris; Rome"), "rome, paris"),
        ("c", wrap("1999"), "2000"),
        ("m", "no tags", "1"),
        ("m", wrap("5"), None),
        ("m", None, "5"),
        ("m", wrap(" "), "5"),
    ]
    df = spark.createDataFrame(rows, "datasource string, answer string, gt_answer string")
    found = reward_batch(df, Registry({"m": "math", "o": "ocr", "g": "geography", "c": "chart"}))
    got = [(r.reward, r.gate) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1.0, None), (0.0, None), (0.75, None), (1.0, None), (0.0, None), (0.0, "format"), (0.0, "truth"), (0.0, "format"), (0.0, "extract")], key=str)
    route(found, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where("status = 'correct'").count() == 2


def test_unknown_verifier():
    with pytest.raises(ValueError, match="no verifier"):
        Registry({"x": "nothing"})
