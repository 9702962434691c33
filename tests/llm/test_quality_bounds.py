"""Bounds of the quality rules."""

from regwise.llm import quality


def test_three_of_ten_lines_may_repeat():
    def failed(same):
        text = "\n".join(["the same heading"] * (same + 1) + [f"line {i}" for i in range(9 - same)])
        return eval(quality.RULES["repeated_lines"], {}, dict(zip(quality.MEASURES, quality.measure(text))))
    assert not failed(3) and failed(4)
