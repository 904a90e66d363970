"""Memory that a worker gives back at the end of a task."""

from lakeshore.llm import common


def test_batches_pass_and_memory_is_given_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "_give_back", lambda: given.append(True))
    out = common.releasing(lambda batches: (b * 2 for b in batches))(iter([1, 2, 3]))
    assert next(out) == 2 and not given
    assert list(out) == [4, 6] and given == [True]


def test_memory_can_be_given_back():
    common._give_back()
