"""What one operator's tasks keep in a worker is let go when another's run there."""

from sparkfold.llm.worker import keep_only


def test_only_one_owner_keeps():
    first = keep_only("a")
    first["x"] = [1]
    assert keep_only("a") is first and first == {"x": [1]}
    other = keep_only("b")
    assert other == {} and first == {} and keep_only("a") == {}
