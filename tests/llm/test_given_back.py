"""Python tasks give the memory they have freed back to the system."""

from clearlot.llm import common


def test_freed_memory_is_given_back_when_a_task_ends(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = common.then_given_back(iter(["a", "b"]))
    assert next(batches) == "a" and not released
    assert list(batches) == ["b"] and released == [True]
