from drawlake.llm.common import forget_kept, kept_by_worker


def test_a_worker_keeps_one_table():
    made = []

    def make(name):
        return lambda: made.append(name) or [name]

    forget_kept()
    first = kept_by_worker("a", make("a"))
    assert kept_by_worker("a", make("again")) is first and made == ["a"]
    assert kept_by_worker(("b", 1), make("b")) == ["b"]
    assert kept_by_worker("a", make("a2")) == ["a2"] and made == ["a", "b", "a2"]
    forget_kept()
    assert kept_by_worker("a", make("a3")) == ["a3"]
    forget_kept()
