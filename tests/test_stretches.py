"""State of streams by stretches of heights, over states held in memory."""

from __future__ import annotations

import pandas as pd

from blocklake.streaming import stream as S


class State:
    """A map state that counts its calls."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def keys(self):
        return iter(list(self.rows))

    def iterator(self):
        return iter(list(self.rows.items()))

    def containsKey(self, k):  # noqa: N802
        self.calls += 1
        return k in self.rows

    def getValue(self, k):  # noqa: N802
        self.calls += 1
        return self.rows[k]

    def updateValue(self, k, v):  # noqa: N802
        self.calls += 1
        self.rows[k] = v

    def removeKey(self, k):  # noqa: N802
        self.calls += 1
        del self.rows[k]


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *schemas):  # noqa: N802
        return self.states.setdefault(name, State())

    def getValueState(self, name, *schemas):  # noqa: N802
        return self.states.setdefault(name, Value())

    def calls(self):
        return sum(s.calls for s in self.states.values() if isinstance(s, State))


def fed(processor, batches):
    handle, out = Handle(), []
    processor.init(handle)
    for heights in batches:
        pdf = pd.DataFrame([(n, f"h{n}", f"h{n - 1}" if n % 5000 else "lost") for n in heights], columns=["number", "hash", "parent_hash"])
        out += [r for got in processor.handleInputRows(("c",), iter([pdf[i : i + 10_000] for i in range(0, len(pdf), 10_000)]), None) for r in got.itertuples(index=False, name=None)]
    return out, handle.calls()


def test_calls_to_the_state_are_by_stretch(monkeypatch):
    heights = range(1, 40_001)
    out, calls = fed(S._Finality(10, "chain", "number"), [[*heights[:20_000], *heights[:20_000:3]], heights[20_000:]])
    assert [r[1] for r in out] == list(range(1, 39_991)) and {r[3] for r in out} == {"final"}
    assert calls < 400
    for held in (200_000, 3_000):
        monkeypatch.setattr(S, "HELD", held, raising=False)
        out, calls = fed(S._Continuity("chain", "number", {"c": (0, "h0")}, 1 << 40), [heights[k::4] for k in (1, 3, 0, 2)])
        assert [(r[1], r[3], r[4]) for r in out] == [(n, "lost", "broken") for n in range(5000, 40_001, 5000)]
        assert calls < 1_000
