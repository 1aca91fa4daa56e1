"""A batch's codes are read from and written to the state once each."""

import pandas as pd

from ledgerloom.streaming.running_totals import ERROR, REMOVED, Totals


class Handle:
    def __init__(self):
        self.codes, self.value, self.calls = {}, None, 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        outer = self

        class One:
            exists = lambda self: outer.value is not None
            get = lambda self: outer.value
            update = lambda self, v: setattr(outer, "value", v)

        return One()

    def containsKey(self, k):
        self.calls += 1
        return k in self.codes

    def getValue(self, k):
        self.calls += 1
        return self.codes[k]

    def updateValue(self, k, v):
        self.calls += 1
        self.codes[k] = v


def test_state_is_asked_once_a_code():
    def run(batches):
        h = Handle()
        t = Totals(False)
        t.init(h)
        for rows in batches:
            out = [d.iloc[0].tolist() for d in t.handleInputRows(("x",), iter([pd.DataFrame(rows, columns=["pos", "kind", "codes"])]), None)]
        return out[0], h

    rows = [(i, REMOVED if i % 5 == 4 else ERROR, [f"{i % 3:02d}", f"{i % 7:02d}"]) for i in range(300)]
    whole, h = run([rows])
    parts, h2 = run([rows[i : i + 20] for i in range(0, 300, 20)])
    assert whole == parts and h.codes == h2.codes
    assert h.calls <= 7
