"""Equal inputs and equal rows are matched once, however many there are."""

from ledgerloom.operators import address_match
from test_matches import INPUT, ROW, brute


def test_equal_addresses_are_compared_once(spark, monkeypatch):
    rows = [(n, "12 N OAK DR" if n % 2 else "7 BAY", "ESTERO", None, "339011234") for n in range(60)]
    inputs = [(i, "OAK DR" if i % 3 else "7 B", None if i % 2 else "", None, "") for i in range(30)]
    sizes, matching = [], address_match._matching

    def counted(asked, places):
        sizes.append((asked.count(), places.count()))
        return matching(asked, places)

    monkeypatch.setattr(address_match, "_matching", counted)
    got = {tuple(x) for x in address_match.address_matches(spark.createDataFrame(inputs, INPUT), spark.createDataFrame(rows, ROW), 3).collect()}
    assert got == brute(inputs, rows, 3) and len(got) == 90
    assert sizes == [(4, 2)]
