"""Byte ranges of text files: records and numbers equal a plain read, wherever ranges end."""

import io
import random

import pytest

from ledgerloom.sources import splits


def plain(text: bytes, quoted: bool):
    out, own, inside = [], bytearray(), False
    for b in text:
        if b == 34 and quoted:
            inside = not inside
        if b == 10 and not inside:
            out.append(bytes(own))
            own = bytearray()
        else:
            own.append(b)
    out = [x[:-1] if x.endswith(b"\r") else x for x in out] + ([bytes(own)] if own else [])
    return [x.decode("utf-8", "replace") for x in out]


def numbered(files, quoted):
    rows, n = [], 0
    for name, text in sorted(files.items()):
        for i, line in enumerate(plain(text, quoted), 1):
            n += line != ""
            rows.append((name, i, n if line else None, line))
    return sorted(rows, key=str)


def got(spark, path, **how):
    return sorted(((r.path.rsplit("/", 1)[1], r.line_no, r.row_no, r.value) for r in splits.lines(spark, str(path), **how).collect()), key=str)


class Memory(io.BytesIO):
    pass


@pytest.mark.parametrize("quoted", [False, True])
def test_ranges_of_one_file_in_memory(monkeypatch, quoted):
    """Random texts cut everywhere, read in small pieces: every record once, with right numbers."""
    r = random.Random(int(quoted))
    for trial in range(400):
        monkeypatch.setattr(splits, "CHUNK", r.choice([1, 2, 3, 5, 100]))
        text = "".join(r.choice(['"', "\n", "\n", "\r\n", "\r", "a", "bb", '""', ","]) for _ in range(r.randrange(1, 40))).encode()
        size = r.choice([1, 2, 3, 5, 8])
        want = plain(text, quoted)
        inside, first, full, found = 0, 0, 0, []
        for start in range(0, len(text), size):
            stop = min(len(text), start + size)
            odd, ends, blank, mid = splits._count(Memory(text), start, stop, quoted)
            line = row = None
            for own, records in splits._records(Memory(text), start, stop, len(text), bool(inside), quoted):
                if line is None and records:
                    line, row = first + (not own), full + (0 if own or mid[inside] else 1)
                for x in records:
                    line, row = line + 1, row + (len(x) > 0)
                    found.append((line, row if x else None, x.decode()))
            first, full = first + ends[inside], full + ends[inside] - blank[inside]
            inside ^= odd if quoted else 0
        n, rows = 0, []
        for i, x in enumerate(want, 1):
            n += x != ""
            rows.append((i, n if x else None, x))
        assert found == rows, (text, size)


@pytest.mark.parametrize("size", [2, 1000])
def test_files_and_ranges(spark, tmp_path, size):
    files = {
        "a.txt": b'one\n\n"x\ny"\r\n\r\nlast', "b.txt": b"\n\n", "c.txt": "é中\nü".encode(), "d.txt": b"", "e.txt": b'"open\nend', "f.txt": b"\r\n", "g.txt": b"no end", "h.txt": b"\r", "i.txt": b"x\n", "j.txt": b'"in\n', "k.txt": b"y",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text)
    for quoted in (False, True):
        assert got(spark, tmp_path, quoted=quoted, size=size) == numbered(files, quoted)


def test_one_large_file_has_many_ranges(spark, tmp_path):
    text = "".join(f"{i} {'x' * (i % 50)}\n" for i in range(50_000)).encode()
    (tmp_path / "big.txt").write_bytes(text)
    df = splits.lines(spark, str(tmp_path), size=1 << 16)
    assert splits.ranges(spark, str(tmp_path), size=1 << 16).count() == -(-len(text) // (1 << 16))
    rows = df.selectExpr("count(*) n", "count(distinct line_no) d", "max(line_no) m", "count_if(split(value, ' ')[0] = line_no - 1) hit", "count_if(row_no = line_no) same").first()
    assert tuple(rows) == (50_000, 50_000, 50_000, 50_000, 50_000)
