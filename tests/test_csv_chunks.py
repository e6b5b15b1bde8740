"""CSV files cut at any byte, against a reader that sees them whole."""

import csv
import io
import os
import random

import pytest

from reelhouse.sources import bronze, files

HEADER = "Date,Name,Year,Letterboxd URI,Rating"
ROWS = ('2024-01-01,"A ""q"", b\nand\n""more""",2019,u1,4\n\n'
        '"2024-01-02","",x"y"z,"u""2",\n'
        ',,,,"last, ""field"""\n'
        '2024-01-03,"é𝄞",," u 3 ",5\n')


def slow_states(data, state):
    """The grammar, a byte at a time."""
    for c in data:
        quote, comma, end = c == 34, c == 44, c in (10, 13)
        if state in (files.RECORD, files.FIELD):
            state = files.QUOTED if quote else files.FIELD if comma else files.RECORD if end else files.PLAIN
        elif state == files.PLAIN:
            state = files.FIELD if comma else files.RECORD if end else files.PLAIN
        elif state == files.QUOTED:
            state = files.CLOSED if quote else files.QUOTED
        else:
            state = files.QUOTED if quote else files.FIELD if comma else files.RECORD if end else files.PLAIN
    return state


def test_states_and_records_of_random_bytes():
    rng = random.Random(5)
    for _ in range(3000):
        data = bytes(rng.choice(b'"",\n\rab') for _ in range(rng.randrange(14)))
        ends = [slow_states(data, s) for s in range(5)]
        assert [files.state_after(data, s) for s in range(5)] == ends, data
        whole = list(files.records(data, files.RECORD, lambda: b""))
        for n in (1, 2, 3, 5):
            state, found = files.RECORD, []
            for at in range(0, len(data), n):
                rest = iter([data[k:k + 1] for k in range(at + n, len(data))])
                found += files.records(data[at:at + n], state, lambda: next(rest, b""))
                state = files.state_after(data[at:at + n], state)
            assert found == whole, (data, n)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bom, end", [(b"", "\n"), (b"\xef\xbb\xbf", "\r\n")])
def test_cut_at_every_offset_equals_the_whole(spark, tmp_dir, bom, end):
    path = os.path.join(tmp_dir, "_x ratings.csv")
    body = (HEADER + "\n" + ROWS).replace("\n", end).encode()
    with open(path, "wb") as f:
        f.write(bom + body)
    # what a reader of the whole file in one piece gives; blank fields are NULL
    parsed = [r for r in csv.reader(io.StringIO(body.decode(), newline="")) if r][1:]
    want = sorted([tuple(v or None for v in r) for r in parsed], key=repr)
    as_null = lambda rows: sorted([tuple(v or None for v in r) for r in rows], key=repr)
    for chunk in [*range(1, 12), 17, 40, 1000]:
        got = bronze.read_export(spark, path, chunk=chunk)
        assert as_null(rows_of(got)) == want, chunk
    assert any(end in (v or "") for r in want for v in r)
    size = len(body) - len(HEADER) - len(end)
    assert bronze.read_export(spark, path, chunk=40).rdd.getNumPartitions() == -(-size // 40)
    # the same values as Spark's own reader of whole files, which turns CRLF inside quotes into LF
    plain = os.path.join(tmp_dir, "plain_ratings.csv")
    os.link(path, plain)
    spark_rows = bronze._scanned(spark, [plain], HEADER.split(","), True)
    fix = lambda rows: sorted([tuple(v and v.replace("\r\n", "\n") for v in r) for r in rows], key=repr)
    assert fix(rows_of(bronze.read_export(spark, plain, chunk=9))) == fix(rows_of(spark_rows))


def test_headers_and_line_ends(spark, tmp_dir):
    def write(name, data):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(data)
        return os.path.join(tmp_dir, name)

    mac = write("mac_ratings.csv", HEADER.encode() + b"\r1,a,2,u,3\r4,b,5,v,6")
    assert [tuple(r) for r in bronze.read_export(spark, mac).collect()] == [("1", "a", "2", "u", "3"), ("4", "b", "5", "v", "6")]
    empty = write("empty.csv", b"")
    assert bronze.read_export(spark, empty).columns == [] and files.read_head(empty).fields == []
    blank = write("blank.csv", b"\r\n\r\n\"a\nb\",,C,c\r\n1,2,3,4")
    got = bronze.read_export(spark, blank)
    assert got.columns == ["a\nb", "_c1", "C2", "c3"] and rows_of(got) == [("1", "2", "3", "4")]
    wide = write("wide.csv", ",".join(f"h{i}" for i in range(1500)).encode() + b"\n" + b",".join([b"x"] * 1500))
    assert len(bronze.read_export(spark, wide).columns) == 1500


def test_scheme_that_only_spark_opens(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "ratings.csv")
    with open(path, "w") as f:
        f.write(HEADER + "\n" + ROWS)
    want = rows_of(bronze.read_export(spark, path))
    monkeypatch.setattr(files, "can_open", lambda p: False)
    assert rows_of(bronze.read_export(spark, path)) == want
