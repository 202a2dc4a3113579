import csv
import random

import pytest

from claimsmith.sources import io

PIECES = ['"', '""', ",", "\n", "\r\n", "\\", '\\"', "a", "North", " ", "  ", "\t", "é", "'", ";", "#", "x\ny", "NA", "0"]


def make_rows(seed, n=300):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, "", "".join(rng.choices(PIECES, k=rng.randrange(1, 7)))])
    return [(f"P{i}", value(), value()) for i in range(n)]


def test_snapshot_round_trip_keeps_every_value(spark, tmp_path):
    rows = make_rows(1)
    df = spark.createDataFrame(rows, "id string, name string, note string")
    path = str(tmp_path / "snapshot")
    io.write_raw_snapshot(df.repartition(3), ["id", "name", "note"], path)
    key = lambda r: r[0]
    back = io.read_csv(spark, path, keep_empty=True)
    assert back.columns == ["id", "name", "note"]
    assert sorted(map(tuple, back.collect()), key=key) == sorted(rows, key=key)
    nulled = [tuple(v or None for v in r) for r in rows]
    for back in (io.read_csv(spark, path), io.read_checked_csv(spark, path)):
        assert sorted(map(tuple, back.collect()), key=key) == sorted(nulled, key=key)


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_files_of_another_writer(spark, tmp_path, terminator):
    rows = [(a, b or "", c or "") for a, b, c in make_rows(2)]
    path = tmp_path / "providers.csv"
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f, lineterminator=terminator)
        out.writerow(("id", "name", "note"))
        out.writerows(rows)
    df, info = io.read_source(spark, "providers", str(path), None, ["id", "name", "note"], allow_fallback=False)
    assert not info["used_fallback"]
    got = sorted((r.id, r.name or "", r.note or "") for r in df.collect())
    # In a file whose records end in CR LF, the reader takes a quoted CR LF as LF.
    assert got == sorted(rows if terminator == "\n" else [tuple(v.replace("\r\n", "\n") for v in r) for r in rows])


def test_probes_of_quoted_records(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('provider_id,provider_name\n"P1","North\nClinic"\n"P2","The ""A"", Ltd"\nP3,C:\\x\n')
    got = [tuple(r) for r in io.read_checked_csv(spark, str(path)).collect()]
    assert got == [("P1", "North\nClinic"), ("P2", 'The "A", Ltd'), ("P3", "C:\\x")]


@pytest.mark.parametrize("text,why", [
    ('a,b\n1,"open\n2,x\n', "never closed"), ('a,b\n"1\n","2","3"\n', "more fields"), ('a,b\n1,2,3\n', "more fields"), ("", "no header")])
def test_malformed_primaries_fall_back(spark, tmp_path, text, why):
    primary, sample = tmp_path / "p.csv", tmp_path / "s.csv"
    primary.write_text(text)
    sample.write_text("a,b\n7,8\n")
    df, info = io.read_source(spark, "x", str(primary), str(sample), ["a", "b"])
    assert info["used_fallback"] and why in info["error"] and [tuple(r) for r in df.collect()] == [("7", "8")]


def test_plain_files_are_read_split_by_lines(spark, tmp_path):
    plain, spans = tmp_path / "a.csv", tmp_path / "b.csv"
    plain.write_text('a,b\n"x, y","say ""hi"""\n')
    spans.write_text('a,b\n"x\ny",z\n')
    assert io._quoting(spark, str(plain)) == (False, False)
    assert io._quoting(spark, str(spans)) == (True, False)
    assert [tuple(r) for r in io.read_csv(spark, str(plain)).collect()] == [("x, y", 'say "hi"')]


def test_a_null_in_the_only_column_is_not_lost_silently(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("",)], "only string")
    io.write_raw_snapshot(df, ["only"], str(tmp_path / "ok"))
    assert sorted(r[0] for r in io.read_csv(spark, str(tmp_path / "ok"), keep_empty=True).collect()) == ["", "x"]
    with pytest.raises(Exception, match="only column"):
        io.write_raw_snapshot(spark.createDataFrame([(None,)], "only string"), ["only"], str(tmp_path / "bad"))
