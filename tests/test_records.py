"""Quoted line breaks in CSV files, across splits; values that do not parse."""

import csv
import io as text_io
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Row

from hearthscore.sources import calls as io
from hearthscore.sources import records
from hearthscore.sources.records import ends_open


def state_by_characters(line, is_open):
    """The same by one step per character."""
    state = "quoted" if is_open else "start"
    for c in line:
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "start" and c == '"':
            state = "quoted"
        elif state == "quote" and c == '"':
            state = "quoted"
        else:
            state = "start" if c == "," else "plain"
    return state == "quoted"


@given(st.text('a",', max_size=14), st.booleans())
def test_line_state_equals_the_character_machine(line, is_open):
    assert ends_open(line, is_open) == state_by_characters(line, is_open)


def write(path, rows, line_end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=line_end).writerows(rows)


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def notes(n, seed):
    rng = random.Random(seed)
    parts = ["plain", "two\nlines", 'say "x"', "a,b", "\n\n", "5\" pipe", "long " * 30 + "\n" + "x,\"\n" * 60, "é\nü"]
    return [(f"m{i}", str(i), rng.choice(parts)) for i in range(n)]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_records_across_splits(spark, tmp_path, small_splits, monkeypatch, line_end, broadcast):
    if not broadcast:
        monkeypatch.setattr(records, "MAX_BROADCAST_SPLITS", 0)
    expected = notes(120, 1)
    write(tmp_path / "a.csv", [("Member Key", "Household Key", "Note"), *expected[:70]], line_end)
    write(tmp_path / "b.csv", [("Member Key", "Household Key", "Note"), *expected[70:]], line_end)
    df = io.scan_csv(spark, f"file://{tmp_path}")
    got = [(r.member_key, str(r.household_key), r.note) for r in df.orderBy("file_order").collect()]
    assert got == expected
    assert spark.read.text(f"file://{tmp_path}").rdd.getNumPartitions() > 8


def test_stray_quotes_stay_text_and_lines_stay_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Member Key,Note\n1,5" pipe\n\n2,6" pipe\n')
    assert records.multiline_records(spark, str(tmp_path)) is None
    rows = io.scan_csv(spark, str(tmp_path)).orderBy("file_order").collect()
    assert [(r.member_key, r.note) for r in rows] == [("1", '5" pipe'), ("2", '6" pipe')]


def test_multiline_and_plain_scan_agree(spark, tmp_path):
    """Blank lines, empty and short rows mean the same on both paths."""
    body = 'Member Key,Household Key,Note\n1,7,\n\n2,,""\n3,8.0,x\n4\n'
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.csv").write_text(body)
    (tmp_path / "multi").mkdir()
    (tmp_path / "multi" / "a.csv").write_text(body + '5,9,"a\nb"\n')
    one = io.scan_csv(spark, str(tmp_path / "plain"), False).collect()
    two = io.scan_csv(spark, str(tmp_path / "multi"), False).collect()
    assert sorted(map(str, two)) == sorted([*map(str, one), str(Row(member_key="5", household_key=9, note="a\nb"))])


def test_open_end_and_long_header_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Member Key,Note\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="ends inside quotes"):
        io.scan_csv(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text('Member Key,"No\nte"\n1,x\n')
    with pytest.raises(Exception, match="header"):
        io.scan_csv(spark, str(tmp_path / "b.csv")).collect()


def test_empty_file_and_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Member Key,Note\n")
    assert io.scan_csv(spark, str(tmp_path / "a.csv")).count() == 0


def test_unparsable_values_are_counted(spark, tmp_path):
    out = text_io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(
        [("Household Key", "Total Cost", "Note"), ("7.0", "1.5", "a\nb"), ("x7", "bad", ""), ("", "", ""), ("8y", "2", "")]
    )
    (tmp_path / "a.csv").write_text(out.getvalue())
    got = {r.column_name: r.unparsable for r in io.unparsable(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"household_key": 2, "total_cost": 1}


def test_scan_csv_scans_compressed_files(spark, sf, tmp_path, monkeypatch):
    from hearthscore.queries import prepare

    monkeypatch.setattr(prepare, "scratch_path", lambda *_: f"{tmp_path}/calls")
    rows = prepare.scan_csv(spark, sf).count()
    files = list((tmp_path / "calls").glob("part-*"))
    assert rows and files and all(f.name.endswith(".csv.gz") for f in files)


def test_compressed_files_keep_line_breaks_quotes_and_nulls(spark, tmp_path):
    values = [(1, ' a "b",\n\nc '), (2, None), (3, ",x\r\ny"), (4, "plain"), (4, "plain")]
    df = spark.createDataFrame(values, "household_key long, note string").repartition(3)
    io.write_csv(df, f"{tmp_path}/z", compressed=True)
    got = io.scan_csv(spark, f"{tmp_path}/z", file_order=False).collect()
    assert sorted(map(tuple, got)) == sorted(values)
