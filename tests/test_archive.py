"""The archive source: streaming, record numbers, odd rows, errors that name their place."""

from __future__ import annotations

import csv
import io
import random
import zipfile

import pyarrow as pa
import pytest

from tramloom.sources import archive
from tramloom.sources.feed import read_feed


def zipped(path, files, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as out:
        for name, text in files.items():
            out.writestr(name, text if isinstance(text, bytes) else text.encode())
    return str(path)


def plain_records(text, columns):
    """What a plain CSV reader finds; blank lines are no records."""
    reader = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
    header = [h.strip() for h in next(reader, [])]
    for number, cells in enumerate((r for r in reader if r), start=2):
        yield (number, *[cells[header.index(c)] if c in header and header.index(c) < len(cells) else None
                         for c in columns])


def found_records(text, columns):
    return sorted(
        (row for numbers, cells in archive.records(io.BytesIO(text.encode()), columns)
         for row in zip(numbers.tolist(), *[c.to_pylist() for c in cells], strict=True)), key=repr)


CASES = {
    "plain": "a,b\n1,2\n3,4\n",
    "mark, spaces and order": "\ufeff b ,zz, a\n1,2,3\n",
    "short and long rows": "a,b\n1\n2,x\n3,y,z\n4\n5,q\n",
    "only short rows": "a,b,c\n1\n2\n3,4\n",
    "quotes and line ends": 'a,b\r\n"1,""x""","two\r\nlines"\r\n2,"y"\r\n',
    "blank lines": "a,b\n\n1,2\n\n\n3\n",
    "no end": "a,b\n1,2",
    "no rows": "a,b\n",
    "nothing": "",
    "names twice": "a,a,b\n1,2,3\n",
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [4 << 20, 40])
def test_records_equal_a_plain_reader(monkeypatch, name, block):
    monkeypatch.setattr(archive, "BLOCK_BYTES", block)
    columns = ["a", "b", "absent"]
    assert found_records(CASES[name], columns) == sorted(plain_records(CASES[name], columns), key=repr)


def test_record_numbers_over_many_blocks(monkeypatch):
    monkeypatch.setattr(archive, "BLOCK_BYTES", 200)
    rng = random.Random(4)
    lines = ["a,b,c"]
    for i in range(3_000):
        lines.append(",".join(str(i * 10 + k) for k in range(rng.choice([1, 2, 3, 3, 3, 3, 3, 4]))))
        if rng.random() < 0.05:
            lines.append("")
    text = "\n".join(lines)
    assert found_records(text, ["c", "a"]) == sorted(plain_records(text, ["c", "a"]), key=repr)


def test_members_by_base_name_in_a_folder_of_archives(spark, tmp_path):
    zipped(tmp_path / "one.zip", {"x/STOPS.txt": "stop_id\n1\n", "y/stops.txt": "stop_id\n9\n"})
    zipped(tmp_path / "two.ZIP", {"stops.txt": "stop_id,other\n2,x\n3,y\n"}, zipfile.ZIP_STORED)
    zipped(tmp_path / "three.zip", {"routes.txt": "route_id\n1\n"})
    (tmp_path / "notes.txt").write_text("no archive")
    found = archive.scan(spark, str(tmp_path), "stops.txt", ["stop_id"])
    assert found.rdd.getNumPartitions() == 2
    assert sorted((r.path.rsplit("/", 1)[1], r.record, r.stop_id) for r in found.collect()) == [
        ("one.zip", 2, "1"), ("two.ZIP", 2, "2"), ("two.ZIP", 3, "3")]
    listing = archive.scan(spark, f"file://{tmp_path}", archive.DIRECTORY, [])
    assert sorted(r.member for r in listing.collect()) == ["routes.txt", "stops.txt", "stops.txt", "stops.txt"]
    assert archive.scan(spark, str(tmp_path), "shapes.txt", ["a"]).collect() == []


def test_a_large_member_takes_bounded_memory(tmp_path):
    line = b"T000001,S1,%d,06:00:00,06:00:30\n"
    path = tmp_path / "large.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out, out.open("stop_times.txt", "w") as member:
        member.write(b"trip_id,stop_id,stop_sequence,arrival_time,departure_time\n")
        block = b"".join(line % i for i in range(100_000))
        for _ in range(100):
            member.write(block)
        size = len(block) * 100
    assert size > 300_000_000
    reader = archive._Reader(str(path), "stop_times.txt", ["trip_id", "stop_sequence"])
    (part,) = reader.partitions()
    held = pa.total_allocated_bytes()
    rows = most = 0
    for batch in reader.read(part):
        rows += batch.num_rows
        most = max(most, pa.total_allocated_bytes() - held)
    assert rows == 10_000_000 and most < 20 * archive.BLOCK_BYTES


def test_errors_name_file_and_record(spark, tmp_path):
    with pytest.raises(Exception, match="no zip|not a zip"):
        (tmp_path / "bad.zip").write_bytes(b"not an archive")
        archive.scan(spark, str(tmp_path / "bad.zip"), "stops.txt", ["stop_id"]).collect()
    cut = zipped(tmp_path / "text.zip", {"stops.txt": b"stop_id,stop_name\n1,ok\n2,\xff\xfe\n"})
    with pytest.raises(Exception, match="text.zip stops.txt"):
        archive.scan(spark, cut, "stops.txt", ["stop_id", "stop_name"]).collect()
    files = {"agency.txt": "agency_name,agency_timezone\nA,UTC\n", "routes.txt": "route_id,route_type\n1,2\n",
             "stops.txt": "stop_id,stop_lat\n1,4\n2\n3,north\n", "trips.txt": "trip_id,route_id,service_id\n",
             "stop_times.txt": "trip_id,stop_id,stop_sequence,arrival_time,departure_time\n",
             "calendar_dates.txt": "service_id,date,exception_type\nS,20260401,1\n"}
    feed = read_feed(spark, zipped(tmp_path / "feed.zip", files), "X")
    with pytest.raises(Exception, match="feed.zip stops.txt record 4: bad stop_lat north"):
        feed.stops.collect()
