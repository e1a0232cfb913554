import random
import tarfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_sources_and_streams import archive, described
from voxframe.sources.archives import tar_pairs
from voxframe.sources.ranges import footer_index, member_index, members_by_range, opened, pairs_by_range, read_pieces, rows_at


def listed(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "archive string")


@pytest.fixture
def shard(tmp_path):
    drawn = random.Random(5)
    members = []
    for i in range(60):
        name = f"k{i}" if i % 7 else f"{'long' * 40}{i}"  # long names take headers of their own
        both = [(f"{name}.json", described(name)), (f"{name}.mp3", drawn.randbytes(drawn.choice([0, 1, 511, 512, 513, 3000])))]
        members += both if i % 2 else both[::-1]
    return archive(tmp_path / "shard_000003.tar", members), members


def test_member_index_is_what_tarfile_lists(spark, shard):
    path, members = shard
    got = member_index(listed(spark, path, path)).orderBy("position").collect()
    with tarfile.open(path) as tar:
        want = [(i, m.name, True, m.offset_data, m.size) for i, m in enumerate(tar.getmembers())]
    assert [tuple(r)[1:] for r in got] == want
    assert len(got) == len(members)


def test_one_archive_is_read_by_many_tasks(spark, shard):
    path, members = shard
    index = member_index(listed(spark, path))
    pieces = index.select("archive", "member", F.array(F.struct("offset", "size")).alias("pieces"))
    read = read_pieces(pieces, split=4096)
    assert len({r["t"] for r in read.select(F.spark_partition_id().alias("t")).collect()}) > 4
    assert {r["member"]: bytes(r["contents"][0]) for r in read.collect()} == dict(members)


def test_pairs_by_range_equal_the_sequential_scan(spark, shard, tmp_path):
    path, _ = shard
    want = sorted(map(tuple, tar_pairs(spark, str(tmp_path)).collect()))
    assert sorted(map(tuple, pairs_by_range(member_index(listed(spark, path)), split=4096).collect())) == want
    assert len(want) == 60


@pytest.mark.parametrize(
    "members, message",
    [
        ([("a.json", described("a"))], "no partner"),
        ([("a.json", described("a")), ("b.mp3", b"1"), ("b.json", described("b")), ("a.mp3", b"1")], "no partner"),
        ([("a.json", described("a")), ("a.json", described("a"))], "repeated member"),
        ([("a.json", described("a")), ("a.mp3", b"1")] * 2, "repeated pair"),
        ([("a", None)], "not a file"),
        ([("a.json", described("a")), ("a.wav", b"1")], "unexpected member"),
        ([("x/a.json", described("a")), ("x/a.mp3", b"1")], "unexpected member"),
        ([("a.json", described("b")), ("a.mp3", b"1")], "does not name"),
        ([("a.json", b"{"), ("a.mp3", b"1")], "bad JSON"),
    ],
)
def test_layout_errors(spark, tmp_path, members, message):
    path = archive(tmp_path / "shard_000003.tar", members)
    with pytest.raises(Exception, match=message):
        pairs_by_range(member_index(listed(spark, path))).collect()


def test_members_must_exist_once(spark, tmp_path):
    path = archive(tmp_path / "x.tar", [("a.mp3", b"1"), ("b.mp3", b""), ("c.mp3", b"2"), ("c.mp3", b"3")])
    index = member_index(listed(spark, path))

    def got(*names):
        wanted = spark.createDataFrame([(path, n) for n in names], "archive string, member string")
        return {r["member"]: bytes(r["payload"]) for r in members_by_range(wanted, index).collect()}

    assert got("a.mp3", "b.mp3", "a.mp3") == {"a.mp3": b"1", "b.mp3": b""}
    assert got() == {}
    with pytest.raises(Exception, match="no such member: d.mp3"):
        got("d.mp3")
    with pytest.raises(Exception, match="repeated member: c.mp3"):
        got("c.mp3")


def test_cut_and_empty_archives(spark, tmp_path):
    empty = archive(tmp_path / "shard_000001.tar", [])
    assert pairs_by_range(member_index(listed(spark, empty))).collect() == []
    whole = archive(tmp_path / "shard_000002.tar", [("a.mp3", b"x" * 5000), ("b.mp3", b"y" * 5000)])
    cut = tmp_path / "cut.tar"
    cut.write_bytes(open(whole, "rb").read()[:7000])
    with pytest.raises(Exception, match="damaged archive"):
        pieces = member_index(listed(spark, str(cut))).select("archive", "member", F.array(F.struct("offset", "size")).alias("pieces"))
        read_pieces(pieces).collect()


def test_an_opener_of_the_users(spark, tmp_path):
    path = archive(tmp_path / "x.tar", [("a.mp3", b"1")])
    folder = str(tmp_path)

    def from_store(uri):
        return opened(uri.replace("store:", folder))

    index = member_index(listed(spark, "store:/x.tar"), open_file=from_store)
    wanted = spark.createDataFrame([("store:/x.tar", "a.mp3")], "archive string, member string")
    assert [bytes(r["payload"]) for r in members_by_range(wanted, index, open_file=from_store).collect()] == [b"1"]
    assert path


def write_groups(spark, folder, rows, group):
    """Two files with row groups of ``group`` rows."""
    import os

    os.makedirs(folder)
    half = len(rows) // 2 + 1
    for name, part in (("a.parquet", rows[:half]), ("b.parquet", rows[half:])):
        pq.write_table(spark.createDataFrame(part, "n long, s string, extra string").toArrow(), f"{folder}/{name}", row_group_size=group, compression="none", use_dictionary=False)


def test_rows_at_ordinals(spark, tmp_path):
    rows = [(i * 3, None if i % 5 == 0 else f"s{i}", "e" * (i % 11)) for i in range(1003)]
    folder = str(tmp_path / "t")
    write_groups(spark, folder, rows, 17)
    index = footer_index(spark, [folder])
    first = 0
    for r in index.orderBy("file", "row_group").collect():
        assert r["first_ordinal"] == first
        first += r["rows"]
    assert first == 1003
    asked = [0, 16, 17, 501, 502, 503, 1002, 17, None, *random.Random(1).sample(range(1003), 200)]
    wanted = spark.createDataFrame([(i,) for i in asked], "ordinal long")
    got = sorted(map(tuple, rows_at(index, wanted, ["s", "n"]).collect()))
    assert got == [(i, rows[i][1], rows[i][0]) for i in sorted({i for i in asked if i is not None})]
    assert rows_at(index, wanted.limit(0), ["n"]).collect() == []
    for outside in (-1, 1003):
        with pytest.raises(Exception, match="no such row"):
            rows_at(index, spark.createDataFrame([(outside,)], "ordinal long"), ["n"]).collect()


def test_one_row_reads_one_row_group(spark, tmp_path):
    """The bytes of all other row groups may be anything."""
    folder = str(tmp_path / "t")
    write_groups(spark, folder, [(i, f"s{i}", "e") for i in range(100)], 10)
    index = footer_index(spark, [folder])
    for name, keep in (("a.parquet", 2), ("b.parquet", None)):
        meta = pq.ParquetFile(f"{folder}/{name}").metadata
        with open(f"{folder}/{name}", "r+b") as file:
            for g in range(meta.num_row_groups):
                for c in range(meta.num_columns):
                    chunk = meta.row_group(g).column(c)
                    if g != keep or chunk.path_in_schema == "extra":
                        file.seek(chunk.data_page_offset)
                        file.write(b"\xff" * chunk.total_compressed_size)
    wanted = spark.createDataFrame([(25,)], "ordinal long")
    assert [tuple(r) for r in rows_at(index, wanted, ["n", "s"]).collect()] == [(25, 25, "s25")]
    with pytest.raises(Exception):
        rows_at(index, spark.createDataFrame([(35,)], "ordinal long"), ["n"]).collect()
