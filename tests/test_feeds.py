"""The tail of growing files, LZ4 files in runs of blocks, sinks that store once, and what a feed counts."""

import json
import random
import struct
import time

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickloom.sources import archive, diffs, frames, lz4, sinks, tail
from tickloom.streaming import live

COMPRESSED = pa.Codec("lz4_raw")


def frame(texts, flg=0x60, bd=0x40, plain=()):
    """A frame of independent blocks, one for each text; ``plain`` ones are stored as they are."""
    shape = bytes([flg, bd]) + (struct.pack("<Q", sum(map(len, texts))) if flg & 8 else b"")
    out = struct.pack("<I", 0x184D2204) + shape + bytes([xxhash.xxh32(shape).intdigest() >> 8 & 255])
    for i, text in enumerate(texts):
        raw = text if i in plain else COMPRESSED.compress(text, asbytes=True)
        out += struct.pack("<I", len(raw) | (1 << 31 if i in plain else 0)) + raw
        if flg & 16:
            out += struct.pack("<I", xxhash.xxh32(raw).intdigest())
    return out + struct.pack("<I", 0) + (struct.pack("<I", xxhash.xxh32(b"".join(texts)).intdigest()) if flg & 4 else b"")


def cut(text, rng, most):
    at, out = 0, []
    while at < len(text):
        n = rng.randint(1, most)
        out.append(text[at : at + n])
        at += n
    return out


@pytest.mark.parametrize("run_bytes", [1, 300, 1 << 20])
def test_lz4_runs_are_read_like_the_whole_file(spark, tmp_path, run_bytes):
    rng, want = random.Random(run_bytes), {}
    for k, end in enumerate([b"\n", b"", b"\n\n"]):
        lines = [f"{k} {'é' * rng.randint(0, 30)} {i}".encode() if i % 7 else b"" for i in range(300)]
        lines[150] = b"long " * 2000  # over many blocks
        text = b"\n".join(lines) + end
        third = len(text) // 3
        linked = pa.BufferOutputStream()
        with pa.CompressedOutputStream(linked, "lz4") as f:
            f.write(text[third : 2 * third])
        (tmp_path / f"f {k}.lz4").write_bytes(frame(cut(text[:third], rng, 900), 0x60 | 8, plain=(0, 2)) + struct.pack("<II", 0x184D2A51, 3) + b"xyz" + linked.getvalue().to_pybytes() + frame([], 0x60) + frame(cut(text[2 * third :], rng, 400), 0x60 | 16 | 4))
        want[k] = text.decode().split("\n")[: -1 if text.endswith(b"\n") else None]
    (tmp_path / "empty.lz4").write_bytes(b"")
    runs = lz4.runs(lz4.files(spark, str(tmp_path)), run_bytes).groupBy("path").count().collect()
    assert len(runs) == 3 and all((r["count"] > 5) == (run_bytes < 1000) for r in runs)
    got = lz4.lines(lz4.files(spark, str(tmp_path)), run_bytes).orderBy("file", "ordinal").collect()
    for k, lines in want.items():
        assert [r.raw for r in got if f"{k}.lz4" in r.file] == lines


def test_lz4_files_that_are_cut_off_are_errors(spark, tmp_path):
    whole = frame([b"one\ntwo\n", b"three"])
    for bad in (whole[:-8], b"no frame at all"):
        (tmp_path / "a.lz4").write_bytes(bad)
        with pytest.raises(Exception, match="cut off|no LZ4 frame"):
            lz4.lines(lz4.files(spark, str(tmp_path))).collect()


def follow(spark, tmp_path, **options):
    """What one run over what is there adds to the table."""
    stream = tail.register(spark).readStream.format("tail").options(path=str(tmp_path / "data"), **options).load()
    stream.writeStream.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out"))).start().awaitTermination()
    if not (tmp_path / "out").exists():
        return []
    return [r.raw for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: (tail.natural(r.file), r.byte))]


def test_each_line_of_growing_files_comes_once(spark, tmp_path):
    day = tmp_path / "data" / "hourly" / "20260101"
    assert follow(spark, tmp_path) == []  # nobody writes yet
    day.mkdir(parents=True)

    def add(name, text):
        with open(day / name, "a") as f:
            f.write(text)

    add("9", "a\nb\nhal")
    assert follow(spark, tmp_path) == ["a", "b"]
    add("9", "f\nc\nlast")
    assert follow(spark, tmp_path) == ["a", "b", "half", "c"]
    add("10", "d\n")  # the hour rolls: nothing more comes to the one before
    add(".hidden", "x\n")
    assert follow(spark, tmp_path) == ["a", "b", "half", "c", "last", "d"]
    add("10", "e\n\nf")
    add("11", "g")
    assert follow(spark, tmp_path) == ["a", "b", "half", "c", "last", "d", "e", "", "f"]


def test_the_tail_begins_with_the_newest_file_and_is_read_in_parts(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "1").write_text("old\n")
    time.sleep(0.05)
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(2000)]
    (tmp_path / "data" / "2").write_text("\n".join(lines) + "\n")
    assert follow(spark, tmp_path, splitBytes=1000) == lines
    reader = tail.TailReader({"path": str(tmp_path / "data"), "start": "oldest", "splitBytes": "7"})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) > 1000 and [x for p in parts for b in reader.read(p) for x in b.column("raw").to_pylist()] == ["old", *lines]


POINTS = "symbol string, data_type string, t_ms long, data string, recv_ts_ms double, recv_mono_ns long"


def points(spark, low, high):
    return spark.createDataFrame([(f"S{i % 3}", "trade", 43_200_000 * i, f'{{"n":{i}}}', 5.0 if i % 2 else None, i) for i in range(low, high)], POINTS)


def failing(frame):
    """The rows, of which the last partition can't be written."""
    bad = frame.limit(1).withColumn("t_ms", F.raise_error(F.lit("the wire broke")).cast("long"))
    return frame.unionByName(bad)


def test_a_batch_of_files_is_stored_once(spark, tmp_path):
    sink, path = sinks.parquet_once(str(tmp_path / "t")), str(tmp_path / "t")
    sink(points(spark, 0, 5), 0)
    with pytest.raises(Exception, match="the wire broke"):
        sink(failing(points(spark, 5, 9)), 1)
    assert spark.read.parquet(path).count() == 5  # nothing of the broken try is seen
    for _ in range(2):  # and the batch is stored once, however often it comes
        sink(points(spark, 5, 9), 1)
    assert sorted((r.batch, r.data) for r in spark.read.parquet(path).collect()) == [(int(i >= 5), f'{{"n":{i}}}') for i in range(9)]


def test_a_batch_in_a_database_is_stored_once(spark, tmp_path, monkeypatch):
    url, properties = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark._jvm.java.lang.Class.forName(properties["driver"])
    sink, stored = sinks.jdbc_once(url, "points", **properties), lambda: spark.read.jdbc(url, "points", properties=properties)
    sink(points(spark, 0, 5), 0)
    with pytest.raises(Exception, match="the wire broke"):
        sink(failing(points(spark, 5, 9)), 1)
    assert stored().count() == 5
    for _ in range(2):
        sink(points(spark, 5, 9), 1)
    sinks.jdbc_once(url, "points", "other", **properties)(points(spark, 9, 10), 1)
    got = {r.t_ms // 43_200_000: r.data for r in stored().collect()}
    assert stored().count() == 10 and got[0] == '{"n":0}' and "_capture" in got[7]
    sinks.jdbc(url, "plain", **properties)(points(spark, 0, 4))
    assert spark.read.jdbc(url, "plain", properties=properties).count() == 4


def test_a_stream_that_fails_between_write_and_commit_stores_once(spark, tmp_path):
    for k in range(3):
        points(spark, 4 * k, 4 * k + 4).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        time.sleep(0.05)
    store, broken = sinks.parquet_once(str(tmp_path / "t")), [1]

    def sink(df, batch):
        store(df, batch)
        if batch in broken:
            broken.remove(batch)
            raise RuntimeError("gone before the batch was noted")

    run = lambda: live.write_once(live.read(spark, str(tmp_path / "in"), POINTS, files=1), sink, str(tmp_path / "at")).awaitTermination()
    with pytest.raises(Exception, match="gone before"):
        run()
    run()
    assert sorted(r.t_ms for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [43_200_000 * i for i in range(12)]


def test_a_range_read_of_a_clustered_store_opens_few_files(spark, tmp_path):
    path, store, hour = str(tmp_path / "s"), sinks.clustered(str(tmp_path / "s"), files=4), 3_600_000
    all_ = spark.range(240).select(F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), F.lit("trade").alias("data_type"), (F.col("id") * hour).alias("t_ms"))
    for k in range(5):
        store(all_.where(F.pmod(F.xxhash64("t_ms"), F.lit(5)) == k))
    files = lambda frame: {r[0] for r in frame.select("_metadata.file_path").distinct().collect()}
    before, rows = files(spark.read.parquet(path)), sorted(map(str, spark.read.parquet(path).drop("date").collect()))
    assert sinks.compact(spark, path) > 0
    sinks.compact(spark, path, most=2)
    after = files(spark.read.parquet(path))
    assert len(after) <= 37 < len(before) and sorted(map(str, spark.read.parquet(path).drop("date").collect())) == rows  # thirty days, seven ends of ranges
    found = archive.between(spark.read.parquet(path), "S1", "trade", 72 * hour, 168 * hour - 1)
    assert [r.t_ms // hour for r in found.collect()] == list(range(73, 168, 3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # four days of one symbol
    assert len(files(spark.read.parquet(path).where("symbol = 'S1' and date between '1970-01-04' and '1970-01-07'"))) <= 5


def test_what_a_stream_counts_is_what_is_there(spark, tmp_path):
    lines = [json.dumps(x) for x in [{"time": 1, "height": h, "data": {"book_diffs": [{}] * (h % 3)}} for h in range(20)] + [{"raw_book_diff": "remove"}, {"odd": 1}]] + ["junk é"]
    for k in range(3):
        spark.createDataFrame([(x, i) for i, x in enumerate(lines) if i % 3 == k], "raw string, ordinal long").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        time.sleep(0.05)
    stats = live.FeedStats()
    spark.streams.addListener(stats)
    try:
        stream = diffs.counted(live.read(spark, str(tmp_path / "in"), "raw string, ordinal long", files=1))
        live.write(stream, sinks.parquet(str(tmp_path / "out")), str(tmp_path / "at")).awaitTermination()
        trades = [("X", 10_000 * (i + 1), 1.0, 1.0, "B", i, i) for i in range(20)] + [("X", 1, 1.0, 1.0, "B", 100 + i, 100 + i) for i in range(3)]
        for own in (trades[:10], trades[10:20], trades[20:]):
            spark.createDataFrame(own, live.TRADES).coalesce(1).write.mode("append").json(str(tmp_path / "t"))
            time.sleep(0.05)
        stream = live.dedup(live.read(spark, str(tmp_path / "t"), live.TRADES, files=1), "1 second").drop("ts")
        live.write(stream, sinks.parquet(str(tmp_path / "t_out")), str(tmp_path / "t_at")).awaitTermination()
        for _ in range(100):
            if stats.totals["late"] and stats.totals["rows"] >= len(lines) + len(trades):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(stats)
    t = stats.totals
    assert spark.read.parquet(str(tmp_path / "t_out")).count() == 20
    assert (t["blocks"], t["diffs"], t["skipped"], t["bytes"]) == (20, sum(h % 3 for h in range(20)) + 1, 2, sum(len(x.encode()) for x in lines))
    assert (t["late"], t["rows"]) == (3, len(lines) + len(trades)) and spark.read.parquet(str(tmp_path / "t_out")).count() == 20
    seen = Observation()
    assert diffs.counted(spark.createDataFrame([(x, 0) for x in lines], "raw string, ordinal long"), seen).count() == len(lines)
    assert seen.get == {k: t[k] for k in ("blocks", "diffs", "skipped", "bytes")}


def test_gaps_of_a_stream_are_filled_when_the_archive_has_them(spark, tmp_path):
    trade = lambda symbol, t: (symbol, t, 1.0, 1.0, "B", t, t)
    later = 86_400_000 + 9_999
    feed = [[trade("X", t) for t in (0, 1000, 9000, 9500)] + [trade("Y", 0), trade("Y", 500)], [trade("X", 9400), trade("X", 20_000), trade("Y", later)], [trade("X", 20_500)], [trade("X", 20_900)]]
    stored = [[], [trade("X", t) for t in (1000, 1001, 5000, 9000)], [trade("X", 1001)], [trade("Y", 700), trade("X", 15_000), trade("X", 9400)]]
    times = iter([9_500, 20_000, 86_400_000 + 10_000, 86_400_000 + 20_001])
    calls = iter(stored)
    archive = lambda s: s.createDataFrame(next(calls), live.TRADES)
    for k, rows in enumerate(feed):
        spark.createDataFrame(rows, live.TRADES).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        gaps = live.silences(live.read(live.stateful(spark), str(tmp_path / "in"), live.TRADES, files=1), 5_000)
        live.backfill(gaps, archive, sinks.parquet_once(str(tmp_path / "out")), str(tmp_path / "pending"), str(tmp_path / "at"), lambda: next(times)).awaitTermination()
        waiting = sorted(tuple(r) for r in spark.read.schema(live.GAPS).parquet(str(tmp_path / "pending" / f"batch={k}")).collect())
        assert waiting == [[("X", 1000, 9000)], [("X", 9500, 20_000), ("Y", 500, later)], [("X", 9500, 20_000), ("Y", 500, later)], []][k], k
    got = sorted((r.symbol, r.t_ms, r.batch, r.backfilled) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("X", 1001, 1, True), ("X", 5000, 1, True), ("X", 9000, 1, True), ("X", 15_000, 3, True), ("Y", 700, 3, True)]


def test_requested_files_are_mirrored_and_read(spark, tmp_path):
    """Two symbols over two days; some files are empty, some are not there yet, one is of a symbol nobody asked for."""
    spans = spark.sql("select explode(array('ETH', 'SOL')) symbol, date'2025-03-01' first_day, date'2025-03-02' last_day")
    wanted = archive.requests(spans, ["trades"])
    source, cache = tmp_path / "source", tmp_path / "cache"

    def put(day, hour, symbol, *times):
        at = source / "market_data" / day / str(hour) / "trades" / f"{symbol}.lz4"
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(frame([json.dumps({"coin": symbol, "px": "1", "sz": "2", "side": "A", "time": t, "tid": t}).encode() + b"\n" for t in times]) if times else b"")

    put("20250301", 3, "ETH", 5, 4), put("20250301", 23, "SOL", 7), put("20250302", 0, "ETH", 9), put("20250302", 1, "BTC", 1), put("20250302", 1, "ETH")
    states = lambda: {r.state: r["count"] for r in archive.mirror(wanted, f"file://{source}", f"file://{cache}").groupBy("state").count().collect()}
    assert states() == {"copied": 3, "empty": 1, "missing": 92}
    put("20250302", 1, "ETH", 11)
    assert states() == {"cached": 3, "copied": 1, "missing": 92}
    lines = archive.collected(spark, str(cache), wanted)
    assert sorted((r.symbol, r.day, r.hour, r.data_type) for r in lines.collect()) == [("ETH", "20250301", 3, "trades")] * 2 + [("ETH", "20250302", 0, "trades"), ("ETH", "20250302", 1, "trades"), ("SOL", "20250301", 23, "trades")]
    assert [(r.symbol, r.t_ms) for r in frames.archive_trades(lines).orderBy("t_ms").collect()] == [("ETH", 4), ("ETH", 5), ("SOL", 7), ("ETH", 9), ("ETH", 11)]
    assert [d.rpartition("/")[2] for d in archive.days(spark, str(cache / "market_data"))] == ["20250301", "20250302"]
